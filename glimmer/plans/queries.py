"""Registered queries over the driver's tables and their SQL equivalents."""

from glimmer.plans import decoding, imaging, jobs, volumes

_GROUPS = (decoding, imaging, jobs, volumes)
QUERIES: dict = {k: f for g in _GROUPS for k, f in g.QUERIES.items()}
ORACLE_SQL: dict = {k: q for g in _GROUPS for k, q in g.ORACLE_SQL.items()}
