"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from glimmer.plans.queries import ORACLE_SQL, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in SF.glob("*.parquet"):
        c.sql(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, db, name):
    got = QUERIES[name](spark, str(SF))
    columns = sorted(got.columns)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    as_rows = lambda rows: sorted(tuple(plain(v) for v in r) for r in rows)
    assert as_rows([r[c] for c in columns] for r in got.collect()) == as_rows([r[i] for i in at] for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, str(SF)).count() >= 0
