"""All queries of the corpus operators."""

import importlib

_MODULES = ("token_counts", "token_store", "packing", "quality_rules", "quality_classifier", "ngram_join", "line_dedup", "fingerprints", "chat_format", "sentence_pieces", "turn_repair", "token_alignment", "factor_dedup")


def _all(name: str) -> dict:
    found = {}
    for m in _MODULES:
        found.update(getattr(importlib.import_module(f"glimmer.llm.{m}"), name, {}))
    return found


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE_SQL")
