"""Registered queries: each one pairs a Spark plan with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from .registry import REGISTRY, Query

FAMILIES = ("selection_queries", "ingest_queries", "corpus_queries", "contract_queries", "output_queries",
            "ledger_queries", "stream_queries", "tree_queries")


def all_queries() -> dict[str, Query]:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
    return REGISTRY
