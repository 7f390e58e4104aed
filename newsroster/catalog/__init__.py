"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ["sources", "planning", "ingest", "state", "clean", "enrich", "relevance", "sinks", "jobs"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in SECTIONS:
        merged.update(getattr(import_module(f"{__name__}.{name}"), attribute))
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
