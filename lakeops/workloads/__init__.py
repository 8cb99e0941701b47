"""Registered queries, one module per family. Each module has `QUERIES` and `ORACLE` with equal keys."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("change_data", "lake", "star_reports", "scripts", "measurements", "retrieval", "documents", "logs", "lineage", "streams", "operations")


def _merged(name: str) -> dict:
    found: dict = {}
    for family in FAMILIES:
        entries = getattr(import_module(f"{__name__}.{family}"), name)
        clash = found.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(entries)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
