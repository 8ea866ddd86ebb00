"""Named queries over the given tables, each with SQL that checks it."""

from __future__ import annotations

import importlib

_MODULES = ("model", "events", "facts", "reports", "questions", "spans", "export", "files")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in _MODULES:
        merged.update(getattr(importlib.import_module(f"{__name__}.{name}"), attribute))
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
