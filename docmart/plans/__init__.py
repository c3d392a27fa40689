"""Composed plans: harness views, and the registered queries with their SQL."""

from __future__ import annotations

from importlib import import_module


def registry() -> dict:
    """All queries of the library by name: (query, SQL or None)."""
    for module in ("scalar_queries", "field_queries", "layout_queries", "mart_queries"):
        import_module(f"{__name__}.{module}")
    return import_module(f"{__name__}.harness").REGISTRY
