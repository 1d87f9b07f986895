"""Views over the given tables and the registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("equity_queries", "option_queries", "scalar_queries", "bar_queries", "calendar_queries",
           "stream_queries")


def _load():
    for module in MODULES:
        import_module(f"ticktide.plans.{module}")
    return import_module("ticktide.plans.registry")


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().ORACLES)
