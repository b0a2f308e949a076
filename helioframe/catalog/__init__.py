"""Registered queries: one per operator, with the equal DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("sources", "projections", "joins", "aggregates", "series", "scalars", "samples", "models", "fitted")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return keep


def _load() -> None:
    for module in _MODULES:
        import_module(f"helioframe.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
