"""Registry of the queries: name -> function of (spark, sf_dir), and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated query under its own name, with its oracle."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = fn
        if sql:
            _ORACLES[key] = sql
        return fn

    return add


def _load() -> None:
    from tidemark.plans import catalog  # noqa: F401  importing registers


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
