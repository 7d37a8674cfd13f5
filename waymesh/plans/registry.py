"""Registry of named queries: a Spark callable each, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir) under ``name``."""

    def put(f: Query) -> Query:
        assert name not in _queries, name
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql
        return f

    return put


def _load() -> None:
    from waymesh.plans import catalog  # noqa: F401  registers on import


def queries() -> dict[str, Query]:
    _load()
    return _queries


def oracle_sql() -> dict[str, str]:
    _load()
    return _sql


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded path search over all edges."""
    from waymesh.plans.catalog_network import rt01

    return rt01(spark, sf_dir)
