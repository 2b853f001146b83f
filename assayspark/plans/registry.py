"""Registry of named queries: each maps to a Spark builder and (where SQL can say it) oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayspark.views import BUILDERS, with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` runs on DuckDB with ``views`` as CTEs."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return deco


def view(spark: SparkSession, d: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, d)
