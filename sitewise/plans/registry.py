"""Query registry: Spark callable plus the equivalent oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewise.plans.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key`` with an optional oracle."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = with_views(sql)
        return fn

    return register
