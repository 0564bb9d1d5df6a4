"""Named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` per name,
plus the DuckDB SQL that must give the same rows (when SQL can express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query builder under ``name`` with its oracle SQL (if any)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from sparkmart.plans import (  # noqa: F401
        q_features,
        q_profile,
        q_quality,
        q_baskets,
        q_models,
        q_end_to_end,
        q_streaming,
    )
