"""One Spark query and (where SQL can say it) one DuckDB oracle per surveyed key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules fills QUERIES and ORACLES.
    from strata.registry import (  # noqa: F401
        k_relational, k_joins, k_aggregates, k_windows, k_scalars, k_jobs,
    )
