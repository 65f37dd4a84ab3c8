"""Query registry: name -> (Spark query, optional DuckDB oracle SQL).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables.  The oracle SQL, when present, computes the same result over DuckDB
views of the same parquet files; column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from connlens.plans import (  # noqa: F401
        quality_queries, label_queries, feature_queries, sampling_queries, metric_queries,
        report_queries, neighbor_queries, model_queries, traffic_queries, stream_queries, learner_queries, io_queries,
        sketch_queries, vote_queries,
    )
