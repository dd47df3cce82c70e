"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus the DuckDB
oracle text for the same name where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlake.plans import oracle
from churnlake.plans.output import finalize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, sql: str | None = None, dbl=(), ts=(), ints=()):
    """Register a query; ``sql`` is the oracle body (omitted for operators
    SQL cannot state, e.g. model fits)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # zone-less driver timestamps are wall-clock times: read them in UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            oracle.register(name, sql, dbl, ts, ints)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from churnlake.plans import (q_diagnostics, q_domain, q_drift, q_feature_table,  # noqa: F401
                                 q_io, q_metrics, q_ml, q_scoring, q_stateful, q_streaming, q_versions)
