"""One-row statistics.

A fitted statistic (a median, a mode, scaler means) is one row.  It is
computed by its own small job and enters the main plan as a literal, the
way Spark ML estimators fit: the main plan stays small (no copy of a large
sub-plan per use) and the row is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame) -> dict:
    """The single row of an aggregate as a dict (empty input -> Nones)."""
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("one_row expects an aggregate with a single row")
    return rows[0].asDict() if rows else {c: None for c in df.columns}


def lit_value(df: DataFrame, expr: Column | str, dtype: str | None = None) -> Column:
    """Evaluate a one-value aggregate and return it as a literal column."""
    v = one_row(df.select((F.col(expr) if isinstance(expr, str) else expr).alias("v")))["v"]
    c = F.lit(v)
    return c.cast(dtype) if dtype else c
