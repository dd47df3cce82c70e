"""Prefix sums and exact quantiles without a single-partition window.

``prefix_sums`` (P1): the input is one row per distinct ordering value (per
group).  Rows are cut into value ranges at approximate quantiles of the
ordering column; each range is summed, the ranges get exclusive offsets from
a window over the (few) range totals, and a window *partitioned by range*
adds the running sum inside each range.  Results are exact; the approximate
quantiles only decide the partitioning, so a heavy group is spread over many
tasks and no task ever holds a whole group.

The number of ranges follows from the measured number of rows, so a range
holds about ``rows_per_range`` rows at any size; a frame that fits one range
is one range of the same plan.  Ranges are cut on a double that never
decreases with the ordering column, rows inside a range are ordered by the
column itself, so 60-bit integers, dates and text are ordered exactly.  NULL
groups are groups.

``exact_quantiles``: interpolated quantiles (numpy / pandas / DuckDB
``quantile_cont`` semantics) from per-value counts and their prefix sums:
the value at 0-based rank r is the smallest value whose inclusive running
count exceeds r, one conditional ``min`` per target rank.  Unlike Spark's
``percentile`` aggregate it never buffers a group's values in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.stats import lit_value, one_row
from churnlake.session import cut_lineage

_G = "__grp"
ROWS_PER_RANGE = 500_000
# (group, range) rows up to this many are broadcast; more are joined by a shuffle.
BROADCAST_RANGES = 500_000


def _group_cols(df: DataFrame, group_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if group_cols:
        return df, list(group_cols)
    return df.withColumn(_G, F.lit(0)), [_G]


def range_key(c: str, dtype: T.DataType) -> Column:
    """A double that never decreases when the column grows: the number
    itself, microseconds, or the first seven bytes of a text."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.col(c).cast("double")
    if isinstance(dtype, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(dtype, T.StringType):
        first = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(first, 16, 10).cast("double")
    return F.lit(0.0)


def same_group(left: str, right: str, cols: Sequence[str]) -> Column:
    """Null-safe equality of the group columns of two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def value_ranges(df: DataFrame, order_col: str, gcols: Sequence[str], rows_per_range: int = ROWS_PER_RANGE,
                 accuracy: int = 10000) -> tuple[DataFrame, int, int]:
    """(``df`` with ``__range``, number of ranges, number of groups): each group cut into value
    ranges that rise with ``order_col``; equal values are in one range."""
    size = one_row(df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*gcols)).alias("g")))
    n_ranges = max(1, math.ceil(size["n"] / rows_per_range))
    if n_ranges == 1:
        return df.withColumn("__range", F.lit(0)), 1, size["g"]
    keyed = df.withColumn("__key", range_key(order_col, df.schema[order_col].dataType))
    fracs = F.array(*[F.lit(i / n_ranges) for i in range(1, n_ranges)])
    bounds = keyed.groupBy(*gcols).agg(
        F.percentile_approx("__key", fracs, max(accuracy, 20 * n_ranges)).alias("__bounds"))
    # number of bounds below the key, by binary search
    steps = [1 << k for k in reversed(range(n_ranges.bit_length()))]
    at = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda lo, x: F.when(
        (lo + x <= F.size("__bounds")) & (F.get("__bounds", lo + x - 1) < F.col("__key")), lo + x).otherwise(lo))
    ranged = (keyed.alias("k").join(_few(bounds, size["g"]).alias("b"), same_group("k", "b", gcols), "left")
                   .select("k.*", "b.__bounds")
                   .withColumn("__range", F.when(F.col("__key").isNull() | F.col("__bounds").isNull(), F.lit(-1)).otherwise(at))
                   .drop("__bounds", "__key"))
    return ranged, n_ranges, size["g"]


def prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), descending: bool = False,
                rows_per_range: int = ROWS_PER_RANGE, accuracy: int = 10000,
                prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` over ``order_col`` (unique per
    group, any orderable type) within each group.  Adds ``{prefix}{c}``
    columns.  One job counts the rows and groups when the plan is built."""
    df, gcols = _group_cols(df, group_cols)
    ranged, n_ranges, groups = value_ranges(df, order_col, gcols, rows_per_range, accuracy)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    totals = ranged.groupBy(*gcols, "__range").agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    by_range = F.col("__range").desc() if descending else F.col("__range").asc()
    wr = Window.partitionBy(*gcols).orderBy(by_range).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*gcols, "__range",
                            *[F.coalesce(F.sum(f"__tot_{c}").over(wr), F.lit(0)).alias(f"__off_{c}")
                              for c in sum_cols])
    wi = Window.partitionBy(*gcols, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    keep = [c for c in ranged.columns if c != "__range"]
    if n_ranges == 1:       # one range: every offset is 0
        out = ranged.select(*keep, *[F.sum(c).over(wi).alias(f"{prefix}{c}") for c in sum_cols])
    else:
        out = (ranged.alias("r").join(_few(offsets, groups * n_ranges).alias("o"),
                                      same_group("r", "o", [*gcols, "__range"]), "left")
                     .select("r.*", *[f"o.__off_{c}" for c in sum_cols])
                     .select(*keep, *[(F.sum(c).over(wi) + F.col(f"__off_{c}")).alias(f"{prefix}{c}")
                                      for c in sum_cols]))
    return out if group_cols else out.drop(_G)


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_RANGES else df


def exact_quantiles(df: DataFrame, value_col: str, qs: Sequence[float],
                    group_cols: Sequence[str] = (), weight_col: str | None = None,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per (group, q): columns ``*group_cols, q, value``.

    Linear interpolation between the order statistics at floor/ceil of
    ``q * (n - 1)``.  NULL values are ignored; a group without values gives no
    rows.  ``weight_col`` gives pre-aggregated counts per row.  The counts
    are written once: the prefix sums read them several times.
    """
    df, gcols = _group_cols(df, group_cols)
    counts = cut_lineage(df.where(F.col(value_col).isNotNull())
                         .groupBy(*gcols, F.col(value_col).cast("double").alias("__v"))
                         .agg((F.sum(weight_col) if weight_col else F.count(F.lit(1))).alias("__n"))
                         .where(F.col("__n") > 0))
    cum = prefix_sums(counts, "__v", ["__n"], gcols, rows_per_range=rows_per_range)
    totals = counts.groupBy(*gcols).agg(F.sum("__n").alias("__total"))
    cum = (cum.alias("c").join(totals.alias("t"), same_group("c", "t", gcols)).select("c.*", "t.__total"))
    pos = [F.lit(float(q)) * (F.col("__total") - 1) for q in qs]
    # value at rank r = smallest value whose inclusive running count > r
    aggs = []
    for i, p in enumerate(pos):
        aggs.append(F.min(F.when(F.col("cum___n") > F.floor(p), F.col("__v"))).alias(f"__lo{i}"))
        aggs.append(F.min(F.when(F.col("cum___n") > F.ceil(p), F.col("__v"))).alias(f"__hi{i}"))
        aggs.append(F.first(p - F.floor(p)).alias(f"__fr{i}"))
    per = cum.groupBy(*gcols).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("q"),
                 (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__fr{i}")).alias("value"))
        for i, q in enumerate(qs)]))
    res = per.select(*gcols, rows.alias("r")).select(*gcols, "r.q", "r.value")
    return res if group_cols else res.drop(_G)


def scalar_quantile(df: DataFrame, value_col: str, q: float = 0.5) -> Column:
    """Exact quantile of a column, fitted by its own job, as a double
    literal (NULL when the column has no values)."""
    return lit_value(exact_quantiles(df, value_col, [q]), F.max("value"), "double")
