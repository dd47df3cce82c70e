"""Deterministic stratified splits and folds.

Rows are ordered inside each class by a hash of (id, seed) -- the same md5
text DuckDB computes -- so the split is repeatable, independent of the
partitioning and safe to recompute after an executor loss (unlike
``randomSplit`` after a shuffle).  Ranks come from range-partitioned prefix
counts, so a class holding most rows is still spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.prefix import prefix_sums
from churnlake.functions.stats import one_row
from churnlake.session import cut_lineage

#: Rows that one task of a forest fit takes.
ROWS_PER_FIT_TASK = 30_000


def hash_order(key: str, seed: int) -> Column:
    """First 60 bits of md5('<id>|<seed>') as a bigint."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def class_ranks(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Adds ``__rank`` (1-based position of the row inside its class in hash
    order) and ``__n_class``. The rows are written once: the row count, the
    ranges, their totals and the ranks all read them."""
    x = cut_lineage(df.withColumn("__h", hash_order(key, seed)).withColumn("__one", F.lit(1)))
    ranked = prefix_sums(x, "__h", ["__one"], [label]).withColumnRenamed("cum___one", "__rank")
    sizes = x.groupBy(label).agg(F.count(F.lit(1)).alias("__n_class"))
    return ranked.join(F.broadcast(sizes), label).drop("__h", "__one")


def stratified_split(df: DataFrame, label: str = "churned", key: str = "user_id", seed: int = 42,
                     test_frac: float = 0.2, val_frac: float = 0.25) -> DataFrame:
    """Per class, the first ceil(n * test_frac) rows in hash order are
    test, the next ceil((n - n_test) * val_frac) validation, the rest
    train (60/20/20 with the defaults).  Adds ``split``."""
    r = class_ranks(df, label, key, seed)
    n = F.col("__n_class")
    n_test = F.ceil(n * F.lit(test_frac))
    n_val = F.ceil((n - n_test) * F.lit(val_frac))
    split = (F.when(F.col("__rank") <= n_test, "test")
              .when(F.col("__rank") <= n_test + n_val, "validation").otherwise("train"))
    return r.withColumn("split", split).drop("__rank", "__n_class")


def stratified_folds(df: DataFrame, k: int, label: str = "churned", key: str = "user_id",
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds for cross-validation: rows dealt round-robin to the
    k folds in hash order inside each class."""
    r = class_ranks(df, label, key, seed)
    return r.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__n_class")


def class_weights(df: DataFrame, label: str = "churned", pos_factor: float = 1.0) -> DataFrame:
    """Balanced weights n / (2 n_class), positives multiplied by
    ``pos_factor``: one row per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = one_row(c.agg(F.sum("n_class").alias("n")))["n"]
    w = F.lit(float(total)) / (2.0 * F.col("n_class"))
    return c.select(label, "n_class",
                    F.when(F.col(label) == 1, w * F.lit(float(pos_factor))).otherwise(w).alias("weight"))


def with_weights(df: DataFrame, label: str = "churned", balanced: bool = True, pos_factor: float = 1.0,
                 out: str = "weight", fit_on: DataFrame | None = None) -> DataFrame:
    """Adds the class weight of each row; balanced weights are counted on
    ``fit_on`` (the training rows) when given, else on ``df`` itself."""
    if not balanced:
        return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(pos_factor))).otherwise(1.0))
    w = class_weights(df if fit_on is None else fit_on, label, pos_factor).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label)       # one row per class


def spread_rows(df: DataFrame, key: str = "user_id") -> DataFrame:
    """``df`` dealt out evenly for a forest fit, whose time goes with rows times trees: AQE packs rows
    into tasks by their few bytes, and ranks leave a class in a handful of ranges. The number of
    tasks follows from the rows alone, so a fit is repeatable on any cluster. A frame of one task stays as it is."""
    tasks = math.ceil(df.count() / ROWS_PER_FIT_TASK)
    return df if tasks <= 1 else df.repartition(tasks, key).sortWithinPartitions(key)
