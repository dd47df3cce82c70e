"""Churn labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.columns import ts_lit
from churnlake.params import Params


def latest_per_user(df: DataFrame, key: str, order_cols: list[str], value_cols: list[str],
                    tie_col: str | None = None, alias: str = "__latest") -> DataFrame:
    """Newest row per key as an aggregate (``max_by`` over a struct), so the
    work is a partial + final hash aggregate and a heavy key never lands in
    one window partition."""
    order = F.struct(*[F.col(c) for c in order_cols + ([tie_col] if tie_col else [])])
    vals = F.struct(*[F.col(c) for c in value_cols])
    return (df.groupBy(key).agg(F.max_by(vals, order).alias(alias))
              .select(key, *[F.col(f"{alias}.{c}").alias(c) for c in value_cols]))


def label_churn(subs_clean: DataFrame, params: Params = Params(), latest_over_all: bool = True) -> DataFrame:
    """B1: latest subscription per user ordered by (start, end); users whose
    latest subscription is active at the snapshot (start <= S < end) form the
    cohort; churned = end <= S + label_days; churn_date = end when churned.
    With ``latest_over_all`` (the reference's rule) the latest row is picked
    before the date test, so a subscription starting after S drops the user.
    """
    snap, end = ts_lit(params.snapshot), ts_lit(params.label_end)
    s = subs_clean if latest_over_all else subs_clean.where(F.col("start_date") <= snap)
    tie = "subscription_id" if "subscription_id" in s.columns else None
    latest = latest_per_user(s, "user_id", ["start_date", "end_date"], ["start_date", "end_date"], tie)
    churned = (F.col("end_date") <= end).cast("bigint")
    return (latest.where((F.col("start_date") <= snap) & (F.col("end_date") > snap))
                  .select("user_id", churned.alias("churned"),
                          F.when(churned == 1, F.col("end_date")).alias("churn_date")))


def label_inactive(cohort: DataFrame, orders_raw: DataFrame, params: Params = Params()) -> DataFrame:
    """B2: the documented second half of the churn definition: no order in
    (S, S + label_days].  Cohort users keep their row; ``inactive`` = 1 when
    no order falls in the window."""
    snap, end = ts_lit(params.snapshot), ts_lit(params.label_end)
    buyers = (orders_raw.where((F.col("order_date") > snap) & (F.col("order_date") <= end))
                        .select("user_id").distinct().withColumn("__bought", F.lit(1)))
    return (cohort.select("user_id").join(buyers, "user_id", "left")
                  .select("user_id", F.col("__bought").isNull().cast("bigint").alias("inactive")))


def churn_rate(labels: DataFrame) -> DataFrame:
    """Cohort size, churners, rate."""
    return labels.agg(F.count(F.lit(1)).alias("n_users"),
                      F.sum("churned").cast("bigint").alias("n_churned"),
                      F.avg("churned").alias("churn_rate"))


def week_key(c) -> "F.Column":
    """``%Y-W%V``: calendar year with the ISO week number (2024-12-30 ->
    '2024-W01', as the reference computes it)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.date_format(c, "yyyy"), F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def weekly_order_counts(engagement: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per (user, week key) looked up onto the weekly engagement
    rows; 0 when the user placed no order that week."""
    counts = (orders.groupBy("user_id", week_key("order_date").alias("__wk"))
                    .agg(F.count(F.lit(1)).alias("__n")))
    e = engagement.withColumn("__wk", week_key("week_date"))
    return (e.join(counts, ["user_id", "__wk"], "left")
             .withColumn("n_orders_this_week", F.coalesce(F.col("__n"), F.lit(0)).cast("bigint"))
             .drop("__wk", "__n"))
