"""Per-user features.

One aggregate per source table, each hash-partitioned on ``user_id``, so
the matrix is a chain of co-partitioned left joins.  Ordered quantities
(gaps between orders, plan changes) use ``bucketed_lag_*``: the ordered
history of a user is cut into fixed time buckets, ``lag`` runs inside
(user, bucket) and one small window over the per-bucket first/last rows
stitches the bucket borders.  A user holding a large share of all rows is
thereby spread over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.columns import age_group_code, floor_days, ts_lit
from churnlake.functions.prefix import prefix_sums
from churnlake.params import DIET_VALUES, FEATURES, IMPUTE_DEFAULTS, REFERRAL_VALUES, Params


def _bucket(ts: str, days: int) -> Column:
    return F.floor(F.unix_seconds(F.col(ts)) / F.lit(float(days * 86400)))


def gap_stats(orders: DataFrame, params: Params = Params(), key: str = "user_id",
              ts: str = "order_date") -> DataFrame:
    """Per key: sum and sum of squares of the whole-day gaps between
    consecutive rows ordered by ``ts`` (the number of gaps is rows - 1).

    Equal timestamps give zero gaps, so rows are first reduced to distinct
    (key, ts) (a partial aggregate).  ``lag`` runs inside (key, time
    bucket); the per-bucket sums and first/last stamps are aggregated in
    the partitioning the window already has, and one window over the
    per-bucket rows of a key adds the gaps across bucket borders.  One
    scan of the input.
    """
    dts = (orders.where(F.col(ts).isNotNull()).select(key, ts).distinct()
                 .withColumn("__b", _bucket(ts, params.history_bucket_days)))
    w_in = Window.partitionBy(key, "__b").orderBy(ts)
    g = floor_days(F.col(ts), F.lag(ts).over(w_in))
    per_bucket = (dts.withColumn("__g", g)
                     .groupBy(key, "__b")
                     .agg(F.coalesce(F.sum("__g"), F.lit(0)).alias("__s"),
                          F.coalesce(F.sum(F.col("__g") * F.col("__g")), F.lit(0)).alias("__ss"),
                          F.min(ts).alias("__first"), F.max(ts).alias("__last")))
    w_b = Window.partitionBy(key).orderBy("__b")
    border = F.coalesce(floor_days(F.col("__first"), F.lag("__last").over(w_b)), F.lit(0))
    return (per_bucket.withColumn("__bg", border)
                      .groupBy(key)
                      .agg((F.sum("__s") + F.sum("__bg")).alias("gap_sum"),
                           (F.sum("__ss") + F.sum(F.col("__bg") * F.col("__bg"))).alias("gap_sumsq")))


def sample_std(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares; 0 when
    fewer than two values (pandas ``std`` is NaN there and is filled with 0)."""
    var = (ss.cast("double") - s.cast("double") * s.cast("double") / n) / (n - 1)
    return F.when(n >= 2, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(F.lit(0.0))


def order_features(orders_clean: DataFrame, params: Params = Params(), with_gaps: bool = True) -> DataFrame:
    """C1-C6 in one aggregate over the cleaned orders (already capped at the
    snapshot by ``clean_orders``)."""
    snap = ts_lit(params.snapshot)
    has_coupon = "coupon_used" in orders_clean.columns
    aggs = [
        F.max("order_date").alias("__last"), F.min("order_date").alias("__first"),
        F.count("order_id").alias("total_orders"), F.count("order_date").alias("__n_dated"),
        F.count_if(F.col("order_date") >= ts_lit(params.recent_start)).alias("orders_last_30_days"),
        F.avg("order_value").alias("avg_order_value"),
        F.avg("rating").alias("avg_rating"),
    ]
    if has_coupon:
        aggs += [F.sum(F.col("coupon_used").cast("bigint")).alias("__coupons"),
                 F.count("coupon_used").alias("__coupon_n")]
    base = orders_clean.groupBy("user_id").agg(*aggs)
    cols = [
        "user_id",
        floor_days(snap, F.col("__last")).alias("days_since_last_order"),
        F.greatest(floor_days(snap, F.col("__first")), F.lit(0)).alias("tenure_days"),
        "total_orders", "orders_last_30_days", "avg_order_value", "avg_rating", "__n_dated",
    ]
    if has_coupon:
        cols += [F.coalesce(F.col("__coupons"), F.lit(0)).alias("coupon_usage_count"),
                 (F.col("__coupons") / F.col("__coupon_n")).alias("coupon_usage_rate")]
    else:
        cols += [F.lit(0).cast("bigint").alias("coupon_usage_count"),
                 F.lit(0.0).alias("coupon_usage_rate")]
    out = base.select(*cols)
    if with_gaps:
        g = gap_stats(orders_clean, params)
        n_gaps = F.col("__n_dated") - 1
        out = (out.join(g, "user_id", "left")
                  .withColumn("std_days_between_orders",
                              sample_std(n_gaps, F.coalesce("gap_sum", F.lit(0)), F.coalesce("gap_sumsq", F.lit(0))))
                  .drop("gap_sum", "gap_sumsq"))
    return out.drop("__n_dated")


def plan_change_counts(subs: DataFrame, params: Params = Params()) -> DataFrame:
    """Consecutive different plans ordered by (start, end, id), the first
    row not counted.  A NULL plan always counts as different (NaN != NaN).
    Same plan shape as ``gap_stats``: ``lag`` inside (user, time bucket),
    per-bucket first/last plan, one window over the buckets of a user."""
    tie = ["subscription_id"] if "subscription_id" in subs.columns else []
    order = ["start_date", "end_date", *tie]
    s = subs.withColumn("__b", _bucket("start_date", params.history_bucket_days))

    def changed(cur, prev):
        return F.coalesce(cur != prev, F.lit(True)).cast("bigint")

    w_in = Window.partitionBy("user_id", "__b").orderBy(*order)
    okey = F.struct(*[F.col(c) for c in order])
    per_bucket = (s.withColumn("__ch", F.when(F.row_number().over(w_in) > 1,
                                              changed(F.col("plan_type"), F.lag("plan_type").over(w_in))))
                   .groupBy("user_id", "__b")
                   .agg(F.coalesce(F.sum("__ch"), F.lit(0)).alias("__n"),
                        F.min_by("plan_type", okey).alias("__first_plan"),
                        F.max_by("plan_type", okey).alias("__last_plan")))
    w_b = Window.partitionBy("user_id").orderBy("__b")
    border = F.when(F.row_number().over(w_b) > 1, changed(F.col("__first_plan"), F.lag("__last_plan").over(w_b)))
    return (per_bucket.withColumn("__bc", F.coalesce(border, F.lit(0)))
                      .groupBy("user_id")
                      .agg(F.greatest(F.sum("__n") + F.sum("__bc"), F.lit(0)).cast("bigint").alias("n_plan_changes")))


def subscription_features(subs_clean: DataFrame, params: Params = Params(), as_of: bool = True) -> DataFrame:
    """Plan changes, last non-NULL monthly price by (start, end),
    days since the first start (>= 0).  ``as_of`` keeps only subscriptions
    started by the snapshot (snapshot-safe features)."""
    snap = ts_lit(params.snapshot)
    s = subs_clean.where(F.col("start_date") <= snap) if as_of else subs_clean
    tie = ["subscription_id"] if "subscription_id" in s.columns else []
    okey = F.struct(*[F.col(c) for c in ["start_date", "end_date", *tie]])
    # Rows without a price get a NULL ordering key, which max_by skips: the
    # last non-NULL price wins (pandas ``last``).
    agg = s.groupBy("user_id").agg(
        F.max_by("monthly_price", F.when(F.col("monthly_price").isNotNull(), okey)).alias("monthly_price"),
        F.min("start_date").alias("__first"))
    agg = agg.select("user_id", "monthly_price",
                     F.greatest(floor_days(snap, F.col("__first")), F.lit(0)).alias("subscription_tenure_days"))
    return agg.join(plan_change_counts(s, params), "user_id", "left")


def engagement_features(eng_clean: DataFrame, params: Params = Params()) -> DataFrame:
    """Weeks up to the snapshot: mean logins, mean skipped meals, total
    support tickets (a sum over no values is 0, as in pandas)."""
    e = eng_clean.where(F.col("week_date") <= ts_lit(params.snapshot))
    return e.groupBy("user_id").agg(
        F.avg("app_logins").alias("avg_app_logins"),
        F.avg("meals_skipped").alias("avg_meals_skipped"),
        F.coalesce(F.sum("support_tickets"), F.lit(0)).cast("bigint").alias("total_support_tickets"))


def demographic_features(users_clean: DataFrame, params: Params = Params()) -> DataFrame:
    """C11: age and its right-closed bucket code."""
    return users_clean.select("user_id", F.col("age").cast("bigint").alias("age"),
                              age_group_code("age", params.age_edges).alias("age_group_code"))


def ordinal_encode(df: DataFrame, col: str, order_key: str, out_col: str | None = None) -> DataFrame:
    """Integer codes by first appearance (smallest ``order_key``), NULL
    -> -1.  The code table has one row per distinct value; codes come from
    a prefix count over the values sorted by first appearance."""
    out_col = out_col or f"{col}_code"
    first = (df.where(F.col(col).isNotNull()).groupBy(col)
               .agg(F.min(order_key).alias("__first")).withColumn("__one", F.lit(1)))
    codes = prefix_sums(first, "__first", ["__one"]).select(col, (F.col("cum___one") - 1).alias(out_col))
    return (df.join(codes, col, "left")
              .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(-1)).cast("bigint")))


def one_hot(users_clean: DataFrame) -> DataFrame:
    """0/1 columns for the fixed diet and referral vocabularies; a NULL
    or unknown category is 0 everywhere."""
    return users_clean.select(
        "user_id",
        *[F.coalesce(F.col("dietary_preference") == v, F.lit(False)).cast("bigint").alias(f"diet_{v}") for v in DIET_VALUES],
        *[F.coalesce(F.col("referral_source") == v, F.lit(False)).cast("bigint").alias(f"referral_{v}")
          for v in REFERRAL_VALUES])


def _typed(name: str) -> str:
    doubles = {"std_days_between_orders", "avg_order_value", "avg_rating", "coupon_usage_rate",
               "monthly_price", "avg_app_logins", "avg_meals_skipped"}
    return "double" if name in doubles else "bigint"


def joined_matrix(users_c: DataFrame, orders_c: DataFrame, subs_c: DataFrame, eng_c: DataFrame,
                  labels: DataFrame, params: Params = Params()) -> DataFrame:
    """C13 before imputation: spine of distinct labelled users, left joins
    of the per-source aggregates, label join with churned NULL -> 0."""
    spine = labels.select("user_id").distinct()
    m = (spine.join(order_features(orders_c, params), "user_id", "left")
              .join(subscription_features(subs_c, params), "user_id", "left")
              .join(engagement_features(eng_c, params), "user_id", "left")
              .join(demographic_features(users_c, params), "user_id", "left")
              .join(labels.select("user_id", "churned"), "user_id", "left"))
    return m.select("user_id", *[F.col(f).cast(_typed(f)).alias(f) for f in FEATURES],
                    F.coalesce(F.col("churned"), F.lit(0)).cast("bigint").alias("churned"))


def impute_defaults(df: DataFrame, features=FEATURES, defaults=IMPUTE_DEFAULTS) -> DataFrame:
    """C14: 999 for recency, 30 for age, 0 for every other feature."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults.get(c, 0)).cast(df.schema[c].dataType)).alias(c)
                       if c in features else F.col(c) for c in df.columns])


def filled_cells(df: DataFrame, features=FEATURES, defaults=IMPUTE_DEFAULTS) -> DataFrame:
    """C14 report: one row per (user, feature) cell that imputation fills."""
    stacked = df.select("user_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).isNull().alias("is_null"),
                 F.lit(float(defaults.get(c, 0))).alias("fill_value")) for c in features])).alias("x"))
    return stacked.where("x.is_null").select("user_id", "x.feature", "x.fill_value")


def feature_matrix(users_c, orders_c, subs_c, eng_c, labels, params: Params = Params()) -> DataFrame:
    """C13 + C14: one row per labelled user, 17 features, churned."""
    return impute_defaults(joined_matrix(users_c, orders_c, subs_c, eng_c, labels, params))


def matrix_profile(matrix: DataFrame, label: str = "churned") -> DataFrame:
    """Rows, columns, positive ratio, NULL cells -- one aggregate."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in matrix.columns), F.lit(0))
    return matrix.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.lit(len(matrix.columns)).cast("bigint").alias("n_columns"),
                      F.avg(label).alias("positive_ratio"),
                      nulls.cast("bigint").alias("n_null_cells"))
