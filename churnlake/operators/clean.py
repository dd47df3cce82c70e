"""Cleaning of the raw domain tables.

Every function keeps the raw column set, repairs values with the defaults
in ``Params`` and, with ``flag_col``, adds a boolean column telling whether
the row had a value filled or repaired (used by the cleaning profile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.columns import ts_lit
from churnlake.functions.prefix import scalar_quantile
from churnlake.functions.stats import lit_value, one_row
from churnlake.params import Params

ENGAGEMENT_COUNTERS = ["app_logins", "recipes_viewed", "meals_skipped", "support_tickets", "referral_clicks"]


def parse_ts(df: DataFrame, c: str) -> Column:
    """Text -> timestamp, unparseable -> NULL (pandas ``errors='coerce'``).
    A timestamp column passes through unchanged, so filters on it reach the
    scan."""
    if isinstance(df.schema[c].dataType, T.TimestampType):
        return F.col(c)
    return F.try_to_timestamp(F.col(c).cast("string"))


def _any_null(*cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def clean_users(users: DataFrame, params: Params = Params(), flag_col: str | None = None) -> DataFrame:
    """A1: parse signup_date; keep 18 <= age <= 100 (NULL age dropped); NULL
    city -> mode of the kept rows (smallest on ties, 'Unknown' if none);
    NULL diet -> 'balanced'.  The fitted mode and the earliest signup date
    (needed by ``clean_orders``) come from one job; the latter is kept on
    the frame's ``min_signup_date`` attribute."""
    kept = users.withColumn("signup_date", parse_ts(users, "signup_date")).where(F.col("age").between(18, 100))
    if flag_col:
        kept = kept.withColumn(flag_col, _any_null("city", "dietary_preference"))
    per_city = kept.groupBy("city").agg(F.count(F.lit(1)).alias("__n"), F.min("signup_date").alias("__s"))
    fit = one_row(per_city.agg(
        F.min_by(F.col("city"), F.when(F.col("city").isNotNull(),
                                       F.struct((-F.col("__n")).alias("n"), F.col("city").alias("v"))))
         .alias("mode"),
        F.min("__s").alias("min_signup")))
    mode_city = F.lit(fit["mode"]).cast("string")
    out = (kept.withColumn("city", F.coalesce(F.col("city"), mode_city, F.lit(params.default_city)))
               .withColumn("dietary_preference",
                           F.coalesce(F.col("dietary_preference"), F.lit(params.default_diet))))
    out.min_signup_date = fit["min_signup"]
    return out


def min_signup(users_clean: DataFrame) -> Column:
    if getattr(users_clean, "min_signup_date", None) is not None:
        return F.lit(users_clean.min_signup_date).cast("timestamp")
    return lit_value(users_clean, F.min("signup_date"), "timestamp")


def clean_orders(orders: DataFrame, min_date, max_date, params: Params = Params(),
                 flag_col: str | None = None) -> DataFrame:
    """A2 + A3: keep ``min_date <= order_date <= max_date`` and
    ``order_value > 0``; NULL rating -> the user's mean rating over the kept
    rows, then the median of that column; defaults for delivery fields.

    The per-user mean is an aggregate joined back on user_id (AQE splits a
    heavy user's partition), not a window that would put a heavy user in one
    task.  Rows with a NULL user_id get the median, as in the reference.
    """
    min_date = min_date if isinstance(min_date, Column) else ts_lit(min_date)
    max_date = max_date if isinstance(max_date, Column) else ts_lit(max_date)
    o = orders.withColumn("order_date", parse_ts(orders, "order_date"))
    o = o.where((F.col("order_date") >= min_date) & (F.col("order_date") <= max_date)
                & (F.col("order_value") > 0))
    # Only the unrated rows need the user's mean: the rated rows are not
    # shuffled for this join, and the per-user means are a partial aggregate.
    # Rows without a user id take the median even when rated (a group-wise
    # fill has no group for them).
    has = F.col("rating").isNotNull() & F.col("user_id").isNotNull()
    user_mean = o.where(has).groupBy("user_id").agg(F.avg("rating").alias("__user_rating"))
    rated = o.where(has).withColumn("__r1", F.col("rating").cast("double"))
    unrated = (o.where(~has).join(user_mean, "user_id", "left")
                .withColumn("__r1", F.col("__user_rating")).drop("__user_rating"))
    o = rated.unionByName(unrated)
    if flag_col:
        o = o.withColumn(flag_col, _any_null("rating", "on_time_delivery", "delivery_hour", "meal_plan"))
    med = scalar_quantile(o, "__r1", 0.5)
    cols = [c for c in orders.columns]
    return (o.withColumn("rating", F.coalesce(F.col("__r1"), med))
             .withColumn("on_time_delivery", F.coalesce(F.col("on_time_delivery"), F.lit(True)))
             .withColumn("delivery_hour", F.coalesce(F.col("delivery_hour"), F.lit(params.default_delivery_hour)))
             .withColumn("meal_plan", F.coalesce(F.col("meal_plan"), F.lit(params.default_meal_plan)))
             .select(*cols, *([flag_col] if flag_col else [])))


def clean_subscriptions(subs: DataFrame, params: Params = Params(), flag_col: str | None = None) -> DataFrame:
    """A4: NULL or too-early end -> start + 30 days; NULL price -> median
    price; NULL status -> 'active'; NULL reason -> ''."""
    s = (subs.withColumn("start_date", parse_ts(subs, "start_date"))
             .withColumn("end_date", parse_ts(subs, "end_date")))
    fixed_end = F.timestamp_add("DAY", F.lit(params.default_end_days), F.col("start_date"))
    if flag_col:
        s = s.withColumn(flag_col, _any_null("end_date", "monthly_price", "status", "cancellation_reason")
                         | (F.col("end_date") < F.col("start_date")))
    med = scalar_quantile(s, "monthly_price", 0.5)
    return (s.withColumn("end_date", F.when(F.col("end_date").isNull() | (F.col("end_date") < F.col("start_date")),
                                            fixed_end).otherwise(F.col("end_date")))
             .withColumn("monthly_price", F.coalesce(F.col("monthly_price"), med))
             .withColumn("status", F.coalesce(F.col("status"), F.lit(params.default_status)))
             .withColumn("cancellation_reason", F.coalesce(F.col("cancellation_reason"), F.lit(""))))


def clean_engagement(eng: DataFrame, params: Params = Params(), flag_col: str | None = None) -> DataFrame:
    """A5: parse week_date; negative counters -> 0 (NULL stays NULL; not
    ``greatest``, which would turn NULL into 0)."""
    e = eng.withColumn("week_date", parse_ts(eng, "week_date"))
    if flag_col:
        neg = F.lit(False)
        for c in ENGAGEMENT_COUNTERS:
            neg = neg | F.coalesce(F.col(c) < 0, F.lit(False))
        e = e.withColumn(flag_col, neg)
    for c in ENGAGEMENT_COUNTERS:
        e = e.withColumn(c, F.when(F.col(c) < 0, F.lit(0).cast(eng.schema[c].dataType)).otherwise(F.col(c)))
    return e


def clean_labels(labels: DataFrame) -> DataFrame:
    """Drop rows without a label."""
    return labels.dropna(subset=["churned"])


def clean_profile(pairs: dict[str, tuple[DataFrame, DataFrame]], flag_col: str = "filled") -> DataFrame:
    """One row per table: rows in, rows kept, rows with a filled value.
    ``pairs`` maps table name -> (raw, cleaned-with-flag).  One aggregate per
    side, no second pass over the cleaned rows."""
    out = None
    for name, (raw, cleaned) in pairs.items():
        zero = F.lit(0).cast("bigint")
        rows = (raw.agg(F.count(F.lit(1)).alias("rows_in")).select("rows_in", zero.alias("rows_kept"), zero.alias("rows_filled"))
                   .unionByName(cleaned.agg(F.count(F.lit(1)).alias("rows_kept"), F.count_if(F.col(flag_col)).alias("rows_filled"))
                                       .select(zero.alias("rows_in"), "rows_kept", "rows_filled")))
        row = rows.select(F.lit(name).alias("table_name"), "rows_in", "rows_kept", "rows_filled")
        out = row if out is None else out.unionByName(row)
    return out.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_kept", "rows_filled")])
