"""Registered queries: the feature table (I1-I6).  The published matrix
(one stamp at the snapshot) and a weekly engagement feature table (one
row per user and week, stamped with the week) over which the latest-value
reads, upserts and point-in-time joins run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnlake.functions.columns import ts_lit

from churnlake.operators import feature_table as FT
from churnlake.params import FEATURES
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.registry import query
from churnlake.session import shared_path
from churnlake.sources import io

ENG_FEATURES = ["app_logins", "recipes_viewed", "meals_skipped", "support_tickets", "referral_clicks"]
SPLIT_WEEK = dt.datetime(2001, 5, 21)


def weekly_table(spark, sf_dir):
    e = Domain(spark, sf_dir, P).engagement
    return e.select("user_id", F.col("week_date").alias("event_timestamp"), *ENG_FEATURES)


_WEEKLY_SQL = "weekly AS (SELECT user_id, week_date AS event_timestamp, {cols} FROM clean_eng)".format(
    cols=", ".join(ENG_FEATURES))
_DBL = ["std_days_between_orders", "avg_order_value", "avg_rating", "coupon_usage_rate", "monthly_price",
        "avg_app_logins", "avg_meals_skipped"]


@query("normalize_types", "SELECT * FROM matrix", dbl=_DBL)
def q_normalize_types(spark, sf_dir):
    return FT.normalize_types(Domain(spark, sf_dir, P).matrix)


@query("publish_features", "SELECT * EXCLUDE (churned), TIMESTAMP '2001-06-01 00:00:00' AS event_timestamp, "
       "DATE '2001-06-01' AS event_date FROM matrix", dbl=_DBL, ts=["event_timestamp"])
def q_publish_features(spark, sf_dir):
    pub = FT.publish_features(Domain(spark, sf_dir, P).matrix, P.snapshot)
    path = shared_path(spark, "feature_table")
    io.write_partitioned(pub, path, ["event_date"])
    back = io.read_parquet(spark, path)
    return back.select(*pub.columns)


@query("latest_features", f"""
  WITH {_WEEKLY_SQL}
  SELECT user_id, event_timestamp, {", ".join(ENG_FEATURES)} FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn FROM weekly
    WHERE event_timestamp <= TIMESTAMP '2001-06-01 00:00:00'
      AND event_timestamp >= TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 3650 DAY
      AND user_id IN (SELECT user_id FROM labels)) WHERE rn = 1""", ts=["event_timestamp"])
def q_latest_features(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    return FT.latest_features(weekly_table(spark, sf_dir), P.snapshot, 3650, ENG_FEATURES, ids=d.labels)


@query("merge_incremental", f"""
  WITH {_WEEKLY_SQL}
  SELECT user_id, event_timestamp, {", ".join(ENG_FEATURES)} FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC,
                                 (event_timestamp >= TIMESTAMP '2001-05-21 00:00:00') DESC) AS rn FROM weekly)
  WHERE rn = 1""", ts=["event_timestamp"])
def q_merge_incremental(spark, sf_dir):
    t = weekly_table(spark, sf_dir)
    split = ts_lit(SPLIT_WEEK)
    return FT.merge_incremental(t.where(F.col("event_timestamp") < split), t.where(F.col("event_timestamp") >= split))


@query("point_in_time_join", f"""
  WITH {_WEEKLY_SQL}
  SELECT o.order_id, o.user_id, o.order_date AS label_ts, w.event_timestamp AS feature_ts,
         {", ".join("w." + c for c in ENG_FEATURES)}
  FROM raw_orders o LEFT JOIN LATERAL (
    SELECT * FROM weekly w WHERE w.user_id = o.user_id AND w.event_timestamp <= o.order_date
      AND w.event_timestamp >= o.order_date - INTERVAL 3650 DAY
    ORDER BY w.event_timestamp DESC LIMIT 1) w ON true""", ts=["label_ts", "feature_ts"])
def q_point_in_time_join(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    ev = d.raw_orders.select("order_id", "user_id", F.col("order_date").alias("label_ts"))
    return FT.point_in_time_join(ev, weekly_table(spark, sf_dir), "order_id", 3650, features=ENG_FEATURES)


@query("retrieval_null_check", f"""
  WITH {_WEEKLY_SQL},
  got AS (SELECT l.user_id, {", ".join("r." + c for c in ENG_FEATURES)} FROM labels l LEFT JOIN (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn
                   FROM weekly WHERE event_timestamp <= TIMESTAMP '2001-06-01 00:00:00') WHERE rn = 1) r USING (user_id))
  SELECT feature, n_null FROM (UNPIVOT (SELECT {", ".join(f"count_if({c} IS NULL) AS {c}" for c in ENG_FEATURES)}
                                        FROM got) ON {", ".join(ENG_FEATURES)} INTO NAME feature VALUE n_null)
  WHERE n_null > 0""")
def q_retrieval_null_check(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    got = d.labels.select("user_id").join(
        FT.latest_features(weekly_table(spark, sf_dir), P.snapshot, 3650, ENG_FEATURES), "user_id", "left")
    return FT.retrieval_null_check(got, ENG_FEATURES)
