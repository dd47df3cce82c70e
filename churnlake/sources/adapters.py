"""Adapters from the driver's TPC-H-like tables to the churn domain.

The driver data has no users/orders/subscriptions/engagement tables, so
each domain table is a projection (or, for engagement, an aggregation) of a
driver table.  The mapping is fixed so that the DuckDB oracle can repeat it
(see ``churnlake.plans.oracle``).  Some rows are deliberately made dirty
(NULLs, out-of-range values, unparseable dates) by rules on the keys so the
cleaning operators have work to do.

Fixed values of the mapping:

* users   <- customer ⋈ nation: user_id=c_custkey,
  signup_date = '1994-12-01' + (c_custkey % 30) days as text, 'not-a-date'
  when c_custkey % 41 = 5; age = 18 + c_custkey % 63, NULL when
  c_custkey % 50 = 7, 150 when c_custkey % 50 = 13; city = n_name, NULL when
  c_custkey % 10 = 0; diet from DIET_VALUES by c_nationkey % 6, NULL when
  c_custkey % 10 = 3; referral from REFERRAL_VALUES by c_custkey % 7;
  is_active = c_acctbal > 0.
* orders  <- orders: order_id=o_orderkey, user_id=o_custkey,
  order_date=o_orderdate, order_value=o_totalprice (negated when
  o_orderkey % 97 = 0), meal_plan from MEAL_PLANS by o_orderkey % 4 (NULL
  when % 10 = 2), delivery_hour from HOURS by o_orderkey % 3 (NULL when
  % 10 = 4), rating = 6 - priority digit (NULL when % 10 = 0),
  on_time_delivery = status <> 'O' (NULL when % 10 = 6), coupon_used =
  status = 'P'.
* subscriptions <- orders: subscription_id=o_orderkey, plan_type =
  o_orderpriority (NULL when o_orderkey % 23 = 0), start_date=o_orderdate,
  end_date = start + (o_orderkey % 400) days (NULL when % 31 = 0,
  start - 5 days when % 53 = 0), monthly_price = 20.99 + o_orderkey % 80
  (NULL when % 37 = 0), status F->cancelled, O->active, else NULL,
  cancellation_reason from REASONS by o_orderkey % 4 for cancelled rows.
* engagement <- events, weekly per user: event time moved back by
  EVENT_SHIFT_DAYS (a whole number of weeks) so the stream ends just before
  the order snapshot; logins=views, recipes=clicks, skipped=errors (negated
  when user_id % 17 = 0), tickets=signups (NULL when user_id % 10 = 0),
  referral clicks = n_orders_this_week = purchases.
* request log <- events: failed = event_type 'error', latency = value.
* scored rows <- lineitem: y = (l_returnflag = 'R'), p = l_discount * 10.
* drift reference / current <- lineitem shipped before / from 1998-06-01.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.columns import ts_lit
from churnlake.params import DIET_VALUES, REFERRAL_VALUES
from churnlake.sources.tables import load_table

# Fixed values of the mapping (see module docstring).
MEAL_PLANS = ["weekly_classic", "weekly_vegan", "monthly_premium", "biweekly_standard"]
HOURS = ["morning", "afternoon", "evening"]
REASONS = ["too_expensive", "delivery_issues", "not_enough_variety", "moving"]
SIGNUP_BASE = dt.datetime(1994, 12, 1)
EVENT_SHIFT_DAYS = 8274          # 2024-01-01 -> 2001-05-07, 1182 weeks
DRIFT_SPLIT = dt.datetime(1998, 6, 1)
DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_linenumber", "returnflag_code", "linestatus_code"]


def _pick(values, idx_col):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx_col + 1).cast("int"))


def _add_days(ts, days):
    return F.timestamp_add("DAY", days.cast("int") if not isinstance(days, int) else F.lit(days), ts)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load_table(spark, sf_dir, "customer")
    n = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    signup = _add_days(ts_lit(SIGNUP_BASE), k % 30)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                k.alias("user_id"),
                F.when(k % 41 == 5, F.lit("not-a-date"))
                 .otherwise(F.date_format(signup, "yyyy-MM-dd HH:mm:ss")).alias("signup_date"),
                F.when(k % 50 == 7, F.lit(None).cast("int"))
                 .when(k % 50 == 13, F.lit(150))
                 .otherwise((F.lit(18) + k % 63).cast("int")).alias("age"),
                F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("city"),
                F.when(k % 10 == 3, F.lit(None).cast("string"))
                 .otherwise(_pick(DIET_VALUES, F.col("c_nationkey") % 6)).alias("dietary_preference"),
                _pick(REFERRAL_VALUES, k % 7).alias("referral_source"),
                (F.col("c_acctbal") > 0).alias("is_active"),
            ))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        F.when(k % 97 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("order_value"),
        F.when(k % 10 == 2, F.lit(None).cast("string")).otherwise(_pick(MEAL_PLANS, k % 4)).alias("meal_plan"),
        F.when(k % 10 == 4, F.lit(None).cast("string")).otherwise(_pick(HOURS, k % 3)).alias("delivery_hour"),
        F.when(k % 10 == 0, F.lit(None).cast("int")).otherwise(F.lit(6) - digit).alias("rating"),
        F.when(k % 10 == 6, F.lit(None).cast("boolean"))
         .otherwise(F.col("o_orderstatus") != "O").alias("on_time_delivery"),
        (F.col("o_orderstatus") == "P").alias("coupon_used"),
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        k.alias("subscription_id"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("plan_type"),
        start.alias("start_date"),
        F.when(k % 31 == 0, ts_lit(None))
         .when(k % 53 == 0, _add_days(start, -5))
         .otherwise(_add_days(start, k % 400)).alias("end_date"),
        F.when(k % 37 == 0, F.lit(None).cast("double"))
         .otherwise((k % 80).cast("double") + F.lit(20.99)).alias("monthly_price"),
        F.when(F.col("o_orderstatus") == "F", "cancelled")
         .when(F.col("o_orderstatus") == "O", "active").alias("status"),
        F.when(F.col("o_orderstatus") == "F", _pick(REASONS, k % 4)).alias("cancellation_reason"),
    )


def raw_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load_table(spark, sf_dir, "events")
    t = F.col("event_type")
    u = F.col("user_id")
    weekly = (e.select("user_id", "event_type",
                       F.date_trunc("week", _add_days(F.col("ts"), -EVENT_SHIFT_DAYS)).alias("week_date"))
              .groupBy("user_id", "week_date")
              .agg(F.count_if(t == "view").alias("views"),
                   F.count_if(t == "click").alias("clicks"),
                   F.count_if(t == "error").alias("errors"),
                   F.count_if(t == "signup").alias("signups"),
                   F.count_if(t == "purchase").alias("purchases")))
    return weekly.select(
        "user_id",
        F.date_format("week_date", "yyyy-MM-dd").alias("week_date"),
        F.col("views").alias("app_logins"),
        F.col("clicks").alias("recipes_viewed"),
        F.when(u % 17 == 0, -F.col("errors")).otherwise(F.col("errors")).alias("meals_skipped"),
        F.when(u % 10 == 0, F.lit(None).cast("bigint")).otherwise(F.col("signups")).alias("support_tickets"),
        F.col("purchases").alias("referral_clicks"),
        F.col("purchases").alias("n_orders_this_week"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service request log: one row per event, failed = error event,
    latency = value (seconds)."""
    e = load_table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("request_id"), "ts",
                    (F.col("event_type") == "error").alias("failed"),
                    F.col("value").alias("latency"))


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, p) frame: y = returned line, p = discount * 10 (many ties)."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10).alias("p"),
    )


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference (shipped before the split) and current (from the split)
    numeric frames for the drift operators."""
    li = load_table(spark, sf_dir, "lineitem")
    cols = [
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
         .otherwise(2.0).alias("returnflag_code"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("linestatus_code"),
    ]
    split = ts_lit(DRIFT_SPLIT)
    ref = li.filter(F.col("l_shipdate") < split).select(*cols)
    cur = li.filter(F.col("l_shipdate") >= split).select(*cols)
    return ref, cur
