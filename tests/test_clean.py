"""Cleaning rules on small frames (the reference ships no tests for them)."""

import pytest
from pyspark.sql import functions as F

from churnlake.operators import clean
from conftest import days


def test_clean_users(spark, params):
    rows = [(1, "2025-01-01 00:00:00", 30, "B", None), (2, "bad", 17, "A", "vegan"),
            (3, "2025-01-02 00:00:00", None, "A", "keto"), (4, "2025-01-03 00:00:00", 101, None, None),
            (5, "2025-01-04 00:00:00", 45, None, "paleo"), (6, "2025-01-05 00:00:00", 60, "A", "vegan"),
            (7, "2025-01-06 00:00:00", 70, None, "keto")]
    u = spark.createDataFrame(rows, "user_id bigint, signup_date string, age int, city string, dietary_preference string")
    got = {r["user_id"]: r for r in clean.clean_users(u, params).collect()}
    assert set(got) == {1, 5, 6, 7}                      # ages 17, NULL, 101 dropped
    assert got[5]["city"] == got[7]["city"] == "A"       # kept rows: one A, one B -> smallest
    assert got[1]["dietary_preference"] == "balanced"
    assert str(got[1]["signup_date"]) == "2025-01-01 00:00:00"


def test_clean_orders_rating_fill(spark, params):
    rows = [(1, 1, days(-5), 10.0, 4), (2, 1, days(-4), 10.0, None), (3, 2, days(-3), 10.0, None),
            (4, 3, days(-2), 10.0, 2), (5, 3, days(-1), -1.0, 5), (6, 3, days(3), 10.0, 5)]
    o = spark.createDataFrame(rows, "order_id bigint, user_id bigint, order_date timestamp, order_value double, "
                                    "rating int").withColumn("meal_plan", F.lit(None).cast("string")) \
        .withColumn("delivery_hour", F.lit(None).cast("string")).withColumn("on_time_delivery", F.lit(None).cast("boolean"))
    got = {r["order_id"]: r for r in clean.clean_orders(o, days(-10), days(0), params).collect()}
    assert set(got) == {1, 2, 3, 4}                      # value <= 0 and after max date dropped
    assert got[2]["rating"] == 4.0                       # user mean
    assert got[3]["rating"] == pytest.approx(4.0)        # median of [4, 4, 2] after the first fill
    assert got[1]["delivery_hour"] == "afternoon" and got[1]["on_time_delivery"] is True


def test_clean_subscriptions_and_engagement(spark, params):
    s = spark.createDataFrame([(1, 1, "p", days(-10), None, None, None, None),
                               (1, 2, "p", days(-10), days(-20), 30.0, "cancelled", "moving"),
                               (2, 3, "q", days(-5), days(5), 50.0, "active", None)],
                              "user_id bigint, subscription_id bigint, plan_type string, start_date timestamp, "
                              "end_date timestamp, monthly_price double, status string, cancellation_reason string")
    got = {r["subscription_id"]: r for r in clean.clean_subscriptions(s, params).collect()}
    assert got[1]["end_date"] == days(20) and got[2]["end_date"] == days(20)
    assert got[1]["monthly_price"] == 40.0 and got[1]["status"] == "active" and got[1]["cancellation_reason"] == ""
    e = spark.createDataFrame([(1, "2025-05-05", -2, 1, None, 3, 0, 1)],
                              "user_id bigint, week_date string, app_logins bigint, recipes_viewed bigint, "
                              "meals_skipped bigint, support_tickets bigint, referral_clicks bigint, "
                              "n_orders_this_week bigint")
    r = clean.clean_engagement(e, params).first()
    assert r["app_logins"] == 0 and r["meals_skipped"] is None and r["support_tickets"] == 3
