"""Feature operators on the reference's hand-made fixtures (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from churnlake.operators import features as FE
from churnlake.operators import labels as LB
from conftest import days

ORDERS = [
    (101, 1, days(-30), 30.0, "weekly_classic", "morning", 4, True, False),
    (102, 1, days(-20), 55.0, "weekly_vegan", "afternoon", 5, True, False),
    (103, 1, days(-10), 25.0, "weekly_classic", "morning", 3, False, True),
    (201, 2, days(-60), 100.0, "monthly_premium", "evening", 2, True, True),
    (202, 2, days(-5), 40.0, "weekly_classic", "afternoon", 4, True, False),
    (301, 3, days(-1), 15.0, "biweekly_standard", "morning", 5, True, False),
]
ORDER_SCHEMA = ("order_id bigint, user_id bigint, order_date timestamp, order_value double, meal_plan string, "
                "delivery_hour string, rating int, on_time_delivery boolean, coupon_used boolean")


@pytest.fixture(scope="module")
def order_feats(spark, params):
    o = spark.createDataFrame(ORDERS, ORDER_SCHEMA)
    return {r["user_id"]: r.asDict() for r in FE.order_features(o, params).collect()}


def test_recency_and_tenure(order_feats):
    assert order_feats[1]["days_since_last_order"] == 10
    assert order_feats[2]["days_since_last_order"] == 5
    assert order_feats[3]["days_since_last_order"] == 1
    assert [order_feats[u]["tenure_days"] for u in (1, 2, 3)] == [30, 60, 1]


def test_frequency_and_gaps(order_feats):
    assert [order_feats[u]["total_orders"] for u in (1, 2, 3)] == [3, 2, 1]
    assert all(order_feats[u]["std_days_between_orders"] == 0 for u in (1, 2, 3))
    assert [order_feats[u]["orders_last_30_days"] for u in (1, 2, 3)] == [3, 1, 1]


def test_monetary_and_coupons(order_feats):
    assert order_feats[1]["avg_order_value"] == pytest.approx(36.6667, abs=1e-4)
    assert order_feats[1]["avg_rating"] == pytest.approx(4.0)
    assert order_feats[1]["coupon_usage_count"] == 1
    assert order_feats[1]["coupon_usage_rate"] == pytest.approx(1 / 3)
    assert order_feats[2]["coupon_usage_rate"] == pytest.approx(0.5)
    assert order_feats[3]["coupon_usage_count"] == 0


def test_gap_std_sample(spark, params):
    o = spark.createDataFrame([(1, 1, days(-30)), (2, 1, days(-20)), (3, 1, days(-5)), (4, 1, days(-5))],
                              "order_id bigint, user_id bigint, order_date timestamp")
    g = FE.gap_stats(o, params).first()
    # gaps 10, 15, 0 -> sample std
    import statistics
    std = FE.order_features(o.withColumn("order_value", F.lit(1.0)).withColumn("rating", F.lit(1)), params) \
        .first()["std_days_between_orders"]
    assert g["gap_sum"] == 25 and g["gap_sumsq"] == 325
    assert std == pytest.approx(statistics.stdev([10, 15, 0]))


def test_gap_std_across_buckets(spark):
    """Bucket borders are stitched: same answer with 1-day buckets."""
    from churnlake.params import Params
    o = spark.createDataFrame([(i, 1, days(-3 * i)) for i in range(1, 9)],
                              "order_id bigint, user_id bigint, order_date timestamp")
    a = FE.gap_stats(o, Params(snapshot=days(0), history_bucket_days=1)).first()
    b = FE.gap_stats(o, Params(snapshot=days(0), history_bucket_days=365)).first()
    assert (a["gap_sum"], a["gap_sumsq"]) == (b["gap_sum"], b["gap_sumsq"]) == (21, 63)


def test_single_order_without_coupon_column(spark, params):
    o = spark.createDataFrame([(101, 1, days(-15), 50.0, 4)],
                              "order_id bigint, user_id bigint, order_date timestamp, order_value double, rating int")
    r = FE.order_features(o, params).first()
    assert r["days_since_last_order"] == 15 and r["total_orders"] == 1
    assert r["std_days_between_orders"] == 0 and r["coupon_usage_count"] == 0 and r["coupon_usage_rate"] == 0.0


SUBS = [
    (1, 1, "weekly_basic", days(-180), days(-100), 49.0, "cancelled", "too_expensive"),
    (1, 2, "monthly_premium", days(-90), days(30), 79.0, "active", ""),
    (2, 3, "weekly_basic", days(-120), days(-10), 49.0, "cancelled", "delivery_issues"),
    (3, 4, "monthly_basic", days(-60), days(60), 59.0, "active", ""),
]
SUB_SCHEMA = ("user_id bigint, subscription_id bigint, plan_type string, start_date timestamp, end_date timestamp, "
              "monthly_price double, status string, cancellation_reason string")


def test_subscription_features(spark, params):
    s = spark.createDataFrame(SUBS, SUB_SCHEMA)
    r = {x["user_id"]: x for x in FE.subscription_features(s, params).collect()}
    assert [r[u]["n_plan_changes"] for u in (1, 2, 3)] == [1, 0, 0]
    assert [r[u]["subscription_tenure_days"] for u in (1, 2, 3)] == [180, 120, 60]
    assert [r[u]["monthly_price"] for u in (1, 2, 3)] == [79.0, 49.0, 59.0]
    assert "is_sub_active" not in r[1].asDict()


def test_plan_changes_null_counts_as_change(spark, params):
    rows = [(1, i, p, days(-100 + 10 * i), days(-90 + 10 * i), 10.0, "a", "")
            for i, p in enumerate(["a", "a", None, None, "b", "b"])]
    s = spark.createDataFrame(rows, SUB_SCHEMA)
    # a a N N b b: changes at a->N, N->N, N->b  = 3
    assert FE.plan_change_counts(s, params).first()["n_plan_changes"] == 3


def test_labels_from_subscriptions(spark, params):
    s = spark.createDataFrame(SUBS, SUB_SCHEMA)
    r = {x["user_id"]: x["churned"] for x in LB.label_churn(s, params).collect()}
    assert r == {1: 1, 3: 0}


def test_label_cohort(spark, params):
    rows = [(u, u, "p", days(-100), days(e), 1.0, "active", "") for u, e in ((1, 10), (2, 60), (3, -1))]
    s = spark.createDataFrame(rows, SUB_SCHEMA)
    r = {x["user_id"]: x["churned"] for x in LB.label_churn(s, params).collect()}
    assert r == {1: 1, 2: 0}


def test_engagement(spark, params):
    e = spark.createDataFrame([(1, days(-21), 4, 10, 0, 0, 1, 2), (1, days(-7), 2, 5, 1, 1, 0, 1),
                               (2, days(-14), 0, 1, 3, 2, 0, 0)],
                              "user_id bigint, week_date timestamp, app_logins bigint, recipes_viewed bigint, "
                              "meals_skipped bigint, support_tickets bigint, referral_clicks bigint, "
                              "n_orders_this_week bigint")
    r = {x["user_id"]: x for x in FE.engagement_features(e, params).collect()}
    assert r[1]["avg_app_logins"] == 3 and r[1]["avg_meals_skipped"] == 0.5 and r[1]["total_support_tickets"] == 1
    assert r[2]["avg_app_logins"] == 0 and r[2]["avg_meals_skipped"] == 3 and r[2]["total_support_tickets"] == 2


def test_age_buckets(spark, params):
    ages = [25, 45, 65, 26, 35, 36, 50, 51, 101, None]
    u = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "user_id bigint, age int")
    got = [r["age_group_code"] for r in FE.demographic_features(u, params).orderBy("user_id").collect()]
    assert got == [0, 2, 3, 1, 1, 2, 2, 3, 0, 0]
    assert FE.demographic_features(u, params).columns == ["user_id", "age", "age_group_code"]


def test_no_leak_after_snapshot(spark, params):
    """Rows after the snapshot change nothing in the snapshot-safe features."""
    s = spark.createDataFrame(SUBS, SUB_SCHEMA)
    later = spark.createDataFrame([(1, 9, "x", days(5), days(50), 999.0, "active", "")], SUB_SCHEMA)
    a = sorted(FE.subscription_features(s, params).collect())
    b = sorted(FE.subscription_features(s.unionByName(later), params).collect())
    assert a == b
