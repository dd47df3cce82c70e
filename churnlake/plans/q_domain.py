"""Registered queries: cleaning (A), quality rules (D), labels (B) and
features (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions.columns import ts_lit

from churnlake.operators import clean, features, labels
from churnlake.params import Params
from churnlake.plans.domain import Domain
from churnlake.plans.registry import query

P = Params()


def D(spark, sf_dir) -> Domain:
    return Domain(spark, sf_dir, P)


# --- A: cleaning -----------------------------------------------------------

@query("clean_users", "SELECT * FROM clean_users", ts=["signup_date"])
def q_clean_users(spark, sf_dir):
    return D(spark, sf_dir).users


@query("clean_orders", "SELECT * FROM clean_orders", dbl=["rating"], ts=["order_date"])
def q_clean_orders(spark, sf_dir):
    return D(spark, sf_dir).orders


@query("impute_rating", """
  SELECT order_id, user_id, rating FROM clean_orders
  WHERE order_id IN (SELECT order_id FROM raw_orders WHERE rating IS NULL)""", dbl=["rating"])
def q_impute_rating(spark, sf_dir):
    d = D(spark, sf_dir)
    missing = d.raw_orders.where(F.col("rating").isNull()).select("order_id")
    return d.orders.join(missing, "order_id", "left_semi").select("order_id", "user_id", "rating")


@query("clean_subscriptions", "SELECT * FROM clean_subs", ts=["start_date", "end_date"])
def q_clean_subscriptions(spark, sf_dir):
    return D(spark, sf_dir).subscriptions


@query("clean_engagement", "SELECT * FROM clean_eng", ts=["week_date"])
def q_clean_engagement(spark, sf_dir):
    return D(spark, sf_dir).engagement


@query("clean_labels", "SELECT * FROM labels WHERE churned IS NOT NULL", ts=["churn_date"])
def q_clean_labels(spark, sf_dir):
    return clean.clean_labels(D(spark, sf_dir).labels)


@query("clean_profile", """
  SELECT 'users' AS table_name, (SELECT count(*) FROM raw_users) AS rows_in, count(*) AS rows_kept,
         count_if(city IS NULL OR dietary_preference IS NULL) AS rows_filled FROM u_kept
  UNION ALL
  SELECT 'orders', (SELECT count(*) FROM raw_orders), count(*),
         count_if(rating IS NULL OR on_time_delivery IS NULL OR delivery_hour IS NULL OR meal_plan IS NULL)
  FROM o_kept
  UNION ALL
  SELECT 'subscriptions', count(*), count(*),
         count_if(end_date IS NULL OR monthly_price IS NULL OR status IS NULL OR cancellation_reason IS NULL
                  OR end_date < start_date) FROM raw_subs
  UNION ALL
  SELECT 'engagement', count(*), count(*),
         count_if(coalesce(app_logins < 0, false) OR coalesce(recipes_viewed < 0, false)
                  OR coalesce(meals_skipped < 0, false) OR coalesce(support_tickets < 0, false)
                  OR coalesce(referral_clicks < 0, false)) FROM raw_eng""",
       ints=["rows_in", "rows_kept", "rows_filled"])
def q_clean_profile(spark, sf_dir):
    d = D(spark, sf_dir)
    flag = "filled"
    users_f = clean.clean_users(d.raw_users, P, flag_col=flag)
    orders_f = clean.clean_orders(d.raw_orders, clean.min_signup(d.users), P.snapshot, P, flag_col=flag)
    return clean.clean_profile({
        "users": (d.raw_users, users_f),
        "orders": (d.raw_orders, orders_f),
        "subscriptions": (d.raw_subscriptions, clean.clean_subscriptions(d.raw_subscriptions, P, flag)),
        "engagement": (d.raw_engagement, clean.clean_engagement(d.raw_engagement, P, flag)),
    }, flag)


# --- B: labels --------------------------------------------------------------

@query("label_churn", "SELECT * FROM labels", ts=["churn_date"])
def q_label_churn(spark, sf_dir):
    return D(spark, sf_dir).labels


@query("label_inactive", f"""
  SELECT l.user_id, CAST(b.user_id IS NULL AS BIGINT) AS inactive
  FROM labels l LEFT JOIN (SELECT DISTINCT user_id FROM raw_orders
                           WHERE order_date > TIMESTAMP '2001-06-01' AND order_date <= TIMESTAMP '2001-07-01') b
  USING (user_id)""")
def q_label_inactive(spark, sf_dir):
    d = D(spark, sf_dir)
    return labels.label_inactive(d.labels, d.raw_orders, P)


@query("churn_rate", """
  SELECT count(*) AS n_users, CAST(sum(churned) AS BIGINT) AS n_churned, avg(churned) AS churn_rate FROM labels""",
       dbl=["churn_rate"])
def q_churn_rate(spark, sf_dir):
    return labels.churn_rate(D(spark, sf_dir).labels)


@query("weekly_order_counts", """
  SELECT e.user_id, e.week_date, CAST(coalesce(c.n, 0) AS BIGINT) AS n_orders_this_week
  FROM clean_eng e LEFT JOIN (
    SELECT user_id, strftime(order_date, '%Y-W%V') AS wk, count(*) AS n FROM clean_orders GROUP BY ALL) c
  ON e.user_id = c.user_id AND strftime(e.week_date, '%Y-W%V') = c.wk""", ts=["week_date"])
def q_weekly_order_counts(spark, sf_dir):
    d = D(spark, sf_dir)
    return labels.weekly_order_counts(d.engagement, d.orders).select("user_id", "week_date", "n_orders_this_week")


# --- C: features ------------------------------------------------------------

@query("recency", "SELECT user_id, days_since_last_order, tenure_days FROM ofe")
def q_recency(spark, sf_dir):
    return features.order_features(D(spark, sf_dir).orders, P, with_gaps=False) \
        .select("user_id", "days_since_last_order", "tenure_days")


@query("frequency", "SELECT user_id, total_orders FROM ofe")
def q_frequency(spark, sf_dir):
    return features.order_features(D(spark, sf_dir).orders, P, with_gaps=False).select("user_id", "total_orders")


@query("order_gap_std", "SELECT * FROM ogap", dbl=["std_days_between_orders"])
def q_order_gap_std(spark, sf_dir):
    return features.order_features(D(spark, sf_dir).orders, P).select("user_id", "std_days_between_orders")


@query("orders_last_30", """
  SELECT user_id, CASE WHEN orders_last_30_days > 0 THEN orders_last_30_days END AS orders_last_30_days FROM ofe""")
def q_orders_last_30(spark, sf_dir):
    f = features.order_features(D(spark, sf_dir).orders, P, with_gaps=False)
    return f.select("user_id", F.nullif(F.col("orders_last_30_days"), F.lit(0)).alias("orders_last_30_days"))


@query("monetary", "SELECT user_id, avg_order_value, avg_rating FROM ofe", dbl=["avg_order_value", "avg_rating"])
def q_monetary(spark, sf_dir):
    return features.order_features(D(spark, sf_dir).orders, P, with_gaps=False) \
        .select("user_id", "avg_order_value", "avg_rating")


@query("coupon_usage", "SELECT user_id, coupon_usage_count, coupon_usage_rate FROM ofe", dbl=["coupon_usage_rate"])
def q_coupon_usage(spark, sf_dir):
    return features.order_features(D(spark, sf_dir).orders, P, with_gaps=False) \
        .select("user_id", "coupon_usage_count", "coupon_usage_rate")


@query("plan_changes", "SELECT * FROM splan")
def q_plan_changes(spark, sf_dir):
    s = D(spark, sf_dir).subscriptions
    return features.plan_change_counts(s.where(F.col("start_date") <= ts_lit(P.snapshot)), P)


@query("current_price", "SELECT * FROM sprice", dbl=["monthly_price"])
def q_current_price(spark, sf_dir):
    return features.subscription_features(D(spark, sf_dir).subscriptions, P) \
        .where(F.col("monthly_price").isNotNull()).select("user_id", "monthly_price")


@query("subscription_tenure", "SELECT * FROM sten")
def q_subscription_tenure(spark, sf_dir):
    return features.subscription_features(D(spark, sf_dir).subscriptions, P) \
        .select("user_id", "subscription_tenure_days")


@query("engagement", "SELECT * FROM efe", dbl=["avg_app_logins", "avg_meals_skipped"])
def q_engagement(spark, sf_dir):
    return features.engagement_features(D(spark, sf_dir).engagement, P)


@query("age_bucket", "SELECT * FROM dfe")
def q_age_bucket(spark, sf_dir):
    return features.demographic_features(D(spark, sf_dir).users, P)


@query("ordinal_encode", """
  SELECT u.user_id, u.city, CAST(coalesce(c.code, -1) AS BIGINT) AS city_code
  FROM clean_users u LEFT JOIN (
    SELECT city, dense_rank() OVER (ORDER BY min(user_id)) - 1 AS code FROM clean_users
    WHERE city IS NOT NULL GROUP BY city) c USING (city)""")
def q_ordinal_encode(spark, sf_dir):
    u = D(spark, sf_dir).users.select("user_id", "city")
    return features.ordinal_encode(u, "city", "user_id", "city_code")


@query("feature_matrix", "SELECT * FROM matrix",
       dbl=["std_days_between_orders", "avg_order_value", "avg_rating", "coupon_usage_rate", "monthly_price",
            "avg_app_logins", "avg_meals_skipped"])
def q_feature_matrix(spark, sf_dir):
    return D(spark, sf_dir).matrix


@query("impute_defaults", """
  SELECT user_id, feature, fill_value FROM (
    UNPIVOT (SELECT user_id, {cols} FROM joined) ON {names} INTO NAME feature VALUE is_null)
  JOIN (VALUES {vals}) v(feature, fill_value) USING (feature)
  WHERE is_null""".format(
    cols=", ".join(f"{c} IS NULL AS {c}" for c in features.FEATURES),
    names=", ".join(features.FEATURES),
    vals=", ".join(f"('{c}', {float(features.IMPUTE_DEFAULTS.get(c, 0))})" for c in features.FEATURES)),
    dbl=["fill_value"])
def q_impute_defaults(spark, sf_dir):
    return features.filled_cells(D(spark, sf_dir).joined_matrix)


@query("one_hot", "SELECT user_id, {d}, {r} FROM clean_users".format(
    d=", ".join(f"CAST(dietary_preference = '{v}' AS BIGINT) AS diet_{v}" for v in features.DIET_VALUES),
    r=", ".join(f"CAST(referral_source = '{v}' AS BIGINT) AS referral_{v}" for v in features.REFERRAL_VALUES)))
def q_one_hot(spark, sf_dir):
    return features.one_hot(D(spark, sf_dir).users)


@query("matrix_profile", """
  SELECT count(*) AS n_rows, CAST(19 AS BIGINT) AS n_columns, avg(churned) AS positive_ratio,
         CAST({nulls} AS BIGINT) AS n_null_cells FROM matrix""".format(
    nulls=" + ".join(f"count_if({c} IS NULL)" for c in ["user_id", *features.FEATURES, "churned"])),
    dbl=["positive_ratio"])
def q_matrix_profile(spark, sf_dir):
    return features.matrix_profile(D(spark, sf_dir).matrix)
