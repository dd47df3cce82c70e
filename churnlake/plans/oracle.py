"""DuckDB oracle texts for the registered queries.

Each text starts from the driver's views (customer, nation, orders,
events, lineitem, ...) and repeats the adapter mapping of
``churnlake.sources.adapters`` as CTEs, then states the operator in plain
SQL.  Spelled for DuckDB: ``epoch_us`` / ``to_days`` for date arithmetic,
1-based list indexing.
"""

from __future__ import annotations

SNAP = "TIMESTAMP '2001-06-01 00:00:00'"
LABEL_END = "TIMESTAMP '2001-07-01 00:00:00'"
RECENT_START = "TIMESTAMP '2001-05-02 00:00:00'"


def fdays(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


PRELUDE = f"""
scored AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS p
  FROM lineitem),
sc AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p),
thr AS (
  SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
    sum(pos) OVER () AS "n_pos", sum(neg) OVER () AS "n_neg" FROM sc),
raw_users AS (
  SELECT c.c_custkey AS user_id,
    CASE WHEN c.c_custkey % 41 = 5 THEN 'not-a-date'
         ELSE strftime(TIMESTAMP '1994-12-01 00:00:00' + to_days(CAST(c.c_custkey % 30 AS INTEGER)),
                       '%Y-%m-%d %H:%M:%S') END AS signup_date,
    CASE WHEN c.c_custkey % 50 = 7 THEN NULL WHEN c.c_custkey % 50 = 13 THEN 150
         ELSE CAST(18 + c.c_custkey % 63 AS INTEGER) END AS age,
    CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE n.n_name END AS city,
    CASE WHEN c.c_custkey % 10 = 3 THEN NULL
         ELSE (['balanced','keto','low_carb','mediterranean','paleo','vegan'])[CAST(c.c_nationkey % 6 AS INTEGER) + 1]
    END AS dietary_preference,
    (['blog','direct','facebook','friend','google','instagram','tiktok'])[CAST(c.c_custkey % 7 AS INTEGER) + 1]
      AS referral_source,
    c.c_acctbal > 0 AS is_active
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS TIMESTAMP) AS order_date,
    CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END AS order_value,
    CASE WHEN o_orderkey % 10 = 2 THEN NULL
         ELSE (['weekly_classic','weekly_vegan','monthly_premium','biweekly_standard'])[CAST(o_orderkey % 4 AS INTEGER) + 1]
    END AS meal_plan,
    CASE WHEN o_orderkey % 10 = 4 THEN NULL
         ELSE (['morning','afternoon','evening'])[CAST(o_orderkey % 3 AS INTEGER) + 1] END AS delivery_hour,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS rating,
    CASE WHEN o_orderkey % 10 = 6 THEN NULL ELSE o_orderstatus <> 'O' END AS on_time_delivery,
    o_orderstatus = 'P' AS coupon_used
  FROM orders),
raw_subs AS (
  SELECT o_custkey AS user_id, o_orderkey AS subscription_id,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS plan_type,
    CAST(o_orderdate AS TIMESTAMP) AS start_date,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL
         WHEN o_orderkey % 53 = 0 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 5 DAY
         ELSE CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS end_date,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey % 80 AS DOUBLE) + 20.99 END AS monthly_price,
    CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'active' END AS status,
    CASE WHEN o_orderstatus = 'F'
         THEN (['too_expensive','delivery_issues','not_enough_variety','moving'])[CAST(o_orderkey % 4 AS INTEGER) + 1]
    END AS cancellation_reason
  FROM orders),
ev_week AS (
  SELECT user_id, date_trunc('week', CAST(ts AS TIMESTAMP) - INTERVAL 8274 DAY) AS week_date,
    count_if(event_type = 'view') AS views, count_if(event_type = 'click') AS clicks,
    count_if(event_type = 'error') AS errors, count_if(event_type = 'signup') AS signups,
    count_if(event_type = 'purchase') AS purchases
  FROM events GROUP BY ALL),
raw_eng AS (
  SELECT user_id, strftime(week_date, '%Y-%m-%d') AS week_date,
    CAST(views AS BIGINT) AS app_logins, CAST(clicks AS BIGINT) AS recipes_viewed,
    CAST(CASE WHEN user_id % 17 = 0 THEN -errors ELSE errors END AS BIGINT) AS meals_skipped,
    CAST(CASE WHEN user_id % 10 = 0 THEN NULL ELSE signups END AS BIGINT) AS support_tickets,
    CAST(purchases AS BIGINT) AS referral_clicks, CAST(purchases AS BIGINT) AS n_orders_this_week
  FROM ev_week),
u_kept AS (
  SELECT * REPLACE (TRY_CAST(signup_date AS TIMESTAMP) AS signup_date)
  FROM raw_users WHERE age BETWEEN 18 AND 100),
city_mode AS (
  SELECT city FROM u_kept WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1),
clean_users AS (
  SELECT * REPLACE (coalesce(city, (SELECT city FROM city_mode), 'Unknown') AS city,
                    coalesce(dietary_preference, 'balanced') AS dietary_preference)
  FROM u_kept),
o_kept AS (
  SELECT * FROM raw_orders
  WHERE order_date >= (SELECT min(signup_date) FROM clean_users) AND order_date <= {SNAP} AND order_value > 0),
o_r1 AS (
  SELECT *, CASE WHEN user_id IS NOT NULL
                 THEN coalesce(CAST(rating AS DOUBLE), avg(rating) OVER (PARTITION BY user_id)) END AS r1
  FROM o_kept),
clean_orders AS (
  SELECT order_id, user_id, order_date, order_value,
    coalesce(meal_plan, 'weekly_classic') AS meal_plan, coalesce(delivery_hour, 'afternoon') AS delivery_hour,
    coalesce(r1, (SELECT median(r1) FROM o_r1)) AS rating,
    coalesce(on_time_delivery, true) AS on_time_delivery, coupon_used
  FROM o_r1),
clean_subs AS (
  SELECT user_id, subscription_id, plan_type, start_date,
    CASE WHEN end_date IS NULL OR end_date < start_date THEN start_date + INTERVAL 30 DAY ELSE end_date END
      AS end_date,
    coalesce(monthly_price, (SELECT median(monthly_price) FROM raw_subs)) AS monthly_price,
    coalesce(status, 'active') AS status, coalesce(cancellation_reason, '') AS cancellation_reason
  FROM raw_subs),
clean_eng AS (
  SELECT user_id, TRY_CAST(week_date AS TIMESTAMP) AS week_date,
    CASE WHEN app_logins < 0 THEN 0 ELSE app_logins END AS app_logins,
    CASE WHEN recipes_viewed < 0 THEN 0 ELSE recipes_viewed END AS recipes_viewed,
    CASE WHEN meals_skipped < 0 THEN 0 ELSE meals_skipped END AS meals_skipped,
    CASE WHEN support_tickets < 0 THEN 0 ELSE support_tickets END AS support_tickets,
    CASE WHEN referral_clicks < 0 THEN 0 ELSE referral_clicks END AS referral_clicks,
    n_orders_this_week
  FROM raw_eng),
latest_sub AS (
  SELECT user_id, start_date, end_date FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, end_date DESC,
                                 subscription_id DESC) AS rn
    FROM clean_subs) WHERE rn = 1),
labels AS (
  SELECT user_id, CAST(end_date <= {LABEL_END} AS BIGINT) AS churned,
    CASE WHEN end_date <= {LABEL_END} THEN end_date END AS churn_date
  FROM latest_sub WHERE start_date <= {SNAP} AND end_date > {SNAP}),
ofe AS (
  SELECT user_id,
    {fdays(SNAP, 'max(order_date)')} AS days_since_last_order,
    greatest({fdays(SNAP, 'min(order_date)')}, 0) AS tenure_days,
    count(order_id) AS total_orders,
    count_if(order_date >= {RECENT_START}) AS orders_last_30_days,
    avg(order_value) AS avg_order_value, avg(rating) AS avg_rating,
    CAST(coalesce(sum(CAST(coupon_used AS INTEGER)), 0) AS BIGINT) AS coupon_usage_count,
    sum(CAST(coupon_used AS INTEGER)) / count(coupon_used) AS coupon_usage_rate
  FROM clean_orders GROUP BY user_id),
ogap AS (
  SELECT user_id, coalesce(stddev_samp(g), 0) AS std_days_between_orders FROM (
    SELECT user_id, {fdays('order_date', 'lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date, order_id)')} AS g
    FROM clean_orders) GROUP BY user_id),
subs_asof AS (SELECT * FROM clean_subs WHERE start_date <= {SNAP}),
sprice AS (
  SELECT user_id, monthly_price FROM (
    SELECT user_id, monthly_price, row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, end_date DESC,
                                                      subscription_id DESC) AS rn
    FROM subs_asof WHERE monthly_price IS NOT NULL) WHERE rn = 1),
splan AS (
  SELECT user_id, CAST(greatest(coalesce(sum(CASE WHEN rn > 1 THEN
      CASE WHEN plan_type IS NOT NULL AND prev IS NOT NULL AND plan_type = prev THEN 0 ELSE 1 END ELSE 0 END), 0), 0)
      AS BIGINT) AS n_plan_changes
  FROM (SELECT user_id, plan_type, lag(plan_type) OVER w AS prev, row_number() OVER w AS rn
        FROM subs_asof WINDOW w AS (PARTITION BY user_id ORDER BY start_date, end_date, subscription_id))
  GROUP BY user_id),
sten AS (
  SELECT user_id, greatest({fdays(SNAP, 'min(start_date)')}, 0) AS subscription_tenure_days
  FROM subs_asof GROUP BY user_id),
sfe AS (
  SELECT t.user_id, p.monthly_price, t.subscription_tenure_days, c.n_plan_changes
  FROM sten t LEFT JOIN sprice p USING (user_id) LEFT JOIN splan c USING (user_id)),
efe AS (
  SELECT user_id, avg(app_logins) AS avg_app_logins, avg(meals_skipped) AS avg_meals_skipped,
    CAST(coalesce(sum(support_tickets), 0) AS BIGINT) AS total_support_tickets
  FROM clean_eng WHERE week_date <= {SNAP} GROUP BY user_id),
dfe AS (
  SELECT user_id, CAST(age AS BIGINT) AS age,
    CAST(CASE WHEN age > 0 AND age <= 25 THEN 0 WHEN age > 25 AND age <= 35 THEN 1
              WHEN age > 35 AND age <= 50 THEN 2 WHEN age > 50 AND age <= 100 THEN 3 ELSE 0 END AS BIGINT)
      AS age_group_code
  FROM clean_users),
joined AS (
  SELECT s.user_id,
    o.days_since_last_order, o.tenure_days, o.total_orders, g.std_days_between_orders,
    o.orders_last_30_days, o.avg_order_value, o.avg_rating, o.coupon_usage_count, o.coupon_usage_rate,
    f.monthly_price, f.subscription_tenure_days, f.n_plan_changes,
    e.avg_app_logins, e.avg_meals_skipped, e.total_support_tickets, d.age, d.age_group_code,
    CAST(coalesce(l.churned, 0) AS BIGINT) AS churned
  FROM (SELECT DISTINCT user_id FROM labels) s
  LEFT JOIN ofe o USING (user_id) LEFT JOIN ogap g USING (user_id) LEFT JOIN sfe f USING (user_id)
  LEFT JOIN efe e USING (user_id) LEFT JOIN dfe d USING (user_id) LEFT JOIN labels l USING (user_id)),
matrix AS (
  SELECT user_id,
    coalesce(days_since_last_order, 999) AS days_since_last_order, coalesce(tenure_days, 0) AS tenure_days,
    coalesce(total_orders, 0) AS total_orders, coalesce(std_days_between_orders, 0) AS std_days_between_orders,
    coalesce(orders_last_30_days, 0) AS orders_last_30_days, coalesce(avg_order_value, 0) AS avg_order_value,
    coalesce(avg_rating, 0) AS avg_rating, coalesce(coupon_usage_count, 0) AS coupon_usage_count,
    coalesce(coupon_usage_rate, 0) AS coupon_usage_rate, coalesce(monthly_price, 0) AS monthly_price,
    coalesce(subscription_tenure_days, 0) AS subscription_tenure_days,
    coalesce(n_plan_changes, 0) AS n_plan_changes, coalesce(avg_app_logins, 0) AS avg_app_logins,
    coalesce(avg_meals_skipped, 0) AS avg_meals_skipped,
    coalesce(total_support_tickets, 0) AS total_support_tickets, coalesce(age, 30) AS age,
    coalesce(age_group_code, 0) AS age_group_code, churned
  FROM joined)
"""


def q(body: str, dbl=(), ts=(), ints=()) -> str:
    """Full oracle text: prelude CTEs, the query as CTE ``q``, and the same
    output normalisation as ``churnlake.plans.output.finalize``."""
    reps = ([f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in dbl]
            + [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ts]
            + [f"CAST({c} AS BIGINT) AS {c}" for c in ints])
    sel = f"SELECT * REPLACE ({', '.join(reps)}) FROM q" if reps else "SELECT * FROM q"
    return f"WITH {PRELUDE.strip()},\nq AS (\n{body}\n)\n{sel}"


ORACLE: dict[str, str] = {}


def register(name: str, body: str, dbl=(), ts=(), ints=()):
    ORACLE[name] = q(body, dbl, ts, ints)
