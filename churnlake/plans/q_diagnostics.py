"""Registered queries: diagnostics and leakage studies (J1-J14) on the
feature matrix and the demo model's scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import diagnostics as J
from churnlake.operators import scoring as S
from churnlake.params import FEATURES
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.q_scoring import DEMO_COEFFICIENTS, DEMO_INTERCEPT, _scoring_sql
from churnlake.plans.registry import query
from churnlake.session import cut_lineage

_SNAP = "TIMESTAMP '2001-06-01 00:00:00'"
_LEAK_SQL = f"""
  leak AS (
    SELECT m.user_id, m.churned, coalesce(l.is_sub_active, 0) AS is_sub_active,
           coalesce(l.days_since_cancellation, 0) AS days_since_cancellation,
           coalesce(l.total_subscription_days, 0) AS total_subscription_days
    FROM matrix m LEFT JOIN (
      SELECT user_id, CAST(end_date > {_SNAP} AS BIGINT) AS is_sub_active,
        CASE WHEN end_date > {_SNAP} THEN 0
             ELSE CAST(floor((epoch_us({_SNAP}) - epoch_us(end_date)) / 86400000000.0) AS BIGINT) END
          AS days_since_cancellation,
        greatest(CAST(floor((epoch_us(end_date) - epoch_us(start_date)) / 86400000000.0) AS BIGINT), 0)
          AS total_subscription_days
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY end_date DESC, start_date DESC,
                                         subscription_id DESC) AS rn FROM clean_subs) WHERE rn = 1) l
    USING (user_id))"""


def _leak(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    return J.leaky_features(d.subscriptions, d.matrix.select("user_id", "churned"), P)


def _scores(spark, sf_dir, with_leak=False):
    """Scored users, with the leaked columns on request; the matrix is written
    once, since the scaler, the scores and the leak join all read it."""
    d = Domain(spark, sf_dir, P)
    m = cut_lineage(d.matrix)
    s = S.linear_score(S.standardized(m, S.scaler_stats(m)), DEMO_COEFFICIENTS, DEMO_INTERCEPT)
    s = s.select("user_id", "churned", F.col("churn_probability_raw").alias("p"))
    if with_leak:
        leak = J.leaky_features(d.subscriptions, m.select("user_id", "churned"), P)
        s = s.join(leak.select("user_id", "is_sub_active"), "user_id")
    return s


def _scores_sql(select: str) -> str:
    return _scoring_sql(select).replace("\n  WITH ", f"\n  WITH {_LEAK_SQL.strip()},\n  ", 1)


@query("leaky_features", "WITH" + _LEAK_SQL + "\n  SELECT * FROM leak")
def q_leaky_features(spark, sf_dir):
    return _leak(spark, sf_dir)


@query("crosstab_margins", "WITH" + _LEAK_SQL + """
  SELECT CASE WHEN grouping(is_sub_active) = 1 THEN 'All' ELSE CAST(is_sub_active AS VARCHAR) END AS is_sub_active,
         CASE WHEN grouping(churned) = 1 THEN 'All' ELSE CAST(churned AS VARCHAR) END AS churned, count(*) AS n
  FROM leak GROUP BY CUBE (is_sub_active, churned)""")
def q_crosstab_margins(spark, sf_dir):
    return J.crosstab_margins(_leak(spark, sf_dir), "is_sub_active", "churned")


@query("rate_by_group", "WITH" + _LEAK_SQL + """
  SELECT is_sub_active, count(*) AS n, CAST(sum(churned) AS BIGINT) AS n_churned, avg(churned) AS churn_rate
  FROM leak GROUP BY is_sub_active""", dbl=["churn_rate"])
def q_rate_by_group(spark, sf_dir):
    return J.rate_by_group(_leak(spark, sf_dir), "is_sub_active")


@query("duration_by_group", """
  SELECT is_active, count(*) AS n, avg(d) AS mean_days, median(d) AS median_days,
         (SELECT avg(d2) FILTER (WHERE a2) / avg(d2) FILTER (WHERE NOT a2) FROM (
            SELECT u.is_active AS a2, CAST(floor((epoch_us(s.end_date) - epoch_us(s.start_date)) / 86400000000.0)
                   AS BIGINT) AS d2 FROM clean_users u JOIN clean_subs s USING (user_id))) AS ratio
  FROM (SELECT u.is_active, CAST(floor((epoch_us(s.end_date) - epoch_us(s.start_date)) / 86400000000.0) AS BIGINT) AS d
        FROM clean_users u JOIN clean_subs s USING (user_id)) GROUP BY is_active""",
       dbl=["mean_days", "median_days", "ratio"])
def q_duration_by_group(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    return J.duration_by_group(d.users, d.subscriptions)


@query("end_date_buckets", f"""
  SELECT bucket, count(*) AS n, count(*) / (SELECT count(*) FROM clean_subs) AS share FROM (
    SELECT CASE WHEN end_date < {_SNAP} THEN 'before' WHEN end_date <= TIMESTAMP '2001-07-01 00:00:00'
                THEN 'within' ELSE 'after' END AS bucket FROM clean_subs) GROUP BY bucket""", dbl=["share"])
def q_end_date_buckets(spark, sf_dir):
    return J.end_date_buckets(Domain(spark, sf_dir, P).subscriptions, P)


_CORR_SQL = """
  corr_long AS (
    SELECT feature, correlation, abs(correlation) AS abs_correlation FROM (
      UNPIVOT (SELECT {cols} FROM matrix) ON {names} INTO NAME feature VALUE correlation)
    WHERE correlation IS NOT NULL AND NOT isnan(correlation))""".format(
    cols=", ".join(f"corr(CAST({f} AS DOUBLE), CAST(churned AS DOUBLE)) AS {f}" for f in FEATURES),
    names=", ".join(FEATURES))


@query("target_correlation", "WITH" + _CORR_SQL + "\n  SELECT * FROM corr_long ORDER BY abs_correlation DESC, feature LIMIT 15",
       dbl=["correlation", "abs_correlation"])
def q_target_correlation(spark, sf_dir):
    return J.target_correlation(Domain(spark, sf_dir, P).matrix, FEATURES)


@query("group_correlation", "WITH" + _CORR_SQL + ", gm AS (SELECT * FROM (VALUES {vals}) t(grp, feature))".format(
    vals=", ".join(f"('{g}', '{f}')" for g, fs in J.FEATURE_GROUPS.items() for f in fs)) + """
  SELECT grp, max(abs_correlation) AS max_abs_r, avg(abs_correlation) AS mean_abs_r
  FROM corr_long c JOIN gm USING (feature)
  GROUP BY grp""", dbl=["max_abs_r", "mean_abs_r"])
def q_group_correlation(spark, sf_dir):
    return J.group_correlation(J.target_correlation(Domain(spark, sf_dir, P).matrix, FEATURES, top=None))


@query("score_percentiles", _scores_sql("""
  SELECT 'all' AS grp, 'p' || lpad(CAST(CAST(round(q * 100) AS INTEGER) AS VARCHAR), 2, '0') AS stat, v AS value
  FROM (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS q,
               unnest(quantile_cont(p, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS v FROM sc)
  UNION ALL
  SELECT grp, 'p' || lpad(CAST(CAST(round(q * 100) AS INTEGER) AS VARCHAR), 2, '0'), v FROM (
    SELECT CAST(churned AS VARCHAR) AS grp, unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q,
           unnest(quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS v FROM sc GROUP BY churned)
  UNION ALL SELECT CAST(churned AS VARCHAR), 'mean', avg(p) FROM sc GROUP BY churned
  UNION ALL SELECT CAST(churned AS VARCHAR), 'median', quantile_cont(p, 0.5) FROM sc GROUP BY churned"""),
       dbl=["value"])
def q_score_percentiles(spark, sf_dir):
    return J.score_percentiles(_scores(spark, sf_dir))


@query("score_spread", _scores_sql(
    "SELECT min(p) AS min_p, max(p) AS max_p, avg(p) AS mean_p, stddev_pop(p) AS std_p, max(p) - min(p) AS range_p, "
    "max(p) > 0.3 AS spread_ok FROM sc"), dbl=["min_p", "max_p", "mean_p", "std_p", "range_p"])
def q_score_spread(spark, sf_dir):
    return J.score_spread(_scores(spark, sf_dir))


@query("extreme_users", _scores_sql("""
  SELECT user_id, churned, p, which FROM (
    SELECT user_id, churned, p, row_number() OVER (ORDER BY p, user_id) - 1 AS r, count(*) OVER () AS n FROM sc),
    LATERAL (SELECT CASE WHEN r >= n - 5 THEN 'highest' WHEN r < 5 THEN 'lowest'
                         WHEN r >= n // 2 - 2 AND r < n // 2 + 3 THEN 'middle' END AS which)
  WHERE which IS NOT NULL"""), dbl=["p"])
def q_extreme_users(spark, sf_dir):
    return J.extreme_users(_scores(spark, sf_dir))


@query("score_histogram", _scores_sql("""
  SELECT is_sub_active, bin, lo + bin * width AS bin_start, count(*) AS count, count(*) / (max(n) * width) AS density
  FROM (SELECT l.is_sub_active, lo, width, n,
               CAST(least(floor((s.p - lo) / width), 19) AS BIGINT) AS bin
        FROM sc s JOIN leak l USING (user_id) JOIN (
          SELECT l2.is_sub_active, min(s2.p) AS lo, count(*) AS n,
                 CASE WHEN max(s2.p) > min(s2.p) THEN (max(s2.p) - min(s2.p)) / 20 ELSE 1.0 / 20 END AS width
          FROM sc s2 JOIN leak l2 USING (user_id) GROUP BY l2.is_sub_active) r USING (is_sub_active))
  GROUP BY is_sub_active, bin, lo, width"""), dbl=["bin_start", "density"])
def q_score_histogram(spark, sf_dir):
    return J.score_histogram(_scores(spark, sf_dir, with_leak=True), "is_sub_active")


@query("mean_score_by_flag", _scores_sql(
    "SELECT l.is_sub_active, avg(s.p) AS mean_p, count(*) AS n FROM sc s JOIN leak l USING (user_id) "
    "GROUP BY l.is_sub_active"), dbl=["mean_p"])
def q_mean_score_by_flag(spark, sf_dir):
    return J.mean_score_by_flag(_scores(spark, sf_dir, with_leak=True), "is_sub_active")
