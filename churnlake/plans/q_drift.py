"""Registered queries: drift (H1-H10).  Reference = lineitem rows shipped
before 1998-06-01, current = rows shipped from then on (history: one batch
per ship year); seven numeric columns, two of them categorical codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions.columns import ts_lit

from churnlake.operators import drift as DR
from churnlake.params import Params
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.registry import query
from churnlake.session import shared_path
from churnlake.sources import io
from churnlake.sources.adapters import DRIFT_COLUMNS, DRIFT_SPLIT, drift_sides, load_table

_SIDE_COLS = """l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
    CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END AS returnflag_code,
    CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS linestatus_code"""
_SPLIT = "TIMESTAMP '1998-06-01 00:00:00'"


def _erfc_sql(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.5 * ({x})))"
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
              1.48851587, -0.82215223, 0.17087277]
    poly = repr(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    return f"({t} * exp(-({x}) * ({x}) + {poly}))"


def drift_ctes(batch: str = "0") -> str:
    """DuckDB CTEs computing column drift per (b, feature); ``batch`` is
    the current side's batch expression."""
    h = "(chi2 / 2.0)"
    pval = (f"CASE WHEN k - 1 <= 0 THEN 1.0 WHEN k - 1 = 1 THEN {_erfc_sql(f'sqrt({h})')} "
            f"WHEN k - 1 = 2 THEN exp(-{h}) "
            f"WHEN k - 1 = 3 THEN {_erfc_sql(f'sqrt({h})')} + sqrt(2.0 * chi2 / pi()) * exp(-{h}) "
            f"WHEN k - 1 = 4 THEN exp(-{h}) * (1.0 + {h}) END")
    return f"""
  dref AS (SELECT {_SIDE_COLS} FROM lineitem WHERE l_shipdate < {_SPLIT}),
  dcur AS (SELECT {batch} AS b, {_SIDE_COLS} FROM lineitem WHERE l_shipdate >= {_SPLIT}),
  lref AS (UNPIVOT dref ON COLUMNS(*) INTO NAME feature VALUE value),
  lcur AS (UNPIVOT dcur ON COLUMNS(* EXCLUDE (b)) INTO NAME feature VALUE value),
  bf AS (SELECT DISTINCT b, feature FROM lcur),
  vc AS (SELECT b, feature, value, sum(r) AS n_ref, sum(c) AS n_cur FROM (
           SELECT bf.b, l.feature, l.value, 1 AS r, 0 AS c FROM lref l JOIN bf USING (feature)
           UNION ALL SELECT b, feature, value, 0, 1 FROM lcur) GROUP BY ALL),
  summ AS (SELECT b, feature, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur, count(*) AS n_unique FROM vc GROUP BY ALL),
  ks0 AS (SELECT b, feature, max(abs(cr / nr - cc / nc)) AS d, max(nr) AS nr, max(nc) AS nc FROM (
           SELECT b, feature, sum(n_ref) OVER w AS cr, sum(n_cur) OVER w AS cc,
                  sum(n_ref) OVER (PARTITION BY b, feature) AS nr, sum(n_cur) OVER (PARTITION BY b, feature) AS nc
           FROM vc WINDOW w AS (PARTITION BY b, feature ORDER BY value)) GROUP BY ALL),
  ks AS (SELECT b, feature, d AS ks_statistic, CASE WHEN z <= 0 THEN 1.0 ELSE least(greatest(2.0 * list_sum(
           list_transform(range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * z * z))), 0.0), 1.0) END
           AS ks_pvalue
         FROM (SELECT *, d * sqrt(nr * nc / (nr + nc)) AS z FROM ks0)),
  pooled AS (SELECT vc.b, vc.feature, vc.value FROM vc, LATERAL (SELECT unnest(range(CAST(n_ref + n_cur AS BIGINT))))),
  edg AS (SELECT b, feature, list_sort(list_distinct(quantile_cont(value, [{", ".join(str(i / 10) for i in range(11))}])))
            AS edges FROM pooled GROUP BY ALL),
  binned AS (SELECT v.b, v.feature, least(len(list_filter(e.edges, lambda x: x <= v.value)) - 1, len(e.edges) - 2) AS bin,
                    sum(n_ref) AS c_ref, sum(n_cur) AS c_cur
             FROM vc v JOIN edg e USING (b, feature) WHERE len(e.edges) >= 2 GROUP BY ALL),
  spine AS (SELECT b, feature, unnest(range(0, len(edges) - 1)) AS bin FROM edg WHERE len(edges) >= 2),
  full_bins AS (SELECT s.b, s.feature, s.bin, coalesce(c_ref, 0) + 1e-10 AS e, coalesce(c_cur, 0) + 1e-10 AS a
                FROM spine s LEFT JOIN binned USING (b, feature, bin)),
  psi AS (SELECT g.b, g.feature, coalesce(p.psi, 0.0) AS psi FROM edg g LEFT JOIN (
            SELECT b, feature, sum((a / sa - e / se) * ln((a / sa) / (e / se))) AS psi FROM (
              SELECT *, sum(e) OVER (PARTITION BY b, feature) AS se, sum(a) OVER (PARTITION BY b, feature) AS sa
              FROM full_bins) GROUP BY ALL) p USING (b, feature)),
  chi AS (SELECT b, feature, chi2, {pval} AS chi2_pvalue FROM (
            SELECT b, feature, sum(pow(c - r * sc / sr, 2) / (r * sc / sr)) AS chi2, max(k) AS k FROM (
              SELECT b, feature, n_ref + 1e-10 AS r, n_cur + 1e-10 AS c,
                     sum(n_ref + 1e-10) OVER (PARTITION BY b, feature) AS sr,
                     sum(n_cur + 1e-10) OVER (PARTITION BY b, feature) AS sc,
                     count(*) OVER (PARTITION BY b, feature) AS k FROM vc) GROUP BY ALL)),
  coldrift AS (
    SELECT s.b, s.feature,
      CASE WHEN s.n_ref < 5 OR s.n_cur < 5 THEN 'none' WHEN s.n_unique <= 5 THEN 'chi_square' ELSE 'ks' END AS test,
      round_even(CASE WHEN s.n_ref < 5 OR s.n_cur < 5 THEN 0.0 WHEN s.n_unique <= 5 THEN c.chi2_pvalue
                      ELSE k.ks_statistic END, 4) AS drift_score,
      round_even(CASE WHEN s.n_ref < 5 OR s.n_cur < 5 THEN 1.0 WHEN s.n_unique <= 5 THEN c.chi2_pvalue
                      ELSE k.ks_pvalue END, 4) AS p_value,
      CASE WHEN NOT (s.n_ref < 5 OR s.n_cur < 5) AND s.n_unique > 5 THEN p.psi END AS psi,
      CASE WHEN s.n_ref < 5 OR s.n_cur < 5 THEN false WHEN s.n_unique <= 5 THEN c.chi2_pvalue < 0.05
           ELSE k.ks_pvalue < 0.05 OR p.psi > 0.2 END AS drifted,
      CAST(s.n_ref AS BIGINT) AS n_ref, CAST(s.n_cur AS BIGINT) AS n_cur
    FROM summ s LEFT JOIN ks k USING (b, feature) LEFT JOIN psi p USING (b, feature)
    LEFT JOIN chi c USING (b, feature)),
  report AS (
    SELECT b, CASE WHEN share >= 0.3 THEN 'critical' WHEN share >= 0.15 THEN 'warning' ELSE 'ok' END AS status,
      n_features, n_drifted_features, round_even(share, 4) AS drift_share, share > 0.15 AS dataset_drift,
      (SELECT count(*) FROM dref) AS n_reference_samples, n_cur_rows AS n_current_samples, drifted_features
    FROM (SELECT c.b, count(*) AS n_features, count_if(drifted) AS n_drifted_features,
                 count_if(drifted) / count(*) AS share,
                 coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features,
                 max(r.n) AS n_cur_rows
          FROM coldrift c JOIN (SELECT b, count(*) AS n FROM dcur GROUP BY b) r USING (b) GROUP BY c.b))"""


def _drift_sql(select: str, batch: str = "0") -> str:
    return f"WITH {drift_ctes(batch).strip()}\n  {select}"


def _sides(spark, sf_dir):
    return drift_sides(spark, sf_dir)


def _by_year(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    ref, _ = drift_sides(spark, sf_dir)
    cur = (li.filter(F.col("l_shipdate") >= ts_lit(DRIFT_SPLIT))
             .select(F.year("l_shipdate").alias("b"), *_side_exprs()))
    return ref, cur


def _side_exprs():
    return ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
            F.col("l_linenumber").cast("double").alias("l_linenumber"),
            F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
             .otherwise(2.0).alias("returnflag_code"),
            F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("linestatus_code")]


@query("ks_statistic", _drift_sql("SELECT feature, ks_statistic FROM ks"), dbl=["ks_statistic"])
def q_ks_statistic(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    return DR.ks_test(DR.value_counts(ref, cur, DRIFT_COLUMNS)).select("feature", "ks_statistic")


@query("ks_pvalue", _drift_sql("SELECT feature, round_even(ks_pvalue, 4) AS ks_pvalue FROM ks"), dbl=["ks_pvalue"])
def q_ks_pvalue(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    return DR.ks_test(DR.value_counts(ref, cur, DRIFT_COLUMNS)) \
        .select("feature", F.bround("ks_pvalue", 4).alias("ks_pvalue"))


@query("psi", _drift_sql("SELECT feature, psi FROM psi"), dbl=["psi"])
def q_psi(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    return DR.psi(DR.value_counts(ref, cur, DRIFT_COLUMNS)).select("feature", "psi")


@query("chi_square_drift", _drift_sql(
    "SELECT feature, chi2 AS chi2_statistic, round_even(chi2_pvalue, 4) AS chi2_pvalue FROM chi "
    "WHERE feature IN (SELECT feature FROM summ WHERE n_unique <= 5)"), dbl=["chi2_statistic", "chi2_pvalue"])
def q_chi_square_drift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    vc = DR.value_counts(ref, cur, DRIFT_COLUMNS)
    cat = vc.groupBy("feature").agg(F.count(F.lit(1)).alias("k")).where("k <= 5").select("feature")
    return DR.chi_square_test(vc).join(cat, "feature", "left_semi") \
        .select("feature", "chi2_statistic", F.bround("chi2_pvalue", 4).alias("chi2_pvalue"))


@query("column_drift", _drift_sql("SELECT * EXCLUDE (b) FROM coldrift"), dbl=["drift_score", "p_value", "psi"])
def q_column_drift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    return DR.column_drift(ref, cur, DRIFT_COLUMNS, P)


def _side_counts(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    split = ts_lit(DRIFT_SPLIT)
    r = li.agg(F.count_if(F.col("l_shipdate") < split).alias("n_ref"),
               F.count_if(F.col("l_shipdate") >= split).alias("n_cur")).first()
    return r["n_ref"], r["n_cur"]


def _report(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    cd = DR.column_drift(ref, cur, DRIFT_COLUMNS, P)
    n_ref, n_cur = _side_counts(spark, sf_dir)
    return DR.drift_report(cd, n_ref, n_cur, P)


@query("drift_report", _drift_sql("SELECT * EXCLUDE (b) FROM report"), dbl=["drift_share"])
def q_drift_report(spark, sf_dir):
    return _report(spark, sf_dir)


def _history(spark, sf_dir):
    ref, cur = _by_year(spark, sf_dir)
    cd = DR.column_drift(ref, cur, DRIFT_COLUMNS, P, batch_cols=["b"])
    ncur = cur.groupBy("b").agg(F.count(F.lit(1)).alias("n_cur_rows"))
    rep = DR.drift_report(cd, _side_counts(spark, sf_dir)[0], F.lit(None), P, batch_cols=["b"]) \
        .drop("n_current_samples")
    return rep.join(ncur, "b").withColumnRenamed("n_cur_rows", "n_current_samples")


@query("drift_history", _drift_sql(
    "SELECT b AS batch, drift_share, status, 0.15 AS warning_limit, 0.3 AS critical_limit, "
    "b = (SELECT max(b) FROM report) AS is_latest FROM report", "CAST(year(l_shipdate) AS INTEGER)"),
    dbl=["drift_share", "warning_limit", "critical_limit"], ints=["batch"])
def q_drift_history(spark, sf_dir):
    return DR.drift_history(_history(spark, sf_dir).withColumnRenamed("b", "batch"), "batch", P)


@query("save_reference", "SELECT {cols}, '20010601' AS ref_version FROM matrix".format(
    cols=", ".join(c for c in ["days_since_last_order", "total_orders", "avg_order_value", "avg_rating",
                               "total_support_tickets", "avg_app_logins", "subscription_tenure_days",
                               "tenure_days"])), dbl=["avg_order_value", "avg_rating", "avg_app_logins"])
def q_save_reference(spark, sf_dir):
    m = Domain(spark, sf_dir, P).matrix
    cols = DR.monitored_columns(m)
    path = shared_path(spark, "drift_reference")
    io.write_partitioned(m.select(*cols).withColumn("ref_version", F.lit("20010601")), path, ["ref_version"])
    return io.read_parquet(spark, path)


@query("latest_reference", """
  SELECT ref_version, count(*) AS n_rows, dense_rank() OVER (ORDER BY ref_version DESC) = 1 AS is_latest,
         dense_rank() OVER (ORDER BY ref_version DESC) <= 3 AS retained
  FROM (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ref_version FROM lineitem
        WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00') GROUP BY ref_version""")
def q_latest_reference(spark, sf_dir):
    ref_li = load_table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < ts_lit(DRIFT_SPLIT))
    return DR.latest_reference(ref_li.select(F.year("l_shipdate").cast("string").alias("ref_version")))


@query("list_reports")
def q_list_reports(spark, sf_dir):
    """H9: the per-year reports written as JSON files (S5), read back as a
    folder (S6, malformed files dropped), newest 10 by file name."""
    path = shared_path(spark, "drift_reports")
    rep = _history(spark, sf_dir)
    io.write_reports_json(rep.withColumn("report", F.concat(F.lit("drift_report_"), F.col("b").cast("string"))),
                          path, "report")
    return io.list_reports(spark, path)
