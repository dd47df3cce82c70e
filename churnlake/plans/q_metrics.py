"""Registered queries: evaluation metrics (F1-F10) on the scored lineitem
rows (y = returned, p = discount * 10: eleven distinct scores, heavy ties)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import metrics as M
from churnlake.plans.registry import query
from churnlake.sources.adapters import load_table, scored_rows


def _scored(spark, sf_dir):
    return scored_rows(spark, sf_dir)


def _cls_sql(threshold: float) -> str:
    return f"""
  SELECT round_even((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy,
    round_even(((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END)
                + coalesce(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END, 0))
               / ((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)), 4)
      AS balanced_accuracy,
    round_even(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 4) AS precision,
    round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 4) AS recall,
    round_even(CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0
               THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0 END, 4)
      AS f1_score
  FROM (SELECT CAST(count_if(y = 1 AND pred = 1) AS DOUBLE) AS tp, CAST(count_if(y = 0 AND pred = 1) AS DOUBLE) AS fp,
               CAST(count_if(y = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count_if(y = 0 AND pred = 0) AS DOUBLE) AS tn
        FROM (SELECT y, CAST(p >= {threshold} AS INTEGER) AS pred FROM scored))"""


METRIC_COLS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1_score"]


@query("classification_metrics", _cls_sql(0.5), dbl=METRIC_COLS)
def q_classification_metrics(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return M.classification_metrics(s)


_AUC_SQL = """sum(neg * (tp - pos + pos / 2.0)) / (max("n_pos") * max("n_neg"))"""
_AP_SQL = """sum(pos / "n_pos" * tp / (tp + fp))"""


@query("roc_auc", f"SELECT round_even({_AUC_SQL}, 4) AS roc_auc FROM thr", dbl=["roc_auc"])
def q_roc_auc(spark, sf_dir):
    return M.ranking_metrics(_scored(spark, sf_dir)).select("roc_auc")


@query("average_precision", f"SELECT round_even({_AP_SQL}, 4) AS pr_auc FROM thr", dbl=["pr_auc"])
def q_average_precision(spark, sf_dir):
    return M.ranking_metrics(_scored(spark, sf_dir)).select("pr_auc")


@query("brier", "SELECT round_even(avg(power(least(greatest(p, 0.001), 0.999) - y, 2)), 4) AS brier_score FROM scored",
       dbl=["brier_score"])
def q_brier(spark, sf_dir):
    return M.ranking_metrics(_scored(spark, sf_dir)).select("brier_score")


@query("optimal_threshold", """
  SELECT round_even(p, 4) AS optimal_threshold, round_even(f1, 4) AS max_f1,
         round_even(prec, 4) AS precision_at_optimal, round_even(rec, 4) AS recall_at_optimal
  FROM (SELECT p, tp / (tp + fp) AS prec, tp / "n_pos" AS rec,
               2 * (tp / (tp + fp)) * (tp / "n_pos") / ((tp / (tp + fp)) + (tp / "n_pos") + 1e-10) AS f1 FROM thr)
  ORDER BY f1 DESC, p ASC LIMIT 1""",
       dbl=["optimal_threshold", "max_f1", "precision_at_optimal", "recall_at_optimal"])
def q_optimal_threshold(spark, sf_dir):
    return M.optimal_threshold(_scored(spark, sf_dir))


def _lift_sql(k: float) -> str:
    return f"""
  SELECT {k}::DOUBLE AS k, CAST(n_top AS BIGINT) AS n_top, CAST(in_top AS BIGINT) AS churners_in_top,
    round_even(CASE WHEN total > 0 THEN in_top / total / {k}::DOUBLE ELSE 0 END, 4) AS lift
  FROM (SELECT max(n_top) AS n_top, sum(y) FILTER (WHERE rn <= n_top) AS in_top, sum(y) AS total
        FROM (SELECT y, row_number() OVER (ORDER BY p DESC, id ASC) AS rn,
                     greatest(floor(count(*) OVER () * {k}::DOUBLE), 1) AS n_top FROM scored))"""


@query("lift_at_k", _lift_sql(0.1) + "\n  UNION ALL\n" + _lift_sql(0.2), dbl=["k", "lift"])
def q_lift_at_k(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return M.lift_at_k(s, 0.1).unionByName(M.lift_at_k(s, 0.2))


@query("roc_curve", 'SELECT p AS threshold, fp / "n_neg" AS fpr, tp / "n_pos" AS tpr FROM thr',
       dbl=["threshold", "fpr", "tpr"])
def q_roc_curve(spark, sf_dir):
    return M.roc_curve(_scored(spark, sf_dir))


@query("pr_curve", 'SELECT p AS threshold, tp / (tp + fp) AS precision, tp / "n_pos" AS recall FROM thr',
       dbl=["threshold", "precision", "recall"])
def q_pr_curve(spark, sf_dir):
    return M.pr_curve(_scored(spark, sf_dir))


@query("confusion_matrix", """
  SELECT a.y, b.pred, count(s.y) AS n
  FROM (VALUES (0), (1)) a(y) CROSS JOIN (VALUES (0), (1)) b(pred)
  LEFT JOIN (SELECT y, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored) s ON s.y = a.y AND s.pred = b.pred
  GROUP BY a.y, b.pred""", ints=["y", "pred", "n"])
def q_confusion_matrix(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return M.confusion_matrix(s)


def _two_models(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    base = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount", "l_tax")
    return base.select("id", "y", F.explode(F.array(
        F.struct(F.lit("discount").alias("model"), (F.col("l_discount") * 10).alias("p")),
        F.struct(F.lit("tax").alias("model"), (F.col("l_tax") * 12.5).alias("p")))).alias("m")) \
        .select("id", "y", "m.model", "m.p")


_CMP_SQL = """
  WITH two AS (
    SELECT 'discount' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS p FROM lineitem
    UNION ALL
    SELECT 'tax', CAST(l_returnflag = 'R' AS INTEGER), l_tax * 12.5 FROM lineitem),
  g AS (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg FROM two GROUP BY ALL),
  t AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY p DESC) AS tp,
               sum(neg) OVER (PARTITION BY model ORDER BY p DESC) AS fp,
               sum(pos) OVER (PARTITION BY model) AS "n_pos", sum(neg) OVER (PARTITION BY model) AS "n_neg" FROM g),
  m AS (SELECT model, round_even(sum(neg * (tp - pos + pos / 2.0)) / (max("n_pos") * max("n_neg")), 4) AS roc_auc,
               round_even(sum(pos / "n_pos" * tp / (tp + fp)), 4) AS pr_auc FROM t GROUP BY model),
  b AS (SELECT model, round_even(avg(power(least(greatest(p, 0.001), 0.999) - y, 2)), 4) AS brier_score
        FROM two GROUP BY model),
  lng AS (UNPIVOT (SELECT * FROM m JOIN b USING (model)) ON roc_auc, pr_auc, brier_score
          INTO NAME metric VALUE value)
  SELECT metric, max(value) FILTER (WHERE model = 'discount') AS model_a,
         max(value) FILTER (WHERE model = 'tax') AS model_b,
         max(value) FILTER (WHERE model = 'tax') - max(value) FILTER (WHERE model = 'discount') AS difference
  FROM lng GROUP BY metric"""


@query("metric_comparison", _CMP_SQL, dbl=["model_a", "model_b", "difference"])
def q_metric_comparison(spark, sf_dir):
    met = M.ranking_metrics(_two_models(spark, sf_dir), group_cols=["model"])
    return M.metric_comparison(met, "model", "discount", "tax")
