"""Registered queries: splits, scaling and weights (SQL-checked) and the
Spark ML fits, tuning, calibration and run table (row checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.ml import calibrate as CAL
from churnlake.ml import models as ML
from churnlake.ml import split as SP
from churnlake.ml import tuning as TU
from churnlake.operators import diagnostics as J
from churnlake.operators import metrics as M
from churnlake.params import FEATURES
from churnlake.plans import training as TR
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.registry import query
from churnlake.session import cut_lineage

_SPLIT_SQL = """
  spl AS (
    SELECT m.*, CASE WHEN rk <= ceil(n * 0.2::DOUBLE) THEN 'test'
                     WHEN rk <= ceil(n * 0.2::DOUBLE) + ceil((n - ceil(n * 0.2::DOUBLE)) * 0.25::DOUBLE)
                     THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY churned ORDER BY md5(CAST(user_id AS VARCHAR) || '|42')) AS rk,
                 count(*) OVER (PARTITION BY churned) AS n FROM matrix) m)"""


@query("stratified_split", "WITH" + _SPLIT_SQL + "\n  SELECT user_id, churned, split FROM spl")
def q_stratified_split(spark, sf_dir):
    m = Domain(spark, sf_dir, P).matrix
    return SP.stratified_split(m, seed=P.seed).select("user_id", "churned", "split")


@query("standardize", "WITH" + _SPLIT_SQL + ", st AS (SELECT {stats} FROM spl WHERE split = 'train')\n"
       "  SELECT user_id, {z} FROM spl, st".format(
           stats=", ".join([f"avg({f}) AS m_{f}" for f in FEATURES]
                           + [f"CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}"
                              for f in FEATURES]),
           z=", ".join(f"(CAST({f} AS DOUBLE) - m_{f}) / s_{f} AS z_{f}" for f in FEATURES)),
       dbl=[f"z_{f}" for f in FEATURES])
def q_standardize(spark, sf_dir):
    s = SP.stratified_split(Domain(spark, sf_dir, P).matrix, seed=P.seed)
    z = ML.standardize(s.where(F.col("split") == "train"), {"all": s})["all"]
    return z.select("user_id", *[f"z_{f}" for f in FEATURES])


@query("class_weights", "WITH" + _SPLIT_SQL + """
  SELECT churned, count(*) AS n_class, (SELECT count(*) FROM spl WHERE split = 'train') / (2.0 * count(*)) AS weight
  FROM spl WHERE split = 'train' GROUP BY churned""", dbl=["weight"])
def q_class_weights(spark, sf_dir):
    s = SP.stratified_split(Domain(spark, sf_dir, P).matrix, seed=P.seed)
    return SP.class_weights(s.where(F.col("split") == "train"))


def _coef_table(spark, model, names):
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())] + [("(intercept)",
                                                                                    float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@query("train_logistic")
def q_train_logistic(spark, sf_dir):
    d = TR.prepared(spark, sf_dir)
    model = TR.fit_logistic(d.where(F.col("split") == "train"))
    return _coef_table(spark, model, FEATURES)


@query("train_forest")
def q_train_forest(spark, sf_dir):
    d = TR.prepared(spark, sf_dir)
    return ML.feature_importance(TR.fit_forest(d.where(F.col("split") == "train")), FEATURES)


@query("train_boosted")
def q_train_boosted(spark, sf_dir):
    d = TR.prepared(spark, sf_dir)
    return ML.feature_importance(TR.fit_boosted(d.where(F.col("split") == "train")), FEATURES)


@query("random_search_cv")
def q_random_search_cv(spark, sf_dir):
    """E7 for the logistic model: the 18 distinct points of its space (the
    reference asks for 30 draws of a grid this size), 5 stratified folds,
    average precision; class_weight switches the weight column."""
    return TR.search_logistic(TR.prepared(spark, sf_dir).where(F.col("split") == "train"))[1]


@query("calibrate_sigmoid")
def q_calibrate_sigmoid(spark, sf_dir):
    """E8 for the three models: raw and calibrated probability of every validation row."""
    d = TR.prepared(spark, sf_dir)
    train, val = d.where(F.col("split") == "train"), d.where(F.col("split") == "validation")
    out = None
    for name, (fit, params, _) in TR.MODELS.items():
        pairs = CAL.calibrate_sigmoid(train, lambda t: fit(t, params), "cal_fold", TR.CAL_FOLDS)
        # the raw probability is the mean of the same three base models
        x = CAL.predict_calibrated(pairs, val, raw="p_raw")
        x = x.select("user_id", "churned", F.lit(name).alias("model"), "p_raw", "p_calibrated")
        out = x if out is None else out.unionByName(x)
    return out


@query("select_model")
def q_select_model(spark, sf_dir):
    """E9 over the calibrated models at their default parameters."""
    return TU.select_model(TR.run_table(TR.prepared(spark, sf_dir)))


# three given scorers on the validation rows; the third equals the first, so the earlier one wins
_SCORERS = [("recency", "days_since_last_order"), ("coupons", "coupon_usage_rate"), ("recency_again", "days_since_last_order")]


@query("select_by_validation", "WITH" + _SPLIT_SQL + ", x AS (" + " UNION ALL ".join(
    f"SELECT {i} AS model_order, '{n}' AS model, churned AS y, coalesce(CAST({f} AS DOUBLE), 0) AS p FROM spl WHERE split = 'validation'"
    for i, (n, f) in enumerate(_SCORERS)) + """),
  g AS (SELECT model_order, model, p, sum(y) AS pos, count(*) AS cnt FROM x GROUP BY ALL),
  t AS (SELECT *, sum(pos) OVER w AS tp, sum(cnt) OVER w AS above,
               sum(pos) OVER (PARTITION BY model) AS all_pos
        FROM g WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
  m AS (SELECT model_order, model, round_even(sum(pos / all_pos * tp / above), 9) AS val_pr_auc FROM t GROUP BY ALL)
  SELECT * FROM m ORDER BY val_pr_auc DESC, model_order LIMIT 1""", dbl=["val_pr_auc"], ints=["model_order"])
def q_select_by_validation(spark, sf_dir):
    """E9 on scores that SQL can state; rounded to nine digits, so that equal scorers tie."""
    v = SP.stratified_split(Domain(spark, sf_dir, P).matrix, seed=P.seed).where(F.col("split") == "validation")
    long = v.select(F.col("churned").alias("y"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("model_order"), F.lit(n).alias("model"),
                 F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias("p"))
        for i, (n, f) in enumerate(_SCORERS)])).alias("s")).select("y", "s.*")
    met = M.ranking_metrics(long, digits=9, group_cols=["model_order", "model"])
    return TU.select_model(met.select(F.col("model_order").cast("bigint").alias("model_order"), "model",
                                      F.col("pr_auc").alias("val_pr_auc")))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    d = TR.prepared(spark, sf_dir)
    return ML.feature_importance(TR.fit_logistic(d.where(F.col("split") == "train")), FEATURES)


@query("model_run_table")
def q_model_run_table(spark, sf_dir):
    """One appended row per run of the three calibrated models (parameters, validation
    PR-AUC, F1-optimal threshold, test metrics at it, lift, split sizes, class balance)."""
    return TR.run_table(TR.prepared(spark, sf_dir))


def _leaky_frames(spark, sf_dir):
    dom = Domain(spark, sf_dir, P)
    leak = J.leaky_features(dom.subscriptions, dom.matrix, P)
    return TR.prepared(spark, sf_dir, leak)


LEAKED = ["is_sub_active", "days_since_cancellation", "total_subscription_days"]


@query("leak_importance_share")
def q_leak_importance_share(spark, sf_dir):
    d = _leaky_frames(spark, sf_dir)
    x = ML.assemble(d.drop("raw_features"), FEATURES + LEAKED, "raw_features")
    model = TR.fit_forest(x.where(F.col("split") == "train"))
    return J.leak_importance_share(ML.feature_importance(model, FEATURES + LEAKED), LEAKED)


LEAK_TEST_FRAC = 0.3


def leak_split(m):
    """The study's 70/30 split with class weights, written once, dealt out for the fits."""
    s = SP.stratified_split(m, seed=P.seed, test_frac=LEAK_TEST_FRAC, val_frac=0.0)
    s = SP.with_weights(s, balanced=True, out="w_balanced", fit_on=s.where(F.col("split") == "train"))
    return cut_lineage(SP.spread_rows(s))


@query("leaky_vs_honest")
def q_leaky_vs_honest(spark, sf_dir):
    """One 70/30 split, the same forest (200 trees, depth 10, balanced) on two feature
    sets; test metrics at each model's F1-optimal threshold side by side (F10 shape)."""
    dom = Domain(spark, sf_dir, P)
    s = leak_split(J.leaky_features(dom.subscriptions, dom.matrix, P))
    met = None
    for name, cols in [("honest", FEATURES), ("leaky", FEATURES + LEAKED)]:
        x = ML.assemble(s, cols, "raw_features")
        model = TR.fit_forest(x.where(F.col("split") == "train"), TR.RF_DEFAULTS | {"min_samples_leaf": 1})
        pt = cut_lineage(ML.positive_probability(model.transform(x.where(F.col("split") == "test")))
                         .select(F.col("churned").alias("y"), "p"))
        best = M.optimal_threshold(pt, digits=None)
        row = (M.ranking_metrics(pt).select("roc_auc", "pr_auc")
               .join(best.select(F.bround("max_f1", 4).alias("f1_opt"), F.bround("precision_at_optimal", 4).alias("precision"),
                                 F.bround("recall_at_optimal", 4).alias("recall"),
                                 F.bround("optimal_threshold", 4).alias("optimal_threshold")))
               .select(F.lit(name).alias("model"), "*"))
        met = row if met is None else met.unionByName(row)
    return M.metric_comparison(met, "model", "honest", "leaky")
