"""Training plan: matrix -> split -> scale -> fit -> calibrate -> threshold
-> select, with the prepared table checkpointed once (model fits iterate
over it many times; the checkpoint cuts the long feature lineage)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import one_row
from churnlake.ml import calibrate as CAL
from churnlake.ml import models as ML
from churnlake.ml import tuning as TU
from churnlake.ml.split import stratified_folds, stratified_split, with_weights
from churnlake.operators import metrics as M
from churnlake.params import FEATURES
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.session import cut_lineage, shared_path
from churnlake.sources import io

# Reference defaults and search space (fixed values).
LR_DEFAULTS = {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"}
RF_DEFAULTS = {"n_estimators": 200, "max_depth": 10, "min_samples_split": 20, "min_samples_leaf": 10,
               "class_weight": "balanced"}
GB_DEFAULTS = {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8,
               "colsample_bytree": 0.8, "min_child_weight": 3, "scale_pos_weight": 3}
LR_SPACE = {"C": [0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0], "class_weight": [None, "balanced"]}
RF_SPACE = {"n_estimators": [100, 200, 400, 600, 800], "max_depth": [None, 6, 10, 15, 20],
            "min_samples_leaf": [1, 2, 5, 10], "max_features": ["sqrt", "log2", None], "class_weight": [None, "balanced"]}
GB_SPACE = {"n_estimators": [100, 200, 400, 600, 800], "max_depth": [3, 4, 5, 6, 7],
            "learning_rate": [0.01, 0.03, 0.05, 0.1], "subsample": [0.6, 0.7, 0.8, 1.0],
            "colsample_bytree": [0.6, 0.7, 0.8, 1.0], "min_child_weight": [1, 3, 5, 7], "gamma": [0, 0.1, 0.3],
            "scale_pos_weight": [1, 2, 3, 5]}
N_ITER = 30
CV_FOLDS = 5
CAL_FOLDS = 3


def prepared(spark, sf_dir, matrix: DataFrame | None = None) -> DataFrame:
    """One row per user: features, split, CV folds, calibration folds,
    standardised features (train statistics), assembled vectors and the
    weight columns; checkpointed."""
    m = matrix if matrix is not None else Domain(spark, sf_dir, P).matrix
    s = cut_lineage(stratified_split(m, seed=P.seed))   # read by every fit of this function
    train = s.where(F.col("split") == "train")
    z = ML.standardize(train, {"all": s})["all"]
    z = ML.assemble(z, [f"z_{f}" for f in FEATURES], "features")
    z = ML.assemble(z, FEATURES, "raw_features")
    # class weights come from the training rows alone: no held-out label is seen
    z = with_weights(z, balanced=True, out="w_balanced", fit_on=train).withColumn("w_none", F.lit(1.0))
    z = with_weights(z, balanced=False, pos_factor=float(GB_DEFAULTS["scale_pos_weight"]), out="w_pos")
    z = z.join(stratified_folds(s.where(F.col("split") == "train").select("user_id", "churned"), CV_FOLDS,
                                seed=P.seed).select("user_id", "fold"), "user_id", "left")
    z = z.join(stratified_folds(s.where(F.col("split") == "train").select("user_id", "churned"), CAL_FOLDS,
                                seed=P.seed + 1, out="cal_fold").select("user_id", "cal_fold"), "user_id", "left")
    return cut_lineage(z)


def fit_logistic(train: DataFrame, C: float = LR_DEFAULTS["C"], balanced: bool = True):
    n = train.count()
    return ML.logistic(C=C, max_iter=LR_DEFAULTS["max_iter"], weight_sum=float(n),
                       weight_col="w_balanced" if balanced else "w_none").fit(train)


def fit_forest(train: DataFrame, params: dict = RF_DEFAULTS):
    """E5 at one point of its space. min_samples_split has no counterpart in Spark."""
    return ML.forest(n_estimators=params["n_estimators"], max_depth=params["max_depth"],
                     min_samples_leaf=params["min_samples_leaf"],
                     max_features=params.get("max_features", "sqrt") or "all",
                     weight_col="w_balanced" if params["class_weight"] else "w_none",
                     features_col="raw_features", seed=P.seed).fit(train)


def fit_boosted(train: DataFrame, params: dict = GB_DEFAULTS):
    """E6 at one point of its space (leaf penalties have no counterpart in Spark)."""
    weighted = with_weights(train.drop("w_pos"), balanced=False, pos_factor=float(params["scale_pos_weight"]), out="w_pos")
    return ML.boosted(n_estimators=params["n_estimators"], max_depth=params["max_depth"],
                      learning_rate=params["learning_rate"], subsample=params["subsample"],
                      gamma=params.get("gamma", 0.0), max_features=str(params["colsample_bytree"]),
                      min_samples_leaf=params["min_child_weight"], weight_col="w_pos",
                      features_col="raw_features", seed=P.seed).fit(weighted)


def search_logistic(train: DataFrame):
    """E7 for the logistic model: all 18 points on all folds. Returns (best parameters, results)."""
    n_fit = train.count() * (CV_FOLDS - 1) / CV_FOLDS
    space = {"regParam": [1.0 / (c * n_fit) for c in LR_SPACE["C"]], "weightCol": ["w_none", "w_balanced"]}
    # the folds are cached: only the columns that fits and scores read
    used = train.select("churned", "fold", "features", "w_none", "w_balanced")
    best, res = TU.random_search_cv(ML.logistic(weight_col="w_none"), space, used, N_ITER, "fold", seed=P.seed,
                                    n_folds=CV_FOLDS)
    reg, weight = best.getRegParam(), best.getWeightCol()
    c = min(LR_SPACE["C"], key=lambda c: abs(1.0 / (c * n_fit) - reg))
    return LR_DEFAULTS | {"C": c, "class_weight": "balanced" if weight == "w_balanced" else None}, res


def search_forest(train: DataFrame, space: dict = RF_SPACE, n_iter: int = N_ITER, start: int = 20):
    best, res = TU.halving_search_cv(fit_forest, space, train, "n_estimators", start, n_iter=n_iter, n_folds=CV_FOLDS,
                                     seed=P.seed)
    return best, res


def search_boosted(train: DataFrame, space: dict = GB_SPACE, n_iter: int = N_ITER, start: int = 5):
    best, res = TU.halving_search_cv(fit_boosted, space, train, "n_estimators", start, n_iter=n_iter, n_folds=CV_FOLDS,
                                     seed=P.seed)
    return best, res


def _logistic_at(train: DataFrame, params: dict = LR_DEFAULTS):
    return fit_logistic(train, C=params["C"], balanced=bool(params["class_weight"]))


#: name -> (fit at parameters, defaults, search); in the order that settles ties.
MODELS = {"logistic": (_logistic_at, LR_DEFAULTS, search_logistic),
          "forest": (fit_forest, RF_DEFAULTS, search_forest),
          "boosted": (fit_boosted, GB_DEFAULTS, search_boosted)}


def train_model(d: DataFrame, name: str, tune: bool = False, models: dict = MODELS) -> dict:
    """One run (E11): parameters by search or the defaults, sigmoid calibration over three folds
    of the training rows, threshold and PR-AUC from the validation rows, then the test rows:
    classification and ranking metrics, lift in the top 10 % and 20 %."""
    fit, params, search = models[name]
    train = d.where(F.col("split") == "train")
    if tune:
        params, _ = search(train)
    pairs = CAL.calibrate_sigmoid(train, lambda t: fit(t, params), "cal_fold", CAL_FOLDS)
    # scored once: the metrics below read the written scores, not the models
    scored = cut_lineage(CAL.predict_calibrated(pairs, d.where(F.col("split") != "train"))
                         .select("user_id", "split", F.col("churned").cast("int").alias("y"), F.col("p_calibrated").alias("p")))
    val, test = scored.where(F.col("split") == "validation"), scored.where(F.col("split") == "test")
    ap = one_row(M.ranking_metrics(val, digits=None))["pr_auc"]
    best = one_row(M.optimal_threshold(val, digits=None))
    thr = best["optimal_threshold"]
    cls = one_row(M.classification_metrics(test.withColumn("pred", (F.col("p") >= F.lit(thr)).cast("int"))))
    rk = one_row(M.ranking_metrics(test))
    lifts = {f"lift_at_{k}pct": one_row(M.lift_at_k(test, k / 100, id_col="user_id"))["lift"] for k in (10, 20)}
    return {"model_order": list(models).index(name), "model": name, "params": json.dumps(params, sort_keys=True),
            "tuned": tune, "calibration": "sigmoid", "val_pr_auc": float(ap or 0.0), "threshold": thr,
            "max_f1": best["max_f1"], **cls, **rk, **lifts}


RUN_SCHEMA = ("model_order int, model string, params string, tuned boolean, calibration string, val_pr_auc double, "
              "threshold double, max_f1 double, accuracy double, balanced_accuracy double, precision double, "
              "recall double, f1_score double, roc_auc double, pr_auc double, brier_score double, "
              "lift_at_10pct double, lift_at_20pct double, n_features int, n_train long, n_validation long, "
              "n_test long, positive_share double")


def run_table(d: DataFrame, tune: bool = False, models: dict = MODELS) -> DataFrame:
    """One row a run, appended to a stored table (``model_runs``) and read back."""
    spark = d.sparkSession
    c = one_row(d.agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "validation", "test")],
                      F.avg(F.when(F.col("split") == "train", F.col("churned"))).alias("share")))
    about = {"n_features": len(FEATURES), "n_train": c["train"], "n_validation": c["validation"], "n_test": c["test"],
             "positive_share": c["share"]}
    path = shared_path(spark, "model_runs")
    for name in models:
        row = train_model(d, name, tune, models) | about
        names = [x.split()[0] for x in RUN_SCHEMA.split(", ")]
        spark.createDataFrame([tuple(row[n] for n in names)], RUN_SCHEMA).write.mode("append").parquet(path)
    return io.read_parquet(spark, path)
