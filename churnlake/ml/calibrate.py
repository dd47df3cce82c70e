"""Sigmoid (Platt) calibration with stratified folds."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import one_row


def _margin(pred: DataFrame, out: str = "__m") -> DataFrame:
    # decision margin: raw score of the positive class minus the negative one
    raw = vector_to_array("rawPrediction")
    return pred.withColumn(out, raw[1] - raw[0])


def fit_platt(scored: DataFrame, label: str = "churned", margin: str = "__m"):
    """Platt scaling on a 1-D margin with smoothed targets t+ = (N+ + 1) /
    (N+ + 2), t- = 1 / (N- + 2): each row enters twice, as label 1 with
    weight t and label 0 with weight 1 - t."""
    c = one_row(scored.agg(F.sum(F.col(label)).alias("pos"), F.count(F.lit(1)).alias("n")))
    pos, neg = float(c["pos"] or 0), float(c["n"] - (c["pos"] or 0))
    t_pos, t_neg = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)
    t = F.when(F.col(label) == 1, F.lit(t_pos)).otherwise(F.lit(t_neg))
    doubled = (scored.select(margin, t.alias("__t"))
               .select(margin, F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("__t").alias("w")),
                                                 F.struct(F.lit(0.0).alias("y"), (1 - F.col("__t")).alias("w"))))
                       .alias("r"))
               .select(margin, "r.y", "r.w"))
    x = VectorAssembler(inputCols=[margin], outputCol="__mv").transform(doubled)
    return LogisticRegression(featuresCol="__mv", labelCol="y", weightCol="w", regParam=0.0,
                              standardization=False, maxIter=200).fit(x)


def calibrate_sigmoid(train: DataFrame, fit: Callable[[DataFrame], object], fold_col: str = "cal_fold",
                      k: int = 3, label: str = "churned"):
    """For each of ``k`` stratified folds fit the base model on the
    other folds and a Platt map on the held-out margins.  Returns the list
    of (base model, platt model) pairs; ``predict_calibrated`` averages
    their probabilities."""
    def one(f):
        base = fit(train.where(F.col(fold_col) != f))
        held = _margin(base.transform(train.where(F.col(fold_col) == f)))
        return base, fit_platt(held, label)

    with ThreadPool(k) as pool:     # the folds are independent chains of small jobs
        return pool.map(inheritable_thread_target(train.sparkSession)(one), range(k), 1)


def predict_calibrated(pairs, df: DataFrame, key: str = "user_id", out: str = "p_calibrated",
                       raw: str | None = None) -> DataFrame:
    """Mean of the calibrated probabilities; every model is applied to the
    same frame in one pass, so no join is needed (``key`` is kept for callers).
    ``raw`` names a column for the mean of the uncalibrated ones."""
    scored = df
    for i, (base, platt) in enumerate(pairs):
        m = (_margin(base.transform(scored)).withColumn(f"__r{i}", vector_to_array("probability")[1])
             .drop("rawPrediction", "probability", "prediction"))
        x = VectorAssembler(inputCols=["__m"], outputCol="__mv").transform(m)
        scored = (platt.transform(x).withColumn(f"__p{i}", vector_to_array("probability")[1])
                       .drop("__m", "__mv", "rawPrediction", "probability", "prediction"))
    for name, mark in [(out, "__p"), (raw, "__r")]:
        if name:
            mean = sum((F.col(f"{mark}{i}") for i in range(len(pairs))), F.lit(0.0)) / float(len(pairs))
            scored = scored.withColumn(name, mean)
    return scored.drop(*[f"{m}{i}" for i in range(len(pairs)) for m in ("__p", "__r")])
