"""Model fits with Spark ML.

Hyper-parameter names follow the reference's estimators; the mapping to
Spark ML is stated per function.  The logistic model trains on features
standardised with the train split's mean and population std (E2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import one_row
from churnlake.operators.scoring import scaler_stats, standardized
from churnlake.params import FEATURES


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def standardize(train: DataFrame, frames: dict[str, DataFrame], features: Sequence[str] = FEATURES,
                prefix: str = "z_") -> dict[str, DataFrame]:
    """Fit on ``train`` only, apply to every frame."""
    fitted = one_row(scaler_stats(train, features))
    return {k: standardized(v, fitted, features, prefix) for k, v in frames.items()}


def positive_probability(pred: DataFrame, out: str = "p") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def logistic(C: float = 1.0, max_iter: int = 1000, weight_sum: float = 1.0, weight_col: str | None = None,
             features_col: str = "features", label: str = "churned") -> LogisticRegression:
    """L2 logistic regression.  sklearn minimises C * sum(w l) + |b|^2/2,
    Spark sum(w l)/sum(w) + regParam |b|^2/2, so regParam = 1/(C sum(w));
    no internal standardisation (the input is already standardised)."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label, maxIter=max_iter,
                            regParam=1.0 / (C * weight_sum), elasticNetParam=0.0, standardization=False,
                            tol=1e-6)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1,
           max_features: str = "sqrt", seed: int = 42, weight_col: str | None = None,
           features_col: str = "features", label: str = "churned") -> RandomForestClassifier:
    """E5: n_estimators -> numTrees, max_depth None -> 30 (Spark's cap),
    min_samples_leaf -> minInstancesPerNode, max_features -> featureSubsetStrategy
    (min_samples_split has no Spark counterpart)."""
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label, numTrees=n_estimators,
                                maxDepth=min(max_depth or 30, 30), minInstancesPerNode=min_samples_leaf,
                                featureSubsetStrategy=str(max_features), seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def boosted(n_estimators: int = 100, max_depth: int = 4, learning_rate: float = 0.1, subsample: float = 1.0,
            gamma: float = 0.0, max_features: str = "all", min_samples_leaf: int = 1, seed: int = 42, weight_col: str | None = None,
            features_col: str = "features", label: str = "churned") -> GBTClassifier:
    """n_estimators -> maxIter, learning_rate -> stepSize, subsample ->
    subsamplingRate, gamma -> minInfoGain, scale_pos_weight -> weightCol.
    Approximations: colsample_bytree -> featureSubsetStrategy (drawn per
    node, not per tree), min_child_weight -> minInstancesPerNode (rows, not
    hessian weight); no L1/L2 leaf penalties in Spark."""
    gb = GBTClassifier(featuresCol=features_col, labelCol=label, maxIter=n_estimators, maxDepth=max_depth,
                       stepSize=learning_rate, subsamplingRate=subsample, minInfoGain=gamma, featureSubsetStrategy=max_features,
                       minInstancesPerNode=min_samples_leaf, seed=seed)
    if weight_col:
        gb.setWeightCol(weight_col)
    return gb


def feature_importance(model, names: Sequence[str]) -> DataFrame:
    """|coefficient| for linear models, impurity importances for trees;
    largest first (a per-feature table: one row per feature)."""
    if hasattr(model, "coefficients"):
        vals = [abs(float(x)) for x in model.coefficients.toArray()]
    else:
        vals = [float(x) for x in model.featureImportances.toArray()]
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.createDataFrame(list(zip(names, vals)), "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature")
