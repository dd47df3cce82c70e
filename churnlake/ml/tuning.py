"""Random search with stratified cross-validation (E7) and model choice
(E9).  Candidate points are drawn on the driver (a handful of parameter
dicts); every fit and every score runs on Spark, folds in parallel."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import one_row
from churnlake.operators.metrics import ranking_metrics
from churnlake.session import shared_path


class AveragePrecisionEvaluator(Evaluator):
    """Average precision (step sum), the reference's tuning score; Spark's
    ``areaUnderPR`` interpolates and differs."""

    def __init__(self, label: str = "churned"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        s = dataset.select(F.col(self.label).alias("y"), vector_to_array("probability")[1].alias("p"))
        return float(one_row(ranking_metrics(s, digits=None).select("pr_auc"))["pr_auc"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def point_at(space: dict, index: int) -> dict:
    """The ``index``-th point of the grid (the last name varies fastest), without building it."""
    out = {}
    for name in reversed(list(space)):
        index, k = divmod(index, len(space[name]))
        out[name] = space[name][k]
    return {name: out[name] for name in space}


def sample_points(space: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct points of the grid, drawn without replacement by index; all
    points of a smaller grid."""
    size = math.prod(len(v) for v in space.values())
    return [point_at(space, i) for i in random.Random(seed).sample(range(size), min(n_iter, size))]


def halving_search_cv(fit: Callable[[DataFrame, dict], object], space: dict, train: DataFrame, resource: str,
                      start: int, eta: int = 6, n_iter: int = 30, fold_col: str = "fold", n_folds: int = 5,
                      label: str = "churned", seed: int = 42, parallelism: int = 4):
    """E7 for ensembles: successive halving over ``n_iter`` drawn points.

    Every rung fits the points still in the race on all ``n_folds`` shared folds with at most
    ``start`` (then ``eta`` times as many, and so on) trees, writes the held-out scores as one
    table and takes the average precision of all points and folds from it in one grouped
    aggregate. The best 1/``eta`` of the points stay (ties: the earlier draw); the race ends when
    one is left or all that are left have their full ``resource``. A fold without positives
    scores 0. Returns (best point, results: one row a draw with its last rung)."""
    spark = train.sparkSession
    points = sample_points(space, n_iter, seed)
    path = shared_path(spark, "search_scores")
    alive, size, rung, results = list(range(len(points))), start, 0, {}

    def score(job):
        i, fold = job
        p = points[i] | {resource: min(points[i][resource], size)}
        model = fit(train.where(F.col(fold_col) != fold), p)
        held = model.transform(train.where(F.col(fold_col) == fold))
        (held.select(F.col(label).cast("int").alias("y"), vector_to_array("probability")[1].alias("p"))
             .write.mode("overwrite").parquet(f"{path}/rung={rung}/point={i}/fold={fold}"))

    while True:
        with ThreadPool(parallelism) as pool:   # a fit is a chain of small jobs: several run side by side
            pool.map(inheritable_thread_target(spark)(score), [(i, f) for i in alive for f in range(n_folds)], 1)
        scored = (spark.read.schema("y int, p double, point int, fold int").parquet(f"{path}/rung={rung}"))
        ap = (ranking_metrics(scored, digits=None, group_cols=["point", "fold"])
              .groupBy("point").agg((F.sum("pr_auc") / F.lit(float(n_folds))).alias("ap")))
        got = {r["point"]: float(r["ap"] or 0.0) for r in ap.collect()}      # one row a drawn point
        for i in alive:
            results[i] = (i, json.dumps(points[i], sort_keys=True), rung, min(points[i][resource], size), got.get(i, 0.0))
        ranked = sorted(alive, key=lambda i: (-results[i][-1], i))
        if len(alive) == 1 or all(points[i][resource] <= size for i in alive):
            break
        alive = ranked[:math.ceil(len(alive) / eta)]
        if len(alive) == 1:
            break
        size, rung = size * eta, rung + 1
    best = ranked[0]
    res = spark.createDataFrame([(*results[i], i == best) for i in range(len(points))],
                                "point int, params string, rung int, trees int, mean_average_precision double, best boolean")
    return points[best], res


def random_search_cv(estimator: Estimator, space: dict, train: DataFrame, n_iter: int = 30,
                     fold_col: str = "fold", label: str = "churned", seed: int = 42, parallelism: int = 4,
                     n_folds: int = 5):
    """CV score (mean average precision over the folds) of each sampled
    point; the best point is refit on all of ``train``.  Returns (best
    model, results DataFrame)."""
    points = sample_points(space, n_iter, seed)
    maps = [{estimator.getParam(k): v for k, v in p.items()} for p in points]
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=AveragePrecisionEvaluator(label),
                        foldCol=fold_col, numFolds=n_folds, parallelism=parallelism, seed=seed)
    model = cv.fit(train)
    rows = [(i, json.dumps(p, sort_keys=True), float(m)) for i, (p, m) in enumerate(zip(points, model.avgMetrics))]
    res = train.sparkSession.createDataFrame(rows, "point int, params string, mean_average_precision double")
    return model.bestModel, res


def select_model(metrics: DataFrame, score: str = "val_pr_auc", order_col: str = "model_order") -> DataFrame:
    """The model with the highest validation score; the earlier model
    wins a tie (test metrics are never used)."""
    return metrics.agg(F.max_by(F.struct(*metrics.columns),
                                F.struct(F.col(score), (-F.col(order_col)).alias("o"))).alias("b")).select("b.*")
