"""Model fits, shared-fold search, calibration, run table and model choice."""

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.ml import calibrate as CAL
from churnlake.ml import models as ML
from churnlake.ml import tuning as TU
from churnlake.ml.split import stratified_folds, stratified_split, with_weights
from churnlake.operators.metrics import ranking_metrics
from churnlake.params import FEATURES
from churnlake.plans import training as TR


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(1200, len(FEATURES)))
    z = 1.6 * x[:, 0] - 1.1 * x[:, 1] + 0.8 * x[:, 2] * x[:, 3] - 0.6
    return x, (rnd.random(1200) < 1 / (1 + np.exp(-z))).astype(int)


@pytest.fixture(scope="module")
def data(spark, rows):
    x, y = rows
    d = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(len(y))],
                              "user_id bigint, churned int, " + ", ".join(f"{f} double" for f in FEATURES))
    s = stratified_split(d)
    train = s.where("split = 'train'")
    z = ML.assemble(ML.assemble(s, FEATURES, "features"), FEATURES, "raw_features")
    z = with_weights(z, balanced=True, out="w_balanced", fit_on=train).withColumn("w_none", F.lit(1.0))
    for k, out, seed in [(5, "fold", 42), (3, "cal_fold", 43)]:
        z = z.join(stratified_folds(train, k, seed=seed, out=out).select("user_id", out), "user_id", "left")
    return z.coalesce(2).checkpoint() if spark.sparkContext.getCheckpointDir() else z.coalesce(2).persist()


def _ap(model, df):
    s = ML.positive_probability(model.transform(df)).select(F.col("churned").alias("y"), "p")
    return ranking_metrics(s, digits=None).first()["pr_auc"]


def test_logistic_equals_newton_steps_on_the_penalised_loss(data, rows):
    """C * sum(loss) + |b|^2 / 2 with an unpenalised intercept, solved in numpy."""
    train = data.where("split = 'train'")
    ids = [r.user_id for r in train.select("user_id").collect()]
    x, y = rows[0][ids], rows[1][ids]
    a = np.hstack([x, np.ones((len(y), 1))])
    for c in (0.05, 1.0):
        b = np.zeros(a.shape[1])
        pen = np.append(np.ones(x.shape[1]), 0.0)
        for _ in range(50):
            p = 1 / (1 + np.exp(-a @ b))
            b -= np.linalg.solve(c * (a * (p * (1 - p))[:, None]).T @ a + np.diag(pen), c * a.T @ (p - y) + pen * b)
        m = TR.fit_logistic(train, C=c, balanced=False)
        got = np.append(m.coefficients.toArray(), m.intercept)
        assert np.abs(got - b).max() < 2e-3, c


def test_forest_and_boosting_learn_and_rank_the_features(data):
    train, val = data.where("split = 'train'"), data.where("split = 'validation'")
    base = val.agg(F.avg("churned")).first()[0]
    for m in (TR.fit_forest(train, TR.RF_DEFAULTS | {"n_estimators": 20}),
              TR.fit_boosted(train, TR.GB_DEFAULTS | {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3})):
        assert _ap(m, val) > base + 0.15
        top = [r.feature for r in ML.feature_importance(m, FEATURES).collect()]
        assert set(top[:2]) == set(FEATURES[:2])


def test_points_are_drawn_from_the_grid_without_repeats():
    space = {"a": [1, 2, 3], "b": ["x", "y"], "c": [None, 0.5]}
    grid = [dict(zip(space, p)) for p in itertools.product(*space.values())]
    assert [TU.point_at(space, i) for i in range(12)] == grid
    assert sorted(map(str, TU.sample_points(space, 99))) == sorted(map(str, grid))
    pts = TU.sample_points(TR.GB_SPACE, 30)
    assert len({json.dumps(p) for p in pts}) == 30 and pts == TU.sample_points(TR.GB_SPACE, 30)


def test_halving_keeps_the_best_points_of_every_rung(data):
    train = data.where("split = 'train'")
    space = {"n_estimators": [2, 12], "max_depth": [1, 4], "min_samples_leaf": [2, 20], "max_features": ["sqrt"],
             "class_weight": ["balanced"]}
    best, res = TU.halving_search_cv(TR.fit_forest, space, train, "n_estimators", start=2, eta=4, n_iter=30)
    got = res.orderBy("point").collect()
    assert len(got) == 8 and sum(r.best for r in got) == 1
    win = next(r for r in got if r.best)
    assert json.loads(win.params) == best
    # every draw was measured; the second rung holds a quarter of them, with more trees where they have them
    later = [r for r in got if r.rung == 1]
    assert len(later) == 2 and all(r.trees == min(json.loads(r.params)["n_estimators"], 8) for r in later)
    # the score is the plain mean over the folds
    p = best | {"n_estimators": win.trees}
    mean = np.mean([_ap(TR.fit_forest(train.where(F.col("fold") != f), p), train.where(F.col("fold") == f)) for f in range(5)])
    assert abs(mean - win.mean_average_precision) < 1e-9


def test_calibration_moves_the_balanced_forest_towards_the_frequencies(data):
    train, val = data.where("split = 'train'"), data.where("split = 'validation'")
    par = TR.RF_DEFAULTS | {"n_estimators": 15, "max_depth": 4}
    pairs = CAL.calibrate_sigmoid(train, lambda t: TR.fit_forest(t, par), "cal_fold", 3)
    assert len(pairs) == 3
    out = CAL.predict_calibrated(pairs, val, raw="p_raw")
    assert set(out.columns) == set(val.columns) | {"p_calibrated", "p_raw"}
    m = out.agg(F.avg("p_calibrated").alias("p"), F.avg("churned").alias("y"), F.min("p_calibrated").alias("lo"),
                F.max("p_calibrated").alias("hi")).first()
    assert 0 < m.lo < m.hi < 1 and abs(m.p - m.y) < 0.12


def test_run_table_holds_a_tuned_calibrated_row_a_model(data):
    rf = {"n_estimators": [3, 6], "max_depth": [3], "min_samples_leaf": [5], "class_weight": [None, "balanced"]}
    gb = {"n_estimators": [2, 4], "max_depth": [2], "learning_rate": [0.3], "subsample": [1.0], "colsample_bytree": [1.0],
          "min_child_weight": [3], "scale_pos_weight": [1]}
    models = {"forest": (TR.fit_forest, TR.RF_DEFAULTS, lambda t: TR.search_forest(t, rf, 4, 2)),
              "boosted": (TR.fit_boosted, TR.GB_DEFAULTS, lambda t: TR.search_boosted(t, gb, 2, 2))}
    runs = TR.run_table(data, tune=True, models=models)
    got = {r.model: r for r in runs.collect()}
    assert set(got) == {"forest", "boosted"}
    n = {r.split: r["count"] for r in data.groupBy("split").count().collect()}
    for r in got.values():
        assert r.tuned and r.calibration == "sigmoid" and json.loads(r.params)["n_estimators"] in (2, 3, 4, 6)
        assert (r.n_train, r.n_validation, r.n_test) == (n["train"], n["validation"], n["test"])
        assert 0 < r.val_pr_auc <= 1 and r.lift_at_10pct > 1 and 0 < r.threshold < 1
    win = TU.select_model(runs).first()
    assert win.model == max(got.values(), key=lambda r: (r.val_pr_auc, -r.model_order)).model


def test_select_model_first_wins_a_tie(spark):
    m = spark.createDataFrame([(1, "b", 0.5), (0, "a", 0.5), (2, "c", 0.4)], "model_order int, model string, val_pr_auc double")
    assert TU.select_model(m).first().model == "a"
