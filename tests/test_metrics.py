"""Evaluation metrics on the reference's prediction fixtures and the
"""

import pytest
from pyspark.sql import functions as F

from churnlake.operators import metrics as M
from churnlake.operators import scoring as S


def frame(spark, y, p, pred=None):
    rows = [(i, yy, float(pp), (pred[i] if pred else None)) for i, (yy, pp) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "id bigint, y int, p double, pred int")


def test_classification_and_ranking(spark):
    df = frame(spark, [0, 1, 0, 1, 0, 1], [.1, .9, .2, .4, .3, .8], [0, 1, 0, 0, 0, 1])
    c = M.classification_metrics(df).first()
    assert (c["accuracy"], c["balanced_accuracy"], c["precision"], c["recall"], c["f1_score"]) == \
        (0.8333, 0.8333, 1.0, 0.6667, 0.8)
    r = M.ranking_metrics(df).first()
    assert (r["roc_auc"], r["pr_auc"], r["brier_score"]) == (1.0, 1.0, 0.0917)


def test_accuracy_only(spark):
    df = frame(spark, [0, 1, 0, 1], [0, 0, 0, 0], [0, 1, 0, 0])
    assert M.classification_metrics(df).first()["accuracy"] == 0.75


def test_ties(spark):
    df = frame(spark, [0, 0, 1, 1], [.1, .4, .35, .8])
    r = M.ranking_metrics(df).first()
    assert r["roc_auc"] == 0.75 and r["pr_auc"] == 0.8333


def test_optimal_threshold(spark):
    df = frame(spark, [0, 0, 0, 1, 1, 1, 1, 1], [.1, .2, .3, .6, .7, .8, .9, .95])
    r = M.optimal_threshold(df).first()
    assert r["optimal_threshold"] == 0.6 and r["max_f1"] == 1.0


def test_published_confusion_and_lift(spark):
    """TP 114, FP 454, FN 49, TN 383; 28 churners in the top 100 and 50 in
    the top 200 of 1,000 rows give lifts 1.7178 and 1.5337."""
    rows = []
    i = 0
    def add(n, y):
        nonlocal i
        for _ in range(n):
            rows.append((i, y))
            i += 1
    add(28, 1); add(72, 0); add(22, 1); add(78, 0); add(113, 1); add(687, 0)
    df = spark.createDataFrame([(k, y, 1.0 - k / 1000.0) for k, y in rows], "id bigint, y int, p double")
    assert M.lift_at_k(df, 0.1).first()["lift"] == 1.7178
    assert M.lift_at_k(df, 0.2).first()["lift"] == 1.5337
    cm = spark.createDataFrame([(1, 1)] * 114 + [(0, 1)] * 454 + [(1, 0)] * 49 + [(0, 0)] * 383, "y int, pred int")
    c = M.classification_metrics(cm).first()
    assert (c["accuracy"], c["balanced_accuracy"], c["precision"], c["recall"], c["f1_score"]) == \
        (0.497, 0.5785, 0.2007, 0.6994, 0.3119)
    got = {(r["y"], r["pred"]): r["n"] for r in M.confusion_matrix(cm).collect()}
    assert got == {(1, 1): 114, (0, 1): 454, (1, 0): 49, (0, 0): 383}


def test_lift_ties_broken_by_id(spark):
    df = spark.createDataFrame([(1, 1, .5), (2, 0, .5), (3, 0, .5), (4, 1, .5)], "id bigint, y int, p double")
    # top 1 of 4 (k=.25): id 1 -> a churner: (1/2)/.25 = 2
    assert M.lift_at_k(df, 0.25).first()["lift"] == 2.0


def test_risk_bands(spark):
    df = spark.createDataFrame([(x,) for x in (.1, .2, .3, .5, .7, .8, .9)], "p double")
    got = [r[0] for r in df.select(S.risk_level(F.col("p"), 0.5)).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "Medium", "High", "High"]
    df2 = spark.createDataFrame([(x,) for x in (.05, .12, .30)], "p double")
    assert [r[0] for r in df2.select(S.risk_level(F.col("p"), 0.18)).collect()] == ["Low", "Medium", "High"]


def test_auc_invariant_under_monotone_map(spark):
    from hypothesis import given, settings, strategies as st
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=4, max_size=30))
    def check(rows):
        if len({y for y, _ in rows}) < 2:
            return
        a = frame(spark, [y for y, _ in rows], [p / 20 for _, p in rows])
        b = frame(spark, [y for y, _ in rows], [(p / 20) ** 3 + 5 for _, p in rows])
        assert M.ranking_metrics(a).first()["roc_auc"] == M.ranking_metrics(b).first()["roc_auc"]
    check()
