"""Drift statistics: identities and closed forms."""

import math

import pytest
from pyspark.sql import functions as F

from churnlake.operators import drift as DR
from churnlake.params import Params


def side(spark, vals):
    return spark.createDataFrame([(float(v),) for v in vals], "x double")


def test_identical_sides(spark):
    vals = [i % 37 + (i % 7) / 10 for i in range(300)]
    ref, cur = side(spark, vals), side(spark, vals)
    vc = DR.value_counts(ref, cur, ["x"])
    assert DR.ks_test(vc).first()["ks_statistic"] == 0.0
    assert DR.psi(vc).first()["psi"] == pytest.approx(0.0, abs=1e-12)
    rep = DR.drift_report(DR.column_drift(ref, cur, ["x"]), 300, 300).first()
    assert rep["status"] == "ok" and rep["n_drifted_features"] == 0


def test_disjoint_sides(spark):
    ref, cur = side(spark, range(0, 100)), side(spark, range(1000, 1100))
    vc = DR.value_counts(ref, cur, ["x"])
    assert DR.ks_test(vc).first()["ks_statistic"] == 1.0
    r = DR.column_drift(ref, cur, ["x"]).first()
    assert r["drifted"] and r["test"] == "ks"


def test_psi_matches_numpy(spark):
    import numpy as np
    a = [float(v) for v in np.random.default_rng(1).normal(0, 1, 400).round(2)]
    b = [float(v) for v in np.random.default_rng(2).normal(0.3, 1.2, 300).round(2)]
    edges = np.unique(np.percentile(np.concatenate([a, b]), np.linspace(0, 100, 11)))
    e = np.histogram(a, bins=edges)[0] + 1e-10
    c = np.histogram(b, bins=edges)[0] + 1e-10
    e, c = e / e.sum(), c / c.sum()
    want = float(((c - e) * np.log(c / e)).sum())
    got = DR.psi(DR.value_counts(side(spark, a), side(spark, b), ["x"])).first()["psi"]
    assert got == pytest.approx(want, rel=1e-9)


def test_chi_square_closed_forms(spark):
    df = spark.createDataFrame([(x, d) for x in (0.5, 2.0, 7.3) for d in (1, 2, 3, 4)], "x double, d int")
    got = {(r["x"], r["d"]): r["p"] for r in df.select("x", "d", DR.chi2_sf(F.col("x"), F.col("d")).alias("p")).collect()}
    for x in (0.5, 2.0, 7.3):
        assert got[(x, 1)] == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-6)
        assert got[(x, 2)] == pytest.approx(math.exp(-x / 2), rel=1e-12)
        assert got[(x, 3)] == pytest.approx(math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2),
                                            rel=1e-6)
        assert got[(x, 4)] == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)


def test_few_samples_no_test(spark):
    r = DR.column_drift(side(spark, [1, 2, 3]), side(spark, range(50)), ["x"], Params()).first()
    assert r["test"] == "none" and r["p_value"] == 1.0 and not r["drifted"]


def test_report_thresholds(spark):
    cd = spark.createDataFrame([(f"f{i}", i < 3) for i in range(10)], "feature string, drifted boolean")
    r = DR.drift_report(cd, 10, 10).first()
    assert r["status"] == "critical" and r["drift_share"] == 0.3 and r["dataset_drift"]
    cd2 = spark.createDataFrame([(f"f{i}", i < 2) for i in range(10)], "feature string, drifted boolean")
    assert DR.drift_report(cd2, 10, 10).first()["status"] == "warning"


def _brute_ks(n, m):
    """Distance * n * m -> share of all orders with at least that distance."""
    import itertools
    from collections import Counter
    seen = Counter()
    for first in itertools.combinations(range(n + m), n):
        i = j = d = 0
        for k in range(n + m):
            if k in first:
                i += 1
            else:
                j += 1
            d = max(d, abs(i * m - j * n))
        seen[d] += 1
    total = sum(seen.values())
    return {d: sum(c for e, c in seen.items() if e >= d) / total for d in seen}


def test_exact_ks_pvalue_is_that_of_all_orders(spark):
    rows = [(d / (n * m), n, m, p) for n, m in ((3, 4), (5, 5), (6, 2), (7, 6), (1, 3), (8, 4)) for d, p in _brute_ks(n, m).items()]
    df = spark.createDataFrame(rows + [(0.0, 4, 4, 1.0)], "d double, n long, m long, p double")
    for r in df.withColumn("got", DR.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-12)


def test_exact_and_limit_meet_at_the_switch(spark):
    df = spark.createDataFrame([(0.02, 10_000, 10_000), (0.02, 10_001, 10_000), (0.9, 50, 60)], "d double, n long, m long")
    a, b, far = [r[0] for r in df.select(DR.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert a == pytest.approx(b, rel=0.01) and a != b and far < 1e-12


def test_many_batches_against_one_reference(spark, monkeypatch):
    import random
    rng = random.Random(9)
    # small rank buckets, ties, values that only one side has, an empty side, a NULL batch
    monkeypatch.setattr(DR, "RANK_BUCKETS", 7)
    ref = [(round(rng.gauss(0, 3), 1), float(rng.randint(0, 3)), rng.random(), None) for _ in range(400)]
    cur = [(b, round(rng.gauss(i, 3), 1) if i != 2 else 1.5, float(rng.randint(0, 3)), 2 * rng.random() if i != 1 else None, 1.0)
           for i, b in enumerate(["a", "b", "c", None]) for _ in range(rng.choice([60, 150]))]
    cols = ["tied", "cat", "free", "gone"]
    r = spark.createDataFrame(ref, "tied double, cat double, free double, gone double")
    c = spark.createDataFrame(cur, "b string, tied double, cat double, free double, gone double")
    got = {(x["b"], x["feature"]): x for x in DR.column_drift(r, c, cols, batch_cols=["b"]).collect()}
    assert len(got) == 4 * 4 - 1  # batch b has no value of free
    for b in ("a", "b", "c", None):
        one = c.where(F.col("b").eqNullSafe(F.lit(b))).drop("b")
        counts = DR.value_counts(r, one, cols)
        tested = counts.where(F.col("feature").isin([f for f in cols if (b, f) in got and got[(b, f)]["test"] != "none"]))
        ks = {x["feature"]: x for x in DR.ks_test(tested).collect()}
        psi = {x["feature"]: x["psi"] for x in DR.psi(tested).collect()}
        chi = {x["feature"]: x for x in DR.chi_square_test(tested).collect()}
        alone = {x["feature"]: x for x in DR.column_drift(r, one, cols).collect()}
        for f in cols:
            if (b, f) not in got:
                assert alone[f]["test"] == "none" and alone[f]["n_cur"] == 0
                continue
            x = got[(b, f)]
            assert tuple(alone[f])[1:] == tuple(x)[2:]
            if f == "gone":
                assert x["test"] == "none" and x["n_ref"] == 0
            elif x["test"] == "ks":
                assert x["drift_score"] == pytest.approx(ks[f]["ks_statistic"], abs=5.1e-5)
                assert x["p_value"] == pytest.approx(ks[f]["ks_pvalue"], abs=5.1e-5)
                assert x["psi"] == pytest.approx(psi[f], rel=1e-9)
            else:
                assert f == "cat" and x["p_value"] == pytest.approx(chi[f]["chi2_pvalue"], abs=5.1e-5)
