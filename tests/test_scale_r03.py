"""Steps that are written once, so that their plans stay small."""

from pyspark.sql import functions as F

from churnlake.functions.prefix import exact_quantiles
from churnlake.ml.split import stratified_split
from churnlake.operators import quality as Q
from churnlake.operators.diagnostics import score_histogram
from churnlake.operators.metrics import threshold_table
from churnlake.params import FEATURES


def test_quarantine_branches_read_the_judged_rows(spark):
    rows = [(1, 30, 2, 0), (2, 17, 2, 0), (2, 17, 2, 3), (None, 40, 0, 1)]
    df = spark.createDataFrame(rows, "user_id long, age long, total_orders long, orders_last_30_days long")
    df = df.select("*", *[F.lit(1 if f == "avg_rating" else 0).alias(f) for f in FEATURES if f not in df.columns])
    valid, invalid = Q.quarantine_split(df)
    for branch in (valid, invalid, Q.rule_counts(invalid)):
        plan = branch._jdf.queryExecution().optimizedPlan().toString()
        assert "CASE WHEN" not in plan, plan        # the rules are not evaluated again
    assert [r.user_id for r in valid.collect()] == [1]
    assert {r.rule: r.n_rows for r in Q.rule_counts(invalid).collect()} == {
        "age_min": 2, "orders_30_le_total": 2, "no_orders_no_recent": 1}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_shared_steps_read_written_rows(spark):
    df = spark.range(40).select(F.col("id").alias("user_id"), (F.col("id") % 2).alias("churned"), (F.col("id") / 40).alias("p"))
    costly = df.groupBy("user_id", "churned").agg(F.max("p").alias("p"))
    split = stratified_split(costly)
    assert "max(" not in _plan(split)
    assert {(r.churned, r.split): r["count"] for r in split.groupBy("churned", "split").count().collect()} == {
        (c, s): n for c in (0, 1) for s, n in (("train", 12), ("validation", 4), ("test", 4))}
    q = exact_quantiles(costly, "p", [0.5])
    assert "max(" not in _plan(q) and [r.value for r in q.collect()] == [0.4875]
    assert "max(" not in _plan(threshold_table(costly, "churned"))
    h = score_histogram(costly, "churned", bins=2)
    assert "Range (" not in _plan(h) and sum(r["count"] for r in h.collect()) == 40


def test_drift_over_many_value_ranges(spark, monkeypatch):
    """One running count of both sides, whatever the ranges: equal to counting by hand, a null batch included."""
    import numpy as np

    from churnlake.functions.prefix import value_ranges
    from churnlake.operators import drift as DR

    calls = []
    monkeypatch.setattr(DR, "value_ranges", lambda df, c, g: calls.append(g) or value_ranges(df, c, g, rows_per_range=15))
    rng = np.random.default_rng(4)
    ref = [float(x) for x in rng.normal(0, 1, 150).round(1)]
    batches = {1: [float(x) for x in rng.normal(0.4, 1, 70).round(1)], None: [50.0] * 3 + [float(x) for x in rng.normal(0, 2, 40).round(1)], 3: [1.0, 2.0]}
    rc = spark.createDataFrame([(x,) for x in ref], "x double")
    cc = spark.createDataFrame([(b, x) for b, xs in batches.items() for x in xs], "b int, x double")
    got = {r.b: r for r in DR.column_drift(rc, cc, ["x"], batch_cols=["b"]).collect()}
    assert calls == [["feature"]] and set(got) == set(batches) and got[3].test == "none"
    for b in (1, None):
        cur = batches[b]
        at = sorted(set(ref + cur))
        ks = max(abs(np.mean(np.array(ref) <= v) - np.mean(np.array(cur) <= v)) for v in at)
        edges = np.unique(np.percentile(ref + cur, np.linspace(0, 100, 11)))
        e, c = (np.histogram(s, bins=edges)[0] + 1e-10 for s in (ref, cur))
        e, c = e / e.sum(), c / c.sum()
        assert got[b].test == "ks" and abs(got[b].drift_score - ks) < 1e-4
        assert abs(got[b].psi - float(((c - e) * np.log(c / e)).sum())) < 1e-9
