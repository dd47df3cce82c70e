"""Joins whose sides Spark sizes too low are dealt out by key and never pass through the driver."""

from churnlake.llm import common, simhash


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_variants_and_rows_of_near_duplicates_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def stored(df, name):
        plans[name] = _plan(df)
        return common.stored(df, name)

    monkeypatch.setattr(simhash, "stored", stored)
    rows = [(5, "one two three four five"), (2, "one two three four five"), (7, "six seven eight nine"), (None, None), (9, "")]
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    # at this size Spark expects every side to fit: 64 variants a fingerprint count as one
    assert "Generate explode" in plans["simhash-buckets"] and "BroadcastExchange" not in plans["simhash-buckets"]
    top = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x)
    assert "strategy=merge" in top
    assert sorted((r.doc_id or 0, r.component_id) for r in out.collect()) == [(0, 9), (2, 2), (5, 2), (7, 7), (9, 9)]


def test_pairs_of_a_bucket_are_not_broadcast(spark):
    fps = spark.createDataFrame([(0b1011,), (0b1000,), (7 << 40,)], "fp long")
    found = simhash.links(fps)
    pairs = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x and "(key#" in x]
    assert pairs and all("strategy=merge" in x for x in pairs)
    assert {(r.a, r.b) for r in found.collect()} == {(0b1000, 0b1011)}
