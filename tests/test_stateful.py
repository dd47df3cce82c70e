"""Stateful streams against their batch forms, with restarts from the checkpoint."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from churnlake.session import shared_path
from churnlake.streaming import alerts as K
from churnlake.streaming import state as ST

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
LOG = "request_id long, ts timestamp, failed boolean, latency double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def parts_of(spark, chunks):
    return [spark.createDataFrame(c, LOG) for c in chunks]


def replayed(spark, name, chunks, build):
    base = shared_path(spark, name)
    with ST.stateful(spark, 2):
        progress, schema = ST.replay(parts_of(spark, chunks), f"{base}/source",
                                     lambda s: ST.append_sink(build(s), f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(schema).parquet(f"{base}/out"), progress


def test_sustained_runs_equal_the_batch_over_restarts(spark):
    # errors in minutes 0-6 and 20-21 and 40; requests every 30 s, in three starts of the query
    bad = set(range(0, 7)) | {20, 21, 40}
    rows = [(i, at(30 * i), (i // 2) in bad, 1.0) for i in range(2 * 70)]
    chunks = [rows[:9], rows[9:80], rows[80:]]
    got, progress = replayed(spark, "t_k4", chunks, lambda s: ST.sustained_runs(
        K.window_error_rate(s.withWatermark("ts", "10 minutes"), limit=0.0).withColumn("rule", F.lit("r"))))
    log = spark.createDataFrame(rows, LOG)
    batch = K.sustained_alert(K.window_error_rate(log, limit=0.0))
    closed = max(r[1] for r in rows) - dt.timedelta(minutes=10)
    want = sorted(tuple(r) for r in batch.collect() if r["run_end"] + dt.timedelta(minutes=6) <= closed)
    assert len(want) == 3 and sorted(tuple(r)[1:] for r in got.collect()) == want
    assert len(progress) >= 3 and {r["rule"] for r in got.collect()} == {"r"}


def test_runs_of_several_rules_are_apart(spark):
    rows = [(i, at(60 * i), i % 2 == 0, 2.0 if 3 <= i < 30 else 0.5) for i in range(60)]

    def build(s):
        w = K.window_error_rate(s.withWatermark("ts", "10 minutes"), limit=0.0)
        return ST.sustained_runs(w.select(F.explode(F.array(
            F.struct(F.lit("any").alias("rule"), F.col("alert").alias("alert")),
            F.struct(F.lit("many").alias("rule"), (F.col("n_errors") > 2).alias("alert")))).alias("x"), "window_start")
            .select("x.rule", "x.alert", "window_start"), min_windows=1)

    got, _ = replayed(spark, "t_rules", [rows], build)
    by = {}
    for r in got.collect():
        by.setdefault(r["rule"], []).append(r["n_windows"])
    assert set(by) == {"many"} and all(n == 1 for n in by["many"])  # 'any' is one run that has not ended


def test_liveness_gaps_and_open_silences(spark):
    stamps = [0, 10, 100, 400, 410, 2000, 2001, 2200, 2260]
    rows = [(i, at(s), False, 1.0) for i, s in enumerate(stamps)]
    later = [(100 + i, at(s), False, 1.0) for i, s in enumerate([4000, 4100])]
    got, _ = replayed(spark, "t_k3", [rows[:5], rows[5:], later], ST.liveness_gap_stream)
    rows_out = got.collect()
    gaps = sorted((r["gap_start"], r["gap_end"], r["gap_seconds"]) for r in rows_out if r["kind"] == "gap")
    batch = K.liveness_gaps(spark.createDataFrame(rows + later, LOG)).collect()
    closed = at(4100 - 600)
    assert gaps == sorted((r["gap_start"], r["gap_end"], r["gap_seconds"]) for r in batch if r["gap_end"] < closed)
    # 2260 s: the watermark passed two minutes of silence while nothing newer had closed
    assert at(2260) in [r["gap_start"] for r in rows_out if r["kind"] == "silent"]
    assert all(r["gap_end"] is None for r in rows_out if r["kind"] == "silent")


def test_p95_is_within_its_bound(spark):
    import math
    import random
    rng = random.Random(4)
    rows = [(i, at(i), False, None if i % 50 == 0 else (0.0 if i % 77 == 0 else rng.lognormvariate(0, 2))) for i in range(3000)]
    got, _ = replayed(spark, "t_k2", [rows[:1000], rows[1000:]], ST.p95_stream)
    out = {r["window_start"]: r for r in got.collect()}
    assert len(out) > 30
    for start, r in out.items():
        values = sorted(x[3] for x in rows if x[3] is not None and start <= x[1] < start + dt.timedelta(minutes=5))
        assert r["n_requests"] == len(values)
        exact = values[math.ceil(0.95 * len(values)) - 1]
        assert abs(r["p95_latency"] - max(exact, 1e-6)) <= 0.0101 * max(exact, 1e-6)
        assert r["alert"] == (r["p95_latency"] > 1.0)


def test_late_rows_are_kept_apart_and_agree_with_the_engine(spark):
    first = [(i, at(60 * i), False, 1.0) for i in range(60)]
    second = [(100 + i, at(60 * i), False, 1.0) for i in range(40, 80)] + [(200, None, False, 1.0)]
    third = [(300 + i, at(60 * i), False, 1.0) for i in range(0, 100, 3)]
    chunks = [first, second, third]
    base = shared_path(spark, "t_k6")
    ST.replay(parts_of(spark, chunks), f"{base}/source",
              lambda s: (s.schema, ST.late_split(s, f"{base}/out", f"{base}/checkpoint")))
    rows = ST.read_split(spark, f"{base}/out", LOG, "late")
    per = {r["epoch"]: (r["late"], r["kept"]) for r in rows.groupBy("epoch").agg(
        F.count_if("late").alias("late"), F.count_if(~F.col("late")).alias("kept")).collect()}
    assert [sum(per[e]) for e in range(3)] == [len(c) for c in chunks]  # dropped + kept = read
    # what Structured Streaming itself drops behind its watermark, per batch
    _, progress = replayed(spark, "t_k6_own", [[r for r in c if r[1]] for c in chunks],
                           lambda s: s.withWatermark("ts", "10 minutes").dropDuplicates(["request_id", "ts"]))
    dropped = [sum(o.numRowsDroppedByWatermark for o in p.stateOperators) for p in progress if p.numInputRows]
    assert dropped == [per[e][0] for e in range(3)] and sum(dropped) > 10


def test_a_replayed_epoch_leaves_one_copy(spark):
    base = shared_path(spark, "t_split")
    rows = spark.createDataFrame([(i, float(i)) for i in range(50)], "user_id long, x double")
    rows.write.parquet(f"{base}/source")
    source = spark.readStream.schema(rows.schema).parquet(f"{base}/source")
    for _ in range(2):  # a lost checkpoint: epoch 0 comes again
        ST.split_sink(source, lambda r, _: F.col("x") < 20, f"{base}/out", tempfile.mkdtemp(prefix="split-checkpoint-"))().awaitTermination()
    out = ST.read_split(spark, f"{base}/out", rows.schema, "valid")
    assert out.count() == 50 and out.where("valid").count() == 20
    assert {r["valid"] for r in out.where("x >= 20").collect()} == {False}


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with ST.stateful(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
