"""Service alerts over a request log (K1-K6): failed = error event,
latency = value.  The rules are windowed aggregates, so the same column
expressions serve a batch DataFrame and a streaming one (``withWatermark``
+ ``window``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake.functions.prefix import exact_quantiles


def error_rate_columns():
    return [F.count(F.lit(1)).alias("n_requests"), F.count_if(F.col("failed")).alias("n_errors")]


def window_error_rate(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                      floor_requests: int = 300, limit: float = 0.05) -> DataFrame:
    """K1: sliding windows, error rate and the alert flag (rate > limit).
    The per-second error rate over the window with the request rate
    clamped at 1/s is (e/300) / max(n/300, 1) = e / max(n, 300)."""
    agg = log.groupBy(F.window("ts", window, slide).alias("w")).agg(*error_rate_columns())
    rate = F.col("n_errors") / F.greatest(F.col("n_requests"), F.lit(floor_requests))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "n_requests", "n_errors", rate.alias("error_rate"), (rate > limit).alias("alert"))


def window_p95_latency(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                       limit: float = 1.0, q: float = 0.95) -> DataFrame:
    """K2 (batch): exact p95 latency per sliding window from per-value
    counts (no window's values buffered in one task); alert when > limit."""
    w = log.select(F.window("ts", window, slide).alias("w"), "latency")
    w = w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latency")
    p = exact_quantiles(w, "latency", [q], ["window_start", "window_end"])
    return p.select("window_start", "window_end", F.col("value").alias("p95_latency"),
                    (F.col("value") > limit).alias("alert"))


def stream_p95_latency(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                       watermark: str = "10 minutes", limit: float = 1.0) -> DataFrame:
    """K2 (stream): bounded state per window via ``percentile_approx``."""
    agg = (log.withWatermark("ts", watermark).groupBy(F.window("ts", window, slide).alias("w"))
              .agg(F.percentile_approx("latency", 0.95, 10000).alias("p95_latency")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "p95_latency", (F.col("p95_latency") > limit).alias("alert"))


def liveness_gaps(log: DataFrame, max_silence_seconds: int = 120, bucket_seconds: int = 3600) -> DataFrame:
    """K3 (batch): silences longer than ``max_silence_seconds`` between
    consecutive requests.  Time is cut into buckets; ``lag`` runs inside a
    bucket and one small window over the bucket first/last stamps adds
    the gaps across bucket borders (no single-partition window over all
    rows)."""
    t = log.select("ts").where(F.col("ts").isNotNull()).distinct() \
        .withColumn("__b", F.floor(F.unix_seconds("ts") / float(bucket_seconds)))
    w_in = Window.partitionBy("__b").orderBy("ts")
    inner = t.select(F.lag("ts").over(w_in).alias("gap_start"), F.col("ts").alias("gap_end"))
    per_b = t.groupBy("__b").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    w_b = Window.orderBy("__b")          # one row per bucket: bounded by the time span
    border = per_b.select(F.lag("last").over(w_b).alias("gap_start"), F.col("first").alias("gap_end"))
    gaps = inner.unionByName(border).where(F.col("gap_start").isNotNull())
    secs = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return gaps.withColumn("gap_seconds", secs / 1e6).where(F.col("gap_seconds") > max_silence_seconds)


def stream_liveness(log: DataFrame, max_silence: str = "2 minutes", watermark: str = "10 minutes",
                    service: str = "service") -> DataFrame:
    """K3 (stream): activity sessions per service with a gap of
    ``max_silence``; the space between consecutive sessions is a liveness
    gap.  (Streaming session windows need a key; the request log has one
    service unless a ``service`` column says otherwise.)"""
    if service not in log.columns:
        log = log.withColumn(service, F.lit("api"))
    return (log.withWatermark("ts", watermark).groupBy(service, F.session_window("ts", max_silence).alias("s"))
               .agg(F.count(F.lit(1)).alias("n_requests"))
               .select(service, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                       "n_requests"))


def sustained_alert(windows: DataFrame, min_windows: int = 5, slide_seconds: int = 60,
                    ts: str = "window_start", flag: str = "alert") -> DataFrame:
    """K4 (batch): runs of at least ``min_windows`` consecutive alerting
    windows (gaps and islands: island key = window index - its rank among
    alerting windows; the rank is a range-partitioned prefix count, not a
    single-partition ``row_number``)."""
    from churnlake.functions.prefix import prefix_sums
    a = (windows.where(F.col(flag))
                .select(ts, (F.unix_seconds(ts) / slide_seconds).cast("bigint").alias("__i"), F.lit(1).alias("__one")))
    isl = prefix_sums(a, "__i", ["__one"]).withColumn("__k", F.col("__i") - F.col("cum___one"))
    runs = isl.groupBy("__k").agg(F.min(ts).alias("run_start"), F.max(ts).alias("run_end"),
                                  F.count(F.lit(1)).alias("n_windows"))
    return runs.where(F.col("n_windows") >= min_windows).drop("__k")


def late_rows(log: DataFrame, delay_seconds: int, order_col: str = "request_id",
              rows_per_range: int = 500_000) -> DataFrame:
    """K6 (batch replay): rows whose event time is behind the watermark
    (max event time seen so far in arrival order minus the delay).  The
    running max comes from range-partitioned arrival order: per range
    maxima, a small window for the max of earlier ranges, and a window per
    range."""
    from churnlake.functions.stats import one_row
    n_ranges = max(1, -(-one_row(log.agg(F.count(F.lit(1)).alias("n")))["n"] // rows_per_range))
    fracs = [i / n_ranges for i in range(1, n_ranges)]
    b = one_row(log.select(F.percentile_approx(order_col, fracs, max(10000, 20 * n_ranges)).alias("b")))["b"] if fracs else []
    r = log.withColumn("__r", F.size(F.filter(F.array(*[F.lit(x) for x in b]), lambda x: x < F.col(order_col)))
                       if b else F.lit(0))
    per = r.groupBy("__r").agg(F.max("ts").alias("__mx"))
    prev = per.select("__r", F.max("__mx").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
                      .alias("__prev"))
    w = Window.partitionBy("__r").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    x = r.join(prev, "__r").withColumn("__seen", F.greatest(F.max("ts").over(w), F.col("__prev")))
    wm = F.col("__seen") - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
    return x.withColumn("late", F.coalesce(F.col("ts") < wm, F.lit(False))).drop("__r", "__prev", "__seen")


def run_stream(spark: SparkSession, source: DataFrame, build: Callable[[DataFrame], DataFrame], name: str,
               checkpoint: str, mode: str = "append") -> tuple[DataFrame, StreamingQuery]:
    """Drive a streaming plan to completion on the available input and
    return its result and the query (for progress metrics). Append mode
    writes Parquet files beside the checkpoint, so the result never sits on
    the driver; complete mode (small parity runs) uses the memory sink."""
    plan = build(source)
    w = plan.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    if mode == "append":
        out = f"{checkpoint}-output"
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.format("memory").start()
    q.processAllAvailable()
    q.stop()
    return (spark.read.schema(plan.schema).parquet(out) if mode == "append" else spark.table(name)), q


def stream_score_batches(features_stream: DataFrame, score: Callable[[DataFrame], DataFrame],
                         split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], scored_path: str,
                         quarantine_path: str, checkpoint: str) -> StreamingQuery:
    """K5: score an incoming feature stream; each micro-batch is split into
    valid rows (scored, under ``scored_path``) and quarantined rows with
    reasons (under ``quarantine_path``), in a folder per epoch."""
    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        valid, invalid = split(batch)
        # one folder per epoch, overwritten: a replayed batch leaves no second copy
        score(valid).write.mode("overwrite").parquet(f"{scored_path}/epoch={epoch}")
        invalid.write.mode("overwrite").parquet(f"{quarantine_path}/epoch={epoch}")
        batch.unpersist()
    return (features_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start())
