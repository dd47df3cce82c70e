"""Alert rules as stateful streams (K2-K6).

The request log is first reduced to one row per minute or window by a streaming
aggregate (partial aggregates before the shuffle, so a service or minute that holds most
rows is no hot key); only these few rows per service reach the keyed state. The windowed
aggregate emits a window once the watermark has closed it, so the state sees every
service's windows in order, whatever the order of the rows inside the delay.

Rows that come after the watermark has closed their window are dropped, as Structured
Streaming does; ``late_split`` keeps them in a dead-letter table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK = "10 minutes"
#: Relative width of a latency bucket: every value of a bucket is within 1 % of its middle.
GROWTH = 1.02


# ---------------------------------------------------------------- K4: sustained alerts

class SustainedRuns(StatefulProcessor):
    """Runs of consecutive alerting windows of one rule. State: the open run (first window,
    last window, windows). A window that doesn't follow it closes the run, and so does a
    timer at the end of the window that should have come next."""

    def __init__(self, least: int, slide_ms: int, window_ms: int):
        self.least, self.slide, self.window = least, slide_ms, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "first long, last long, n int")

    def _closed(self, key, run) -> pd.DataFrame:
        return pd.DataFrame({"rule": [key], "run_start": pd.to_datetime([run[0]], unit="ms"),
                             "run_end": pd.to_datetime([run[1]], unit="ms"), "n_windows": [run[2]]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows))
        starts = (every.loc[every["alert"], "window_start"].astype("datetime64[ms]").astype("int64")).sort_values()
        run = tuple(self.run.get()) if self.run.exists() else None
        before = run
        for at in starts.tolist():
            if run and at == run[1] + self.slide:
                run = (run[0], at, run[2] + 1)
                continue
            if run and run[2] >= self.least:
                yield self._closed(key[0], run)
            run = (at, at, 1)
        if run != before:
            if before:
                self.handle.deleteTimer(self._due(before))
            self.run.update(run)
            self.handle.registerTimer(self._due(run))

    def _due(self, run) -> int:
        return run[1] + self.slide + self.window

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.run.exists():
            run = tuple(self.run.get())
            if self._due(run) <= expiredTimerInfo.getExpiryTimeInMs():
                self.run.clear()
                if run[2] >= self.least:
                    yield self._closed(key[0], run)

    def close(self) -> None:
        pass


def sustained_runs(windows: DataFrame, min_windows: int = 5, slide_seconds: int = 60, window_seconds: int = 300,
                   rule: str = "rule") -> DataFrame:
    """K4 (stream): runs of at least ``min_windows`` alerting windows in a row, per rule, once
    they have ended: (rule, run_start, run_end, n_windows). ``windows`` is a streaming
    (rule, window_start, alert) frame that emits closed windows."""
    step = SustainedRuns(min_windows, slide_seconds * 1000, window_seconds * 1000)
    return windows.select(rule, "window_start", "alert").groupBy(rule).transformWithStateInPandas(
        step, "rule string, run_start timestamp, run_end timestamp, n_windows int", "append", "EventTime")


# ---------------------------------------------------------------- K3: liveness gaps

class Silences(StatefulProcessor):
    """Silences of one service. State: the stamp of its last request. The next minute with
    requests closes a gap; a timer reports a silence that is still open when the watermark has
    passed the last stamp by the allowed time."""

    def __init__(self, silence_us: int):
        self.silence = silence_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    @staticmethod
    def _row(key, kind, start, end) -> pd.DataFrame:
        return pd.DataFrame({"service": [key], "kind": [kind], "gap_start": pd.to_datetime([start], unit="us"),
                             "gap_end": pd.to_datetime([end], unit="us") if end else pd.to_datetime([None]),
                             "gap_seconds": [(end - start) / 1e6 if end else None]}).astype({"gap_seconds": "float64"})

    def _due(self, last: int) -> int:
        return (last + self.silence) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows)).sort_values("first_us")
        last = before = self.last.get()[0] if self.last.exists() else None
        for first, end in zip(every["first_us"].tolist(), every["last_us"].tolist()):
            if last is not None and first - last > self.silence:
                yield self._row(key[0], "gap", last, first)
            last = end if last is None else max(last, end)
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._due(before))
            self.last.update((last,))
            self.handle.registerTimer(self._due(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            last = self.last.get()[0]
            if self._due(last) <= expiredTimerInfo.getExpiryTimeInMs():
                yield self._row(key[0], "silent", last, None)

    def close(self) -> None:
        pass


def liveness_gap_stream(log: DataFrame, max_silence_seconds: int = 120, watermark: str = WATERMARK,
                        service: str = "service") -> DataFrame:
    """K3 (stream): (service, kind, gap_start, gap_end, gap_seconds). ``gap``: a silence of more
    than ``max_silence_seconds``, when the minute that ended it has closed; ``silent``: one that is
    open, as soon as the watermark has passed it (gap_end is null).

    Requests are first reduced to the first and last stamp of each minute of a service, which
    holds no gap of its own for a limit of a minute or more."""
    if max_silence_seconds < 60:
        raise ValueError("the minute windows hold gaps of under 60 seconds")
    if service not in log.columns:
        log = log.withColumn(service, F.lit("api"))
    minutes = (log.withWatermark("ts", watermark).groupBy(F.col(service).alias("service"), F.window("ts", "1 minute").alias("w"))
               .agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first_us"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last_us")))
    return minutes.select("service", F.window_time("w").alias("at"), "first_us", "last_us").groupBy("service").transformWithStateInPandas(
        Silences(max_silence_seconds * 1_000_000),
        "service string, kind string, gap_start timestamp, gap_end timestamp, gap_seconds double", "append", "EventTime")


# ---------------------------------------------------------------- K2: p95 latency

def latency_bucket(value: Column) -> Column:
    """Number of the logarithmic bucket of a latency: (GROWTH ** (b - 1), GROWTH ** b]; values up to
    a microsecond share the bucket of a microsecond."""
    return F.ceil(F.round(F.log(F.greatest(value, F.lit(1e-6))) / F.log(F.lit(GROWTH)), 9)).cast("int")


def p95_stream(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute", watermark: str = WATERMARK,
               limit: float = 1.0, q: float = 0.95) -> DataFrame:
    """K2 (stream): (window_start, window_end, n_requests, p95_latency, alert) of closed windows.

    The state of a window is a mergeable summary: counts by logarithmic bucket, summed before
    and after the shuffle; its size is bounded by the range of the latencies (about 1,200
    buckets from a microsecond to a day), not by the requests. The bucket of the value of rank
    ceil(q n) is found exactly (rank error 0) and its middle is reported: at most 1 % off that value."""
    at = log.where(F.col("latency").isNotNull()).withWatermark("ts", watermark)
    counts = at.groupBy(F.window("ts", window, slide).alias("w"), latency_bucket(F.col("latency")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("w").agg(F.sum("n").alias("n_requests"), F.array_sort(F.collect_list(F.struct("b", "n"))).alias("buckets"))
    rank = F.ceil(F.lit(q) * F.col("n_requests"))
    # the first bucket whose running count reaches the rank
    hit = F.aggregate("buckets", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("b")),
                      lambda s, x: F.struct((s["seen"] + x["n"]).alias("seen"),
                                            F.coalesce(s["b"], F.when(s["seen"] + x["n"] >= rank, x["b"])).alias("b")))["b"]
    p95 = F.pow(F.lit(GROWTH), hit) * 2 / (1 + GROWTH)
    return per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_requests",
                      p95.alias("p95_latency"), (p95 > limit).alias("alert"))


# ---------------------------------------------------------------- K5 / D5, K6: one write per epoch

def split_sink(source: DataFrame, flag: Callable[[DataFrame, int], Column], path: str, checkpoint: str,
               prepare: Callable[[DataFrame], DataFrame] | None = None, name: str = "valid") -> Callable[[], StreamingQuery]:
    """A two-way sink: every micro-batch is computed once and written once, under
    ``path/epoch=<n>/<name>=<true|false>``. An epoch's folder is overwritten, so a batch that is
    replayed after a failure leaves one copy. Returns a function that starts the query."""
    def each(batch: DataFrame, epoch: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.withColumn(name, flag(rows, epoch)).write.mode("overwrite").partitionBy(name).parquet(f"{path}/epoch={epoch}")

    return lambda: source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_split(source: DataFrame, path: str, checkpoint: str, ts: str = "ts", delay_seconds: int = 600) -> Callable[[], StreamingQuery]:
    """K6: rows behind the watermark (the greatest event time of earlier batches less the delay) go
    to the dead-letter folder ``late=true``, the others to ``late=false``; nothing is lost.

    The watermark of an epoch is read back from the epochs written before it, so a replayed batch
    is split in the same way. A row at the watermark is late, as the engine takes it; a row without
    a stamp is not."""
    spark = source.sparkSession

    def flag(rows: DataFrame, epoch: int) -> Column:
        seen = None
        if epoch:
            done = read_split(spark, path, rows.schema, "late").where(F.col("epoch") < epoch)
            seen = done.agg(F.max(ts).alias("m")).first()["m"]
        if seen is None:
            return F.lit(False)
        return F.coalesce(F.col(ts) <= F.lit(seen - dt.timedelta(seconds=delay_seconds)).cast(rows.schema[ts].dataType), F.lit(False))

    return split_sink(source, flag, path, checkpoint, name="late")


def read_split(spark: SparkSession, path: str, schema: StructType | str, name: str) -> DataFrame:
    """The rows of a two-way sink with their epoch and flag."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    both = StructType([*fields.fields, StructField("epoch", LongType()), StructField(name, BooleanType())])
    return spark.read.schema(both).option("basePath", path).parquet(f"{path}/epoch=*")


@contextmanager
def stateful(spark: SparkSession, partitions: int | None = 8) -> Iterator[None]:
    """Settings of a keyed stream while it is started: the RocksDB store (on the executors' disks,
    checkpointed in the shared folder), which timers need, and the number of state partitions,
    fixed by the first start of a query. Alert rules have a row per minute and service, so few do;
    None keeps the session's number of shuffle partitions."""
    keys = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        keys["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


Start = Callable[[], StreamingQuery]


def replay(arrivals: Sequence[DataFrame], folder: str, build: Callable[[DataFrame], tuple[StructType, Start]]) -> tuple[list, StructType]:
    """Drives a streaming job over frames that arrive one after another: each is appended to the
    source folder, and the job is started again from its checkpoint for what is new. ``build`` gives
    the schema of the result and the start. Returns the progress of every micro-batch and the schema."""
    spark, progress, schema = arrivals[0].sparkSession, [], None
    for frame in arrivals:
        frame.write.mode("append").parquet(folder)
        schema, start = build(spark.readStream.schema(frame.schema).parquet(folder))
        query = start()
        query.awaitTermination()
        progress += query.recentProgress
    return progress, schema


def append_sink(plan: DataFrame, path: str, checkpoint: str) -> tuple[StructType, Start]:
    """Closed results appended as Parquet files."""
    return plan.schema, lambda: (plan.writeStream.outputMode("append").format("parquet").option("path", path)
                                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
