"""Feature table (I1-I6): typed publication, latest-value reads,
incremental upserts and point-in-time joins.

"Newest row per key" is always an aggregate (``max_by`` over the
timestamp), never a window over a whole key, so a heavy key stays a
partial + final aggregate.  The point-in-time join cuts each key's history
into time buckets and stitches bucket borders with one small window (the
same plan shape as the order-gap features).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType)

from churnlake.functions.columns import ts_lit
from churnlake.functions.prefix import prefix_sums


def normalize_types(df: DataFrame, keep: Sequence[str] = ("user_id", "event_timestamp", "churned")) -> DataFrame:
    """Bool -> bigint (NULL -> 0), integers -> bigint (NULL -> 0),
    floats -> double (NULL -> 0.0); other types are an error; ``keep``
    columns pass untouched."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if f.name in keep:
            cols.append(c)
        elif isinstance(t, BooleanType):
            cols.append(F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias(f.name))
        elif isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            cols.append(F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias(f.name))
        elif isinstance(t, (FloatType, DoubleType, DecimalType)):
            cols.append(F.coalesce(c.cast("double"), F.lit(0.0)).alias(f.name))
        else:
            raise TypeError(f"column {f.name} has unsupported type {t.simpleString()}")
    return df.select(*cols)


def publish_features(df: DataFrame, event_timestamp: dt.datetime, key: str = "user_id",
                     labels: Sequence[str] = ("churned",), order_by: str | None = None) -> DataFrame:
    """Without a key column the rows are numbered from 1 by the unique
    column ``order_by`` (prefix counts, no single-task window); key coerced to bigint (unconvertible -> 0), labels removed,
    ``event_timestamp`` stamped (a job parameter) and ``event_date`` added
    as the partition column of the written table."""
    out = df.drop(*[c for c in labels if c in df.columns])
    if key not in out.columns:
        if order_by is None:
            raise ValueError(f"no {key} column: order_by must name a unique column to number the rows by")
        out = (prefix_sums(out.withColumn("__one", F.lit(1).cast("bigint")), order_by, ["__one"])
               .withColumnRenamed("cum___one", key).drop("__one"))
    out = out.withColumn(key, F.coalesce(F.col(key).try_cast("bigint"), F.lit(0).cast("bigint")))
    out = normalize_types(out, keep=(key,))
    return (out.withColumn("event_timestamp", ts_lit(event_timestamp))
               .withColumn("event_date", F.to_date("event_timestamp")))


def latest_features(table: DataFrame, as_of: dt.datetime, ttl_days: int = 3650,
                    features: Sequence[str] | None = None, ids: DataFrame | None = None,
                    key: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Newest row per key with as_of - ttl <= ts <= as_of; optionally
    only the requested ids (semi join) and chosen columns."""
    features = list(features or [c for c in table.columns if c not in (key, ts, "event_date")])
    t = table.where((F.col(ts) <= ts_lit(as_of)) & (F.col(ts) >= ts_lit(as_of - dt.timedelta(days=ttl_days))))
    if ids is not None:
        t = t.join(ids.select(key).distinct(), key, "left_semi")
    latest = t.groupBy(key).agg(F.max_by(F.struct(ts, *features), F.col(ts)).alias("r"))
    return latest.select(key, *[F.col(f"r.{c}").alias(c) for c in [ts, *features]])


def merge_incremental(existing: DataFrame, batch: DataFrame, key: str = "user_id",
                      ts: str = "event_timestamp") -> DataFrame:
    """I4: upsert -- the newest row per key over existing + new rows (on a
    timestamp tie the new batch wins)."""
    cols = [c for c in existing.columns]
    u = (existing.withColumn("__src", F.lit(0))
                 .unionByName(batch.select(*cols).withColumn("__src", F.lit(1))))
    others = [c for c in cols if c not in (key,)]
    latest = u.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(ts, "__src")).alias("r"))
    return latest.select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def point_in_time_join(events: DataFrame, table: DataFrame, event_id: str, ttl_days: int = 3650,
                       key: str = "user_id", event_ts: str = "label_ts", ts: str = "event_timestamp",
                       features: Sequence[str] | None = None, bucket_days: int = 30) -> DataFrame:
    """For each event row, the newest feature row of the same key with
    ts <= event time and within the TTL (a feature row stamped at the same
    instant counts).  Linear: one union, a window inside (key, time bucket)
    and a window over per-bucket last rows -- no theta join.  ``event_id``
    is a unique key of ``events`` (results are joined back on it; a
    generated id would not be stable when a task is recomputed)."""
    features = list(features or [c for c in table.columns if c not in (key, ts, "event_date")])
    ev = events.withColumn("__eid", F.col(event_id))
    feat_struct = F.struct(F.col(ts).alias("fts"), *[F.col(c) for c in features])
    null_struct = F.lit(None).cast(table.select(feat_struct.alias("s")).schema["s"].dataType)
    width = float(bucket_days * 86400)
    f_rows = table.select(key, F.col(ts).alias("__t"), F.lit(0).alias("__kind"), feat_struct.alias("__f"),
                          F.lit(None).cast(ev.schema["__eid"].dataType).alias("__eid"))
    e_rows = ev.select(key, F.col(event_ts).alias("__t"), F.lit(1).alias("__kind"), null_struct.alias("__f"), "__eid")
    u = f_rows.unionByName(e_rows).withColumn("__b", F.floor(F.unix_seconds("__t") / width))
    w_in = (Window.partitionBy(key, "__b").orderBy("__t", "__kind")
                  .rowsBetween(Window.unboundedPreceding, 0))
    inner = u.withColumn("__last", F.last("__f", ignorenulls=True).over(w_in))
    per_bucket = (u.where(F.col("__kind") == 0).groupBy(key, "__b")
                   .agg(F.max_by("__f", F.col("__t")).alias("__bl")))
    w_b = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # buckets without feature rows need the carry too: build it on the
    # distinct (key, bucket) pairs of both kinds
    kb = u.select(key, "__b").distinct()
    carry_all = (kb.join(per_bucket, [key, "__b"], "left")
                   .select(key, "__b", F.last("__bl", ignorenulls=True).over(w_b).alias("__carry")))
    res = (inner.where(F.col("__kind") == 1)
                .join(carry_all, [key, "__b"], "left")
                .withColumn("__m", F.coalesce("__last", "__carry")))
    ok = F.col("__m.fts") >= F.col("__t") - F.expr(f"INTERVAL {int(ttl_days)} DAYS")
    res = res.withColumn("__m", F.when(ok, F.col("__m")))
    out = res.select("__eid", F.col("__m.fts").alias("feature_ts"), *[F.col(f"__m.{c}").alias(c) for c in features])
    return ev.join(out, "__eid", "left").drop("__eid")


def retrieval_null_check(retrieved: DataFrame, features: Sequence[str]) -> DataFrame:
    """Requested features that came back NULL, with their counts."""
    counts = retrieved.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features])
    long = counts.unpivot([], list(features), "feature", "n_null")
    return long.where(F.col("n_null") > 0)
