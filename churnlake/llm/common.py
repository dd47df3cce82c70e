"""Helpers shared by the text operators: storage that survives lost executors,
row keys, and numpy views of Arrow string columns (word spans, rolling hashes)."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step takes at a time (a longer text is a step of its own).
SLAB_BYTES = 1 << 20


# ---------------------------------------------------------------- storage

def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``). A local
    session without the setting, as in tests, gets a folder of its own; on a
    cluster the setting is required."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="llm-checkpoints-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage; Spark's cleaner may drop the files once unused."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` for a join by shuffle, whatever size Spark expects: it sizes rows after an explode, or
    read from packed files, by the bytes before, and would send them all through the driver."""
    return df.hint("merge")


# ---------------------------------------------------------------- worker memory

_KEPT = []


def kept(maxsize: int):
    """``lru_cache`` for what an operator's tasks share in a worker (automata, tries, memos)."""
    def wrap(make):
        cached = lru_cache(maxsize=maxsize)(make)
        _KEPT.append(cached)
        return cached
    return wrap


def make_room(*using) -> None:
    """Drops what other operators keep in this worker: Spark reuses its workers, so those of an
    earlier stage would hold their tables for as long as later stages run. ``using``: the
    kept functions of the operator that starts."""
    old = [k for k in _KEPT if k not in using and k.cache_info().currsize]
    for k in old:
        k.cache_clear()
    if old:
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)


# ---------------------------------------------------------------- rows

def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): extra columns are left out, a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text). (doc_id, text_key) names a row; rows that repeat
    both are the same to every operator here and get the same result."""
    return texts_of(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.crc32(col.cast("string")) % n


def sample_by_hash(df: DataFrame, n: int, group: str, counts: dict, salt: int = 7) -> DataFrame:
    """At most ``n`` rows of each group value in ``counts``, those with the smallest
    hash: a hash filter first leaves about 4n rows of each, so no task ranks a whole group."""
    from pyspark.sql import Window as W
    h = F.xxhash64(F.lit(salt), "doc_id", "text_key")
    top = 1 << 30
    bound = F.lit(0)
    for value, count in counts.items():
        bound = F.when(F.col(group) == F.lit(value), F.lit(min(top, int(top * min(1.0, (4 * n + 64) / max(count, 1)))))).otherwise(bound)
    few = df.withColumn("sample_hash", h).filter(F.pmod("sample_hash", F.lit(top)) < bound)
    rank = F.row_number().over(W.partitionBy(group).orderBy("sample_hash", "doc_id"))
    return few.withColumn("sample_rank", rank).filter(F.col("sample_rank") <= n).drop("sample_hash", "sample_rank")


# ---------------------------------------------------------------- Arrow and numpy

def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column without nulls; no copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf, offsets


def slabs(offsets: np.ndarray, limit: int = SLAB_BYTES):
    """Row ranges of about ``limit`` bytes; every row is in exactly one."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


#: The six white-space bytes x20, x09-x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII that is neither letter nor digit.
NON_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

MULT = 0x9E3779B97F4A7C15
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {"n": 0, "up": None, "down": None}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd multiplier and of its inverse modulo 2**64."""
    if _POWERS["n"] < n + 1:
        m = max(n + 1, SLAB_BYTES + 4096)
        up, down = np.ones(m + 1, np.uint64), np.ones(m + 1, np.uint64)
        np.multiply.accumulate(np.full(m, MULT, np.uint64), out=up[1:])
        np.multiply.accumulate(np.full(m, pow(MULT, -1, 1 << 64), np.uint64), out=down[1:])
        _POWERS.update(n=m, up=up, down=down)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: P[i] = sum of byte value j times MULT**j for j < i, modulo 2**64."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), the same wherever they stand."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
    """(start, end, first): byte spans of the words, in order, and for each row the
    index of its first word (one more entry at the end). ``offsets`` start at 0;
    words never cross rows."""
    inside = ~separators[buf]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    at = offsets[:-1][full]
    starts[at] = inside[at]
    at = offsets[1:][full] - 1
    ends[at] = inside[at]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends) + 1, np.searchsorted(s, offsets)


def word_hashes(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
    """(hash, first): 64-bit hashes of the words of lower-cased (A-Z) text."""
    low = LOWER[buf]
    s, e, first = word_spans(low, offsets, separators)
    return mix64(span_hash(prefix_hash(low), s, e) + (e - s).astype(np.uint64)), first
