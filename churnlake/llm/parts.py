"""Values that are known once per distinct part of a text (a pre-token, a chunk),
summed per document.

The parts of all texts are counted once; an operator computes its values on the
distinct parts; the documents then sum them. The most frequent short parts go to the
tasks as a dictionary of at most HOT entries, so no part that is left for the join
stands in more than one HOT-th of the occurrences, and no key of that join is hot
unless it is longer than HOT_BYTES (then skew-join splitting deals its rows out)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, stored, texts_of, utf8

#: Entries of the broadcast dictionary, and the longest part in it (bytes): 32 MB of text at most.
HOT, HOT_BYTES = 1 << 17, 256
#: Distinct parts that a task counts before it hands its counts on.
FLUSH = 1_000_000
#: Bytes of text between two output batches.
OUT_BYTES = 1 << 21


def part_counts(docs: DataFrame, split: Callable[[], Callable[[str], list[str]]]) -> DataFrame:
    """(part string, n long): how often each part stands in the texts of ``docs``.

    ``split()`` is called once in each task and gives the function from a text to its
    parts. Null and empty texts have no parts; repeated rows count each time."""
    def run(batches):
        parts_of, seen = split(), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["part", "n"])

        for b in batches:
            for text in b.column(0):
                t = text.as_py()
                if t:
                    seen.update(parts_of(t))
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(run, "part string, n long")
    return counted.groupBy("part").agg(F.sum("n").alias("n"))


def hot_parts(lexicon: DataFrame, values: list[str]) -> dict[str, tuple]:
    """The most frequent parts of at most HOT_BYTES bytes with their ``values``: a
    threshold on n, taken from a histogram of a few hundred steps, leaves HOT of them at most."""
    step = F.floor(F.log2("n") * 8).cast("int")
    short = lexicon.filter(F.octet_length("part") <= HOT_BYTES).withColumn("step", step)
    least, room = None, HOT
    for r in sorted(short.groupBy("step").count().collect(), reverse=True):
        if r["count"] > room:
            break
        room -= r["count"]
        least = r["step"]
    if least is None:
        return {}
    rows = short.filter(F.col("step") >= least).select("part", *values).collect()
    return {r["part"]: tuple(r)[1:] for r in rows}


def document_parts(docs: DataFrame, split, hot: dict[str, tuple], name: str) -> DataFrame:
    """One stored row per row of ``docs``: row (a number given when it is written), doc_id,
    n_bytes, ``total`` (the first dictionary value summed over the hot parts) and ``rest``, the
    other parts with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        parts_of, known = split(), shared.value
        for b in batches:
            _, offs = utf8(b.column(1))
            for i, j in slabs(offs, OUT_BYTES):
                part = b.slice(i, j - i)
                totals, rest, times, ends = [], [], [], [0]
                for t in part.column(1).to_pylist():
                    total = 0
                    for p, c in Counter(parts_of(t) if t else ()).items():
                        v = known.get(p)
                        if v is None:
                            rest.append(p)
                            times.append(c)
                        else:
                            total += v[0] * c
                    totals.append(total)
                    ends.append(len(rest))
                left = pa.StructArray.from_arrays([pa.array(rest, pa.string()), pa.array(times, pa.int32())], ["part", "k"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(offs[i + 1:j + 1] - offs[i:j]), pa.array(totals, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left)], names=["doc_id", "n_bytes", "total", "rest"])

    made = texts_of(docs).mapInArrow(run, "doc_id long, n_bytes long, total long, rest array<struct<part: string, k: int>>")
    return stored(made.withColumn("row", F.monotonically_increasing_id()), name)


def document_sums(rows: DataFrame, lexicon: DataFrame, value: str) -> DataFrame:
    """(doc_id, n_bytes, ``value``) for each row of ``document_parts``: its total, and the
    ``value`` of each of its other parts from ``lexicon`` times its frequency."""
    rest = (rows.select("row", F.explode("rest").alias("r")).select("row", F.col("r.part").alias("part"), F.col("r.k").alias("k"))
            .join(lexicon.select("part", value), "part").select("row", (F.col(value) * F.col("k")).alias(value)))
    sums = rest.groupBy("row").agg(F.sum(value).alias(value))
    return rows.select("row", "doc_id", "n_bytes", "total").join(sums, "row", "left").select(
        "doc_id", "n_bytes", (F.col("total") + F.coalesce(value, F.lit(0))).alias(value))
