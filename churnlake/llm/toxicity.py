"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams
and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_ALNUM, cut, crc_mod, keyed, mix64, sample_by_hash, slabs, texts_of, utf8, word_hashes

#: Hashed feature space, and the bound of the labelled sample per label value.
BITS, SAMPLE_ROWS = 20, 4000


def features(hashes: np.ndarray, first: np.ndarray, bits: int = BITS):
    """(feature, row): words, word pairs and pairs with one word between, hashed to
    ``bits`` bits. Pairs never cross rows."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out, rows = [hashes], [row]
    for gap, mark in ((1, 0x5DEECE66D), (2, 0x2545F4914F6CDD1D)):
        if len(hashes) > gap:
            same = row[gap:] == row[:-gap]
            out.append(mix64(hashes[:-gap] * np.uint64(3) + mix64(hashes[gap:] + np.uint64(mark)))[same])
            rows.append(row[gap:][same])
    return (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(rows)


def ftrl(examples: list[np.ndarray], labels: list[int], bits: int = BITS, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 4.0, l2: float = 0.01, epochs: int = 10) -> tuple[np.ndarray, np.ndarray, float]:
    """(index, weight, bias) by FTRL-proximal over examples of distinct 0/1 features,
    in the given order. Each coordinate has its own rate alpha / (beta + sqrt(sum of
    squared gradients)); L1 keeps weights at exactly 0 until |z| passes ``l1``, so
    only the nonzero ones are returned. The last coordinate is the bias (no L1)."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = l1

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * penalty) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(zi) <= penalty] = 0.0
        w[-1] = -zi[-1] / ((beta + np.sqrt(n[i[-1]])) / alpha)
        return w

    for _ in range(epochs):
        for x, y in zip(examples, labels):
            i = np.append(x, size)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, float(w.sum()))))) - y
            old = n[i]
            s = (np.sqrt(old + g * g) - np.sqrt(old)) / alpha
            z[i] += g - s * w
            n[i] = old + g * g
    used = np.flatnonzero(np.abs(z[:size]) > penalty)
    w = weights(np.append(used, size))
    return used, w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """Weights from rows of ``docs`` whose crc32(doc_id) mod 5 is not 0 and whose id
    has a ``toxic`` of 0 or 1 in ``labels`` (repeated labels: the largest): at most
    ``sample_rows`` per label value, those with the smallest hash. The bias is moved
    back to the share of toxic rows among all labelled ones. None without both values."""
    known = (labels.filter("doc_id is not null and toxic in (0, 1)").filter(crc_mod(F.col("doc_id"), 5) != 0)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("text_key", F.lit(0)))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    few = cut(sample_by_hash(known, sample_rows, "toxic", counts).select("doc_id", "toxic"))  # at most 2 * sample_rows rows
    rows = (keyed(docs.filter("doc_id is not null")).join(F.broadcast(few), "doc_id")
            .dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "toxic", "text"))

    def extract(batches):
        for b in batches:
            buf, offs = utf8(b.column(3))
            got = []
            for i, j in slabs(offs):
                h, first = word_hashes(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], NON_ALNUM)
                f, row = features(h, first)
                key = np.unique(row * (1 << BITS) + f)
                at = np.searchsorted(key, np.arange(j - i + 1) * (1 << BITS))
                got += [pa.scalar((key[at[k]:at[k + 1]] & ((1 << BITS) - 1)).astype("<i4").tobytes()) for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(got, pa.binary())], ["doc_id", "text_key", "toxic", "x"])

    sample = rows.mapInArrow(extract, "doc_id long, text_key long, toxic int, x binary").collect()
    sample.sort(key=lambda r: (r["text_key"], r["doc_id"]))  # an order that mixes labels and never changes
    if len({r["toxic"] for r in sample}) < 2:
        return None
    index, weight, bias = ftrl([np.frombuffer(r["x"], "<i4").astype(np.int64) for r in sample], [r["toxic"] for r in sample])
    taken = sum(r["toxic"] for r in sample) / len(sample)
    share = counts[1] / (counts[0] + counts[1])
    return index, weight, bias + float(np.log(share / (1 - share)) - np.log(taken / (1 - taken)))


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``: each weight
    counts once per text that has the feature. Null and empty texts get the bias
    alone; no model: 0."""
    index, weight, bias = model or (np.zeros(0, np.int64), np.zeros(0), -np.inf)

    def run(batches):
        dense = np.zeros(1 << BITS)
        dense[index] = weight
        for b in batches:
            buf, offs = utf8(b.column(1))
            total = np.full(len(offs) - 1, bias)
            for i, j in slabs(offs):
                h, first = word_hashes(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], NON_ALNUM)
                f, row = features(h, first)
                hit = dense[f] != 0
                key = np.unique(row[hit] * (1 << BITS) + f[hit])
                np.add.at(total, i + (key >> BITS), dense[key & ((1 << BITS) - 1)])
            p = 1.0 / (1.0 + np.exp(np.minimum(-total, 700))) * (total > -np.inf)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["doc_id", "score"])

    out = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
