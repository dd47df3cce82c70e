"""Runs of periodic words.

A run of period q is a stretch of words in which words q apart are the same. Seen as a
table of words against earlier words, it is a diagonal of matches at lag q. The online
rule is: at each word its earlier occurrences lengthen the diagonal of their lag by
one, the others end, and a diagonal that ends long enough is a run.

The diagonals are kept sparse without losing a run. A run of at least four periods has
at least 3q matches on its diagonal, so for lags from 2**k to 2**(k+1) - 1 an
occurrence counts when the last 3 * 2**k words agree; two such occurrences less than
2**k apart would give the stretch a smaller period (Fine and Wilf), so only the nearest
earlier occurrence can be on the diagonal of a run with its smallest period. Each word
therefore has one earlier occurrence a level at most, and only stretches that occur
again in the text go on to the next level: n log n steps in the worst case, about n in
prose, whatever repeats. ``tests/llm`` holds the result against all diagonals."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, utf8

WORD = re.compile(rb"[^\x20\x09-\x0D]+").findall
#: Bytes of text that are searched together.
SLAB = 1 << 20
#: Periods that a run has at least, and its least number of words.
PERIODS, LEAST = 4, 6


def _earlier(names: np.ndarray) -> np.ndarray:
    """For each entry the index of the entry before it with the same name, or -1."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    out = np.full(len(names), -1, np.int64)
    out[order[1:][same]] = order[:-1][same]
    return out


def _diagonals(at: np.ndarray, lag: np.ndarray, gram: int):
    """(end, lag, matches) of the diagonals: neighbouring words with the same lag lengthen
    one, any other word ends it. ``gram`` words match already where a diagonal is first seen."""
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (lag[1:] != lag[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[last], lag[first], at[last] - at[first] + gram


def find_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs in a sequence of word numbers, by start, then
    period. Texts can be searched together if no number stands in two of them."""
    n, found = len(words), []

    def emit(ends, lags, matches):
        length = matches + lags
        ok = (length >= LEAST) & (length >= PERIODS * lags)
        found.append(np.stack([ends - length + 1, length, lags], 1)[ok])

    if n < LEAST:
        return np.empty((0, 3), np.int64)
    # lag 1: the word before is the same
    at = np.flatnonzero(words[1:] == words[:-1]) + 1
    emit(*_diagonals(at, np.ones(len(at), np.int64), 1))
    # names of the last 1, 2, then 3 * 2**k words; only words that occur again in such a stretch stay
    one = words.astype(np.int64)
    at, names = _joined(*_repeated(np.arange(n), one), 1)
    at, names = _named(at, names, one[at - 2], at >= 2)
    k, gram = 0, 3
    while len(at):
        k, gram = k + 1, gram * 2
        at, names = _joined(at, names, gram // 2)
        if not len(at):
            break
        back = _earlier(names)
        has = back >= 0
        lag = at[has] - at[back[has]]
        near = (lag >= 1 << k) & (lag < 2 << k)
        emit(*_diagonals(at[has][near], lag[near], gram))
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _repeated(at, names):
    """The places whose name stands at another place too."""
    _, inverse, count = np.unique(names, return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    return at[keep], inverse[keep].astype(np.int64)


def _named(at, left, right, ok):
    """Numbers for pairs of names where ``ok``; pairs that stand once are left out."""
    if not ok.any():
        return at[:0], left[:0]
    left, right = left[ok], right[ok]
    return _repeated(at[ok], left * (int(right.max()) + 1) + right)


def _joined(at, names, back: int):
    """Names of stretches made of the one that ends at a place and the one that ends ``back`` before it."""
    if not len(at):
        return at, names
    where = np.searchsorted(at, at - back)
    return _named(at, names, names[where], at[where] == at - back)


def _search(lists: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each word list: the lists are searched as one sequence, with words numbered apart."""
    numbers, ends, base = [], [], 0
    for words in lists:
        own: dict[bytes, int] = {}
        numbers.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
        ends.append(len(numbers))
    runs = find_runs(np.array(numbers, np.int64))
    cuts = np.searchsorted(runs[:, 0], [0, *ends])
    return [runs[i:j] - [start, 0, 0] for i, j, start in zip(cuts[:-1], cuts[1:], [0, *ends])]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def periodic_runs(docs: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id long, n_words long, runs array<struct<start, length, period>>, collapsed string), one
    row per row of ``docs``: every maximal run of at least six words and four periods in the
    whole text, by start and period, and the text with the repeats of each run left out.

    ``prepare`` may change a text's words before the search. A null or empty text has no words
    and no runs; repeated rows are searched each; a null doc_id stays null; an empty table
    gives an empty result; only doc_id and text are read. A long text of one word costs what
    prose of that length costs."""
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            _, offs = utf8(b.column(1))
            for i, j in slabs(offs, SLAB):
                lists = [WORD(t) for t in b.column(1).slice(i, j - i).to_pylist()]
                if prepare:
                    lists = [prepare(d, words) for d, words in zip(ids[i:j], lists)]
                found = _search(lists)
                flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
                ends = np.cumsum([0, *map(len, found)])
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, x]) for x in range(3)], fields=list(struct)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(list(map(len, lists)), pa.int64()), runs,
                     pa.array([collapse(w, r) for w, r in zip(lists, found)], pa.binary())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
