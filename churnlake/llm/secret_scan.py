"""Secret scans: fixed patterns, and character Markov models of random strings against
ordinary identifiers, compared by log-likelihood ratio."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, sample_by_hash, texts_of

#: FIXED VALUES: the three base patterns, and the least length of what they take.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ["assign", "access", "hex", "markov"]
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A run of 16 or more hex digits is found the same by this faster pattern.
_HEX_LONG = re.compile(r"[0-9a-f]{16,}")

#: Candidates of the Markov models, and the shorter identifiers that teach the ordinary one.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{6,19}(?![A-Za-z0-9+/_-])")
#: Characters of the models: the 65 of the candidates, and one start state.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SIZE = len(ALPHABET)
_CODE = np.zeros(128, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
#: Bound of the labelled sample (rows), and the least log2-likelihood ratio: in all and per character.
SAMPLE_ROWS, LEAST_TOTAL, LEAST_MEAN = 4000, 24.0, 1.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in code points: leftmost and non-overlapping
    per kind, then those too short are dropped."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    return sorted(out)


def _counts(strings: list[str]) -> np.ndarray:
    """First characters (row SIZE) and character pairs of the strings."""
    table = np.zeros((SIZE + 1, SIZE), np.int64)
    for s in strings:
        x = _CODE[np.frombuffer(s.encode(), np.uint8)]
        np.add.at(table, (np.concatenate([[SIZE], x[:-1]]), x), 1)
    return table


def _parts(value: str) -> list[str]:
    return [p for p in re.split(r"[^A-Za-z0-9+/_-]+", value) if len(p) >= 6]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Log2-likelihood ratios (previous character, character) of random strings to ordinary
    identifiers, from at most ``sample_rows`` labelled rows (smallest hash): the values that
    the assign and access patterns label as secrets, and the identifiers of 6 to 19 characters outside their spans.

    Both are smoothed: the random model towards its single characters and equal chances, the
    ordinary one towards its single characters. Empty tables: all ratios are 0."""
    rows = keyed(docs).filter("doc_id is not null").withColumn("all_rows", F.lit(1))
    counts = {1: rows.count()}
    few = sample_by_hash(rows, sample_rows, "all_rows", counts).select("text")

    def run(batches):
        secret = np.zeros((SIZE + 1, SIZE), np.int64)
        plain = np.zeros((SIZE + 1, SIZE), np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                spans = base_spans(text)
                values, rest, at = [], [], 0
                for start, kind, end in spans:
                    m = ASSIGN.match(text, start) if kind == 0 else None
                    values += [] if kind == 2 else _parts(m[2] if m else text[start:end])
                    if start > at:
                        rest += ORDINARY.findall(text[at:start])
                    at = max(at, end)
                rest += ORDINARY.findall(text[at:])
                secret += _counts(sorted(set(values)))  # a value that a text repeats teaches once
                plain += _counts(rest)
        cells = np.arange(secret.size)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(secret.ravel()), pa.array(plain.ravel())], ["cell", "secret", "plain"])

    table = (few.mapInArrow(run, "cell long, secret long, plain long").groupBy("cell")
             .agg(F.sum("secret").alias("secret"), F.sum("plain").alias("plain")).collect())
    secret, plain = np.zeros((SIZE + 1) * SIZE), np.zeros((SIZE + 1) * SIZE)
    for r in table:
        secret[r["cell"]], plain[r["cell"]] = r["secret"], r["plain"]
    if not plain.any():
        return np.zeros((SIZE + 1, SIZE))
    flat = np.full(SIZE, 1 / SIZE)
    secret, plain = secret.reshape(SIZE + 1, SIZE), plain.reshape(SIZE + 1, SIZE)
    single = (secret.sum(0) + 4 * SIZE * flat) / (secret.sum() + 4 * SIZE)  # characters of random strings, smoothed
    random = (secret + 200 * single) / (secret.sum(1, keepdims=True) + 200)
    common = (plain.sum(0) + flat) / (plain.sum() + 1)
    usual = (plain + 20 * (0.95 * common + 0.05 * flat)) / (plain.sum(1, keepdims=True) + 20)
    return np.log2(random) - np.log2(usual)


def llr(ratios: np.ndarray, value: str) -> float:
    x = _CODE[np.frombuffer(value.encode(), np.uint8)]
    return float(ratios[np.concatenate([[SIZE], x[:-1]]), x].sum())


def markov_spans(text: str, taken: list[tuple[int, int, int]], ratios: np.ndarray,
                 least_total: float = LEAST_TOTAL, least_mean: float = LEAST_MEAN) -> list[tuple[int, int, int]]:
    """Candidates that touch no base span and look random: a log-likelihood ratio of
    ``least_total`` bits in all and ``least_mean`` bits per character."""
    out = []
    for m in CANDIDATE.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in taken):
            continue
        r = llr(ratios, m[0])
        if r >= least_total and r >= least_mean * len(m[0]):
            out.append((m.start(), 3, m.end()))
    return out


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, ratios: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans), one row per row.

    The whole text is scanned (null: empty). spans: kind:start:end by start, then kind, in
    code points, end exclusive; base spans always stay. Trains on ``docs`` without ``ratios``."""
    ratios = train(docs) if ratios is None else ratios

    def run(batches):
        for b in batches:
            n, sha, said = [[] for _ in KINDS], [], []
            for x in b.column(1):
                text = x.as_py()
                base = base_spans(text)
                more = markov_spans(text, base, ratios)
                for k in range(4):
                    n[k].append(sum(s[1] == k for s in base) if k < 3 else len(more))
                sha.append(hashlib.sha256(_said(base).encode()).hexdigest())
                said.append(_said(sorted(base + more)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in n), pa.array(sha), pa.array(said, pa.string())],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
