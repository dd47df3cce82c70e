"""Language identification by cross-parsing entropy.

Each language has the suffix automaton of a labelled text. A document is cut,
per language, into the fewest greedy phrases that occur in that text (each phrase
is a longest match); the language needing the fewest phrases per character wins."""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, kept, make_room, stored

#: Bound of the labelled sample: so many slices of so many characters per language.
SAMPLE_DOCS, SAMPLE_CHARS = 128, 400
#: Languages whose automata one worker holds at a time; more are parsed in further passes over the texts.
LANGS_A_PASS = 64
#: A text is parsed in pieces of so many characters (all of it; a phrase ends at a piece's end).
PIECE = 1024
#: Characters parsed together.
SLAB_CHARS = 1 << 21
UNDECIDED = "und"
#: Bits of a transition that hold the next state; those above count ended phrases.
_STATE = 29
#: A text that takes more phrases per character than this in every language is in none of them
#: (``bounds`` gives languages of many letters a higher one).
MOST_PHRASES = 0.6


def suffix_automaton(text) -> list[dict]:
    """Transitions of the suffix automaton of a symbol sequence; state 0 is the start.
    A path from 0 spells exactly the substrings of ``text``."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p != -1:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[cur] = twin
                while p != -1 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
        last = cur
    return go


def _fold(c: str) -> str:
    """The lower-case letter; the letter itself if its lower case is not one character."""
    return low if len(low := c.lower()) == 1 else c


def _packed(go: list[dict], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(table, start): the transitions as rows that share one array. A state is the place of
    its row: entry ``state + symbol`` holds the row's state (high 32 bits) and the step (count
    of ended phrases above _STATE, next state below); another row's entry is a miss, which
    takes ``start[symbol]``. The start state is 0 and its row is full."""
    rng = np.random.default_rng(5)
    edges = [sorted((c, to) for c, to in step.items() if c > 0) for step in go]
    known = np.zeros(width, bool)
    known[[c for c, _ in edges[0]]] = True
    room = 1 << int(2 * (sum(map(len, edges)) + width)).bit_length()
    owner = np.full(room + width, -1, np.int64)
    owner[:width] = 0
    # a state without transitions always misses: these share the place ``room``, which no row has
    place = np.full(len(go), room, np.int64)
    place[0] = 0
    taken = np.zeros(room, bool)
    taken[0] = True
    by_size: dict[int, list[int]] = {}
    for s, e in enumerate(edges):
        if s and e:
            by_size.setdefault(len(e), []).append(s)
    for size in sorted(by_size, reverse=True):
        wait = np.array(by_size[size])
        symbols = np.array([[c for c, _ in edges[s]] for s in wait], np.int64)
        while len(wait):  # rows draw places until theirs are free; of two that clash, the first drawn stays
            at = rng.integers(1, room, len(wait))
            free = np.flatnonzero(~taken[at] & (owner[at[:, None] + symbols] < 0).all(axis=1))
            free = free[np.sort(np.unique(at[free], return_index=True)[1])]
            slots = at[free, None] + symbols[free]
            _, first, inverse = np.unique(slots, return_index=True, return_inverse=True)
            mine = first[inverse].reshape(slots.shape) == np.arange(slots.size).reshape(slots.shape)
            ok = free[mine.all(axis=1)]
            owner[at[ok, None] + symbols[ok]] = at[ok, None]
            taken[at[ok]] = True
            place[wait[ok]] = at[ok]
            left = np.ones(len(wait), bool)
            left[ok] = False
            wait, symbols = wait[left], symbols[left]
    step = np.zeros(room + width, np.int64)
    step[:width] = 1 << _STATE  # a symbol that no phrase can start with is one by itself
    own = np.array([place[s] + c for s, e in enumerate(edges) for c, _ in e], np.int64)
    step[own] = place[[to for e in edges for _, to in e]]
    # a miss ends the phrase and starts the next one with this symbol
    start = np.where(known, step[:width] | (1 << _STATE), 2 << _STATE)
    return owner << 32 | step, start


class Parser:
    """Parses many texts against all languages at once, one numpy step per character
    position. The automata are built from the sample texts, once per worker."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        top = sys.maxunicode + 1
        letter = np.fromiter((chr(i).isalpha() for i in range(top)), bool, top)
        used = sorted({_fold(c) for c in {c for s in samples.values() for t in s for c in t} if c.isalpha()})
        # 0: a letter outside every sample, 1: a space (anything that is no letter), 2..: letters
        code = np.where(letter, 0, 1).astype(np.int32)
        codes = {c: i + 2 for i, c in enumerate(used)}
        for i in np.flatnonzero(letter).tolist():
            code[i] = codes.get(_fold(chr(i)), 0)
        self.letter, self.code, self.width = letter, code, len(used) + 2
        self.tables = []
        for lang in self.langs:
            text = []
            for t in samples[lang]:
                text += self.encode(t)[0].tolist() + [-1]  # -1 stands in no document: no match crosses slices
            self.tables.append(_packed(suffix_automaton(text), self.width))

    def encode(self, text: str):
        """(symbols, has_letter); runs of non-letters become one space."""
        cp = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        sym = self.code[cp]
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != 1) | (sym[:-1] != 1)
        return sym[keep], bool(self.letter[cp].any())

    def phrases(self, symbols: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): phrases of each text; a rest at a piece's end is one phrase."""
        pieces = [(i, s[a:a + PIECE]) for i, s in enumerate(symbols) for a in range(0, len(s), PIECE)]
        out = np.zeros((len(symbols), len(self.langs)), np.int64)
        pieces.sort(key=lambda x: -len(x[1]))
        sizes = np.array([len(p) for _, p in pieces], np.int64)
        if not len(sizes) or not self.langs:
            return out
        grid = np.zeros((sizes[0], len(pieces)), np.int32)
        for k, (_, p) in enumerate(pieces):
            grid[:len(p), k] = p
        live = np.searchsorted(-sizes, -np.arange(sizes[0]) - 1, side="right")
        mask = (1 << _STATE) - 1
        total = np.zeros((len(pieces), len(self.langs)), np.int64)
        for k, (table, start) in enumerate(self.tables):
            state, count = np.zeros(len(pieces), np.int64), total[:, k]
            for t in range(len(grid)):
                n = live[t]
                entry = table[state[:n] + grid[t, :n]]
                step = np.where(entry >> 32 == state[:n], entry & 0xFFFFFFFF, start[grid[t, :n]])
                state[:n] = step & mask
                count[:n] += step >> _STATE
            count += state != 0
        np.add.at(out, np.array([i for i, _ in pieces]), total)
        return out


@kept(2)
def _parser(samples: str) -> Parser:
    return Parser(json.loads(samples))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Labelled slices of every language: ``sample_docs`` rows of each (smallest hash), a
    middle slice of ``sample_chars`` characters of each. Rows with crc32(doc_id) mod 5
    of 0, or with a null id, text or lang, teach nothing; nor do texts without letters."""
    rows = (docs.filter("doc_id is not null and text is not null and lang is not null")
            .filter(crc_mod(F.col("doc_id"), 5) != 0)
            .select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.col("lang").cast("string").alias("lang")))
    # the bound of sample_by_hash, joined: there may be many languages
    share = F.least(F.lit(1.0), F.lit(4.0 * sample_docs + 64) / F.count("*"))
    shares = rows.groupBy("lang").agg((share * (1 << 30)).cast("long").alias("sample_bound"))
    few = rows.withColumn("sample_hash", F.xxhash64(F.lit(7), "doc_id", "text_key")).join(F.broadcast(shares), "lang")
    few = few.filter(F.pmod("sample_hash", F.lit(1 << 30)) < F.col("sample_bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("sample_hash", "doc_id"))
    few = few.withColumn("sample_rank", rank).filter(F.col("sample_rank") <= sample_docs)
    start = F.greatest(F.lit(1), F.floor(F.length("text") / 2) - sample_chars // 2).cast("int")
    got = few.select("lang", "doc_id", F.substring("text", start, F.lit(sample_chars)).alias("part")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r["lang"], r["doc_id"], r["part"])):
        if any(c.isalpha() for c in r["part"]):
            out.setdefault(r["lang"], []).append(r["part"])
    return out


def predict(docs: DataFrame, samples: dict[str, list[str]], keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """(keep columns..., lang_pred, score, rate): the whole text (column ``text``) of every row is
    parsed. A text among the kept columns is sent to the workers once.

    lang_pred: the language with the fewest phrases per character (ties: first by
    name); ``und`` if the text is null or has no letter, or nothing was learned.
    score: 1 - best rate / second best rate (1 - rate for one language, 0 for und).
    rate: phrases per character of the winner."""
    keep = keep or ["doc_id"]
    langs = sorted(samples)
    at = keep.index(text) if text in keep and isinstance(docs.schema[text].dataType, T.StringType) else len(keep)
    own = [F.col(text).cast("string").alias("parsed_text")] if at == len(keep) else []
    rows = docs.select(*[F.col(c) for c in keep], *own)
    fields = rows.schema.fields
    starts = range(0, max(1, len(langs)), LANGS_A_PASS)
    for a in starts:
        last = a == starts[-1]
        some = json.dumps({x: samples[x] for x in langs[a:a + LANGS_A_PASS]}, sort_keys=True)
        kind = T.StructType(fields[:len(keep)] if last else list(fields))
        for name, of in (("lang_pred", T.StringType()), ("best", T.LongType()), ("second", T.LongType()), ("symbols", T.LongType())):
            kind = kind.add(name, of)
        rows = rows.mapInArrow(_pass(some, len(keep), a > 0, last, at), kind)
        if not last:
            rows = stored(rows, "languages")
    best, second = F.col("best") / F.col("symbols"), F.coalesce(F.col("second") / F.col("symbols"), F.lit(1.0))
    found = F.col("lang_pred") != UNDECIDED
    return rows.select(*[F.col(c) for c in keep], "lang_pred",
                       F.when(found, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - best / second))).otherwise(0.0).alias("score"),
                       F.when(found, best).otherwise(1.0).alias("rate"))


def _pass(samples: str, n_keep: int, later: bool, last: bool, at: int | None = None):
    """Parses the texts (column ``at``: one of the ``n_keep`` kept ones, or the one after them)
    against some languages. Adds lang_pred, best and second (phrases of the two best languages
    so far) and symbols; a later pass gets those of the passes before. The last leaves out what
    is not kept. The rows go on in batches of about SLAB_CHARS characters."""
    at = n_keep if at is None else at
    n_in = max(n_keep, at + 1)

    def run(batches):
        make_room(_parser)
        p = _parser(samples)
        for b in batches:
            texts = b.column(at)  # taken one by one: a batch may be tens of megabytes
            before = zip(*(b.column(n_in + k).to_pylist() for k in (0, 1, 2))) if later else ((UNDECIDED, None, None) for _ in texts)
            i = 0
            while i < len(texts):
                symbols, letters, size, out, first_row = [], [], 0, [], i
                while i < len(texts) and (not symbols or size < SLAB_CHARS):
                    s, has = p.encode(texts[i].as_py() or "")
                    symbols.append(s)
                    letters.append(has)
                    size += len(s)
                    i += 1
                for s, has, row in zip(symbols, letters, p.phrases(symbols)):
                    pred, best, second = next(before)
                    if has and p.langs:
                        k = int(row.argmin())
                        if best is None or row[k] < best:  # languages come in order: the first by name wins a tie
                            pred, first = p.langs[k], int(row[k])
                            others = [best] if best is not None else []
                        else:
                            first, others = best, [int(row[k])]
                        others += [] if second is None else [second]
                        others += [int(np.delete(row, k).min())] if len(row) > 1 else []
                        best, second = first, min(others, default=None)
                    out.append((pred, best, second, len(s)))
                cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64()))]
                names = b.schema.names[:n_keep if last else n_in]
                part = b.slice(first_row, i - first_row).columns[:len(names)]
                yield pa.RecordBatch.from_arrays([*part, *cols], names=[*names, "lang_pred", "best", "second", "symbols"])

    return run


def _own_rate(lang: str, slices: list[str]) -> float:
    """Phrases per character that one half of a language's slices takes in the other half (1 if there is one)."""
    slices = list(dict.fromkeys(slices))
    p = Parser({lang: slices[::2]})
    symbols = [p.encode(t)[0] for t in slices[1::2]]
    return int(p.phrases(symbols).sum()) / sum(map(len, symbols)) if symbols else 1.0


def _own_rates(batches):
    for b in batches:
        langs = b.column(0).to_pylist()
        yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "rate": pa.array(map(_own_rate, langs, b.column(1).to_pylist()), pa.float64())})


def bounds(spark: SparkSession, samples: dict[str, list[str]], most: float = MOST_PHRASES) -> dict[str, float]:
    """The languages whose own texts take so many phrases (many letters: Chinese, say) that a text
    of theirs may be over ``most``, each with its higher bound: a quarter over its own rate, at
    most half way from it to 1, the rate of a text without any known letter."""
    if not samples:
        return {}
    # an Arrow table, not an RDD: RDD tasks have Python workers of their own beside those of DataFrames
    langs = sorted(samples)
    table = pa.table({"lang": pa.array(langs, pa.string()), "slices": pa.array([samples[x] for x in langs], pa.list_(pa.string()))})
    own = spark.createDataFrame(table).mapInArrow(_own_rates, "lang string, rate double").collect()
    high = {r["lang"]: min(1.25 * r["rate"], (1 + r["rate"]) / 2) for r in own if r["rate"] < 1}
    return {lang: x for lang, x in high.items() if x > most}


def identified(docs: DataFrame, samples: dict[str, list[str]] | None = None, most: float = MOST_PHRASES) -> DataFrame:
    """The rows of ``docs`` (its own columns) whose language is found: their text has a letter,
    and the winner needs at most ``most`` phrases per character (or its higher bound, see
    ``bounds``). Nothing learned: no row goes but those without a letter."""
    samples = learn(docs) if samples is None else samples
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = predict(docs.toDF(*names), samples or {"any": []}, names, names[docs.columns.index("text")])
    if samples:
        own = [F.lit(x) for pair in sorted(bounds(docs.sparkSession, samples, most).items()) for x in pair]
        high = F.coalesce(F.create_map(*own)[F.col("lang_pred")], F.lit(most)) if own else F.lit(most)
        out = out.filter(F.col("rate") <= high)
    return out.filter(F.col("lang_pred") != UNDECIDED).select(*names).toDF(*docs.columns)


def identify(docs: DataFrame, samples: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``; learns from
    ``docs`` itself unless ``samples`` are given. held_out: crc32(doc_id) mod 5 is 0
    (false for a null id)."""
    samples = learn(docs) if samples is None else samples
    out = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), samples)
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
