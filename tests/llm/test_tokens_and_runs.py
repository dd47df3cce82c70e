"""Tokenizer alignment, periodic runs and token counts against brute force, with nulls,
empty and long texts, repeated rows, empty tables and extra columns of clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlake.llm import alignment, parts, periodic, queries, token_counts
from churnlake.llm.queries import BYTE_TOKENIZER, QUERIES, TOKENIZER

SCHEMA = "doc_id long, text string"
SF = "/root/testdata/sf0.001"
CLASHING = ("part", "n", "k", "text_key", "n_bytes", "rest", "n_tokens", "copies", "copy", "groups", "a", "b", "links", "best",
            "n_a", "n_best", "groups_sha256", "runs", "collapsed", "n_words", "step")


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    signs = ["a", "b", "word", "Über", " ", "  ", "\n", "\t", "\x1c", "　", " ", "日本", "語", "'s", "don't", "1234", "=====", "\r\n", "\x00",
             "<s>", "</s>", "<|endoftext|>", "<0x41>", "😀", "é", "﻿", " ", "", "!!", ".", "the", " the", "▁"]
    rows = [(i, "".join(rng.choice(signs[:-1 if i % 9 else None]) for _ in range(rng.randint(1, 60)))) for i in range(90)]
    rows += [(100, None), (101, ""), (102, " "), (103, "   "), (104, "\n"), (105, "▁"), (106, "x" * 5000), (107, "日本語" * 700), (108, " \n\t " * 300),
             (109, "the " * 3000), (110, rows[3][1]), (110, rows[3][1]), (None, rows[4][1]), (None, rows[4][1]), (None, None), (111, "=" * 300 + " a")]
    rows += [(200 + i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect())]
    return rows


# ---------------------------------------------------------------- token counts

def brute_counts(rows):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    return sorted(((i, len((t or "").encode()), len(m.encode(t or ""))) for i, t in rows), key=str)


@pytest.mark.parametrize("hot", [1 << 16, 12, 0])
def test_token_counts_are_those_of_the_library(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(parts, "HOT", hot)  # 12: most pre-tokens are joined; 0: all are
    got = token_counts.token_counts(frame(spark, corpus), TOKENIZER).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_counts(corpus)


def test_token_counts_of_an_empty_table(spark):
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), TOKENIZER).collect() == []


def test_cut_reaches_no_merge():
    p, rng = token_counts.pretokens(TOKENIZER), random.Random(1)
    names = [p.model.id_to_piece(i) for i in range(300, 32000)]
    for _ in range(300):
        t = "".join(rng.choice(names) for _ in range(rng.randint(1, 40))).replace("▁", rng.choice([" ", "", "▁"]))
        if t:
            cut = p.split(t)
            assert "".join(cut) == " " + t.replace("▁", " ")
            assert sum(p.counts(cut)) == len(p.model.encode(t))


def test_long_runs_are_cut_in_linear_pieces():
    p = token_counts.pretokens(TOKENIZER)
    for t in ("日本語" * 5000, "x" * 20000, "=" * 20000, "ሴ" * 5000):
        assert sum(p.counts(p.split(t))) == len(p.model.encode(t))


def test_op13_query(spark):
    got = QUERIES["op13_token_counts"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == brute_counts(rows)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


# ---------------------------------------------------------------- alignment

def brute_alignment(rows):
    """Whole texts through both libraries; overlaps by comparing byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    table = alignment.byte_level()
    docs, count = [], Counter()
    for i, t in rows:
        s = (" " + (t or "")).encode()
        e = a.encode(" " + t, add_special_tokens=False) if t else None
        ids_a = e.ids if t else []
        raw_a = [bytes(table[c] for c in x) for x in e.tokens] if t else []
        ids_b = m.encode(t) if t else []
        raw_b = [bytes([x - 3]) if m.is_byte(x) else m.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not t or b"".join(raw_a) != s or b"".join(raw_b) != s:
            docs.append((i, None))
            continue
        ea, eb = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
        found, j0 = [], 0
        for x in range(len(ids_a)):
            while eb[j0] <= sa[x]:
                j0 += 1
            y = j0
            while y < len(ids_b) and sb[y] < ea[x]:
                found.append((ids_a[x], ids_b[y]))
                y += 1
        count.update(found)
        text, x, y = [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            u, v = ea.index(end, x) + 1, eb.index(end, y) + 1
            text.append(",".join(map(str, ids_a[x:u])) + "|" + ",".join(map(str, ids_b[y:v])))
            x, y = u, v
        docs.append((i, (len(ids_a), len(ids_b), len(text), found, ";".join(text))))
    most = Counter()
    for (_, y), c in count.items():
        most[y] = max(most[y], c)
    out = []
    for i, d in docs:
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, d[0], d[1], d[2], len(d[3]), sum(count[p] == most[p[1]] for p in d[3]), sum(count[p] for p in d[3]),
                        hashlib.sha256(d[4].encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1 << 18, 12, 0])
def test_alignment_is_that_of_whole_texts(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)  # 12: most pairs are joined; 0: all are
    got = alignment.alignments(frame(spark, corpus), BYTE_TOKENIZER, TOKENIZER).drop("n_bytes").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_alignment(corpus)


def test_alignment_of_an_empty_table(spark):
    assert alignment.alignments(spark.createDataFrame([], SCHEMA), BYTE_TOKENIZER, TOKENIZER).collect() == []


def test_groups_are_written_out(spark):
    got = alignment.groups_of(spark.createDataFrame([(1, "Hello, wörld"), (2, None), (3, "a▁b")], SCHEMA), BYTE_TOKENIZER, TOKENIZER).collect()
    p = alignment.pair(BYTE_TOKENIZER, TOKENIZER)
    assert [r.groups for r in sorted(got)] == [";".join(p.records([x])[0][3] for x in (" Hello,", " wörld")), "", ""]


def test_align_cuts_at_common_ends():
    assert alignment.align([2, 5, 9], [1, 2, 6, 9]) == [(1, 2), (3, 4)]
    _, i, j = alignment.links(np.array([2, 5, 9]), np.array([1, 2, 6, 9]))
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 2), (2, 2), (2, 3)]


def test_segments_and_joint_chunks_give_the_same(corpus, monkeypatch):
    p = alignment.pair(BYTE_TOKENIZER, TOKENIZER)
    texts = [t or "" for _, t in corpus]
    whole = alignment._documents(p, texts)
    for segment, together, memo in ((1, 256, 10), (50, 1, 0), (1 << 20, 3, 1000)):
        monkeypatch.setattr(alignment, "SEGMENT", segment)
        monkeypatch.setattr(alignment, "TOGETHER", together)
        monkeypatch.setattr(alignment, "MEMO", memo)
        p.young.clear()
        p.old.clear()
        assert alignment._documents(p, texts) == whole


def test_op11_query(spark):
    got = QUERIES["op11_cross_tokenizer_alignment"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in got), key=str) == brute_alignment(rows)


# ---------------------------------------------------------------- periodic runs

def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            stretch = words[start:start + length]
            if length >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 7)), max_size=8))
def test_runs_are_all_diagonals(blocks):
    words = [x for block, times in blocks for x in block * times]
    assert [tuple(r) for r in periodic.find_runs(np.array(words, np.int64)).tolist()] == brute_runs(words)


def test_nested_and_neighbouring_runs():
    rng = random.Random(2)
    for _ in range(150):
        word = [rng.randint(0, 1) for _ in range(rng.randint(1, 9))]
        inner = word * rng.randint(1, 8) + [rng.randint(0, 2) for _ in range(rng.randint(0, 3))]
        words = [9] * rng.randint(0, 3) + inner * rng.randint(1, 6) + word * rng.randint(0, 6) + inner[:rng.randint(0, len(inner))]
        assert [tuple(r) for r in periodic.find_runs(np.array(words, np.int64)).tolist()] == brute_runs(words)


def test_a_long_text_of_few_words_takes_linear_time():
    import time
    t0 = time.time()
    one = periodic.find_runs(np.zeros(1_000_000, np.int64))
    assert one.tolist() == [[0, 1_000_000, 1]]
    rng = np.random.default_rng(0)
    periodic.find_runs(rng.integers(0, 2, 1_000_000))
    periodic.find_runs(np.tile(rng.integers(0, 2, 100_000), 8))
    assert time.time() - t0 < 60


def brute_op12(rows):
    out = []
    for i, t in rows:
        words = [w for w in (t or "").encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ")
                 .replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
        n = len(words)
        if i is not None and n:
            h = zlib.crc32(str(i).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
        out.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                    hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                    hashlib.sha256(brute_collapse(words, runs)).hexdigest()))
    return sorted(out, key=str)


def test_op12_query_and_edge_cases(spark, corpus, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, r.text) for r in docs if len(r.text or "") < 12000]
    extra = [(7000 + i, " ".join(random.Random(i).choices("ab", k=80))) for i in range(60)]
    rows = corpus + extra + short
    made = frame(spark, rows)
    monkeypatch.setattr(queries, "table", lambda *a: made)
    got = QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_op12(rows)
    assert sum(r.n_runs > 0 for r in got) > 20


def test_periodic_runs_of_an_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


# ---------------------------------------------------------------- streaming Viterbi

def test_short_texts_have_the_same_ids():
    from churnlake.llm import pieces
    p, rng = pieces._pieces(*pieces.vocabulary(TOKENIZER)), random.Random(8)
    signs = ["a", "e", "the", " ", "ing", "日", "é", "ሴ", "==", "-", "1", "\n", "tion", "ss"]
    for _ in range(400):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))[:4 * p.longest]
        assert p.short(t) == p.viterbi(t)


def test_equal_letters_take_linear_time():
    import time
    from churnlake.llm import pieces
    p = pieces._pieces(*pieces.vocabulary(TOKENIZER))
    took = {}
    for n in (20_000, 200_000):
        t0 = time.process_time()
        assert p.decode(p.viterbi(" " + "=" * n)) == "=" * n
        took[n] = time.process_time() - t0
    assert took[200_000] < 30 * took[20_000] + 5
