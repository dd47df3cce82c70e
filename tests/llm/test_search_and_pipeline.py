"""Nearest neighbours, decontamination and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnlake.llm import decontaminate, line_dedup, nn_descent, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def recall(got, vectors, queries, top=20):
    """Share of the true nearest that are found; ties by score count for each other."""
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids], float)
    hit = total = 0
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r)
    for q in queries:
        s = m @ np.array(vectors[q], float)
        s[ids == q] = -np.inf
        order = np.lexsort((ids, -s))[:min(top, len(ids) - 1)]
        rows = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(order) + 1))
        assert len({r["vec_id"] for r in rows}) == len(rows) and q not in {r["vec_id"] for r in rows}
        keys = [(-r["score"], r["vec_id"]) for r in rows]
        assert keys == sorted(keys)
        for r in rows:
            assert abs(r["score"] - float(np.dot(np.array(vectors[r["vec_id"]], float), np.array(vectors[q], float)))) < 1e-9
        hit += sum(r["vec_id"] in set(ids[order]) for r in rows)
        total += len(order)
    return hit / total


def test_search_recall_and_copies(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((12, 16))
    v = (centers[rng.integers(0, 12, 1200)] + 0.7 * rng.standard_normal((1200, 16))).astype(np.float32)
    v[300:600] = v[300]  # a quarter are copies of one vector
    v[700] *= 3
    vectors = {i: v[i].tolist() for i in range(1200)}
    rows = [(i, x) for i, x in vectors.items()] + [(0, vectors[0]), (2001, None), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] * 16), (None, vectors[3]), (2005, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("id", F.lit(2)).repartition(4)
    got = nn_descent.nearest(table, "id % 20 = 0").collect()
    assert {r["query_id"] for r in got} == {i for i in range(0, 1200, 20)}
    assert recall(got, vectors, range(0, 1200, 20)) >= 0.95


def test_search_small_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.5, 0.5]), (40, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nn_descent.nearest(few, "id % 20 = 0").collect()]
    assert sorted(got) == [(0, 1, 1, 0.5), (0, 2, 20, 0.5), (0, 3, 40, -1.0), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 40, -0.5), (40, 1, 1, -0.5), (40, 2, 20, -0.5), (40, 3, 0, -1.0)]
    assert nn_descent.nearest(few.limit(0), "id % 20 = 0").count() == 0


def test_blocks_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    table = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(700)], "vec_id long, embedding array<double>")
    units = nn_descent._unit(nn_descent.nodes_of(nn_descent.usable(table), 3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (2, 97):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = nn_descent.blocks(units).select("node", "number").collect()
            assert sorted(r["number"] for r in got) == list(range(700)) and {r["node"] for r in got} == set(range(700))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# ---------------------------------------------------------------- decontamination

ITEMS = [(0, "A train travels 120 km in 2 hours while Alice waits at the old station, then it stops for 2 hours again."),
         (1, "If the farmer Bob sells 15 apples and 15 pears each morning, how many fruits remain after the long market day?"),
         (2, "short one"), (3, None), (4, ""), (1, "If the farmer Bob sells 15 apples and 15 pears each morning, how many fruits remain after the long market day?"),
         (5, "seven plain words make one whole item")]


def test_reparameterised_items_are_found_and_inconsistent_slots_are_not(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("size", F.lit("x"))
    texts = {
        1: "Intro here. A train travels 300 miles in 5 days while Carol waits at the old station, then it stops for 5 days again. End.",
        2: "a train travels 300 km in 5 hours while Carol waits at the old station, then it stops for 9 hours again",  # 2 = 2 is broken
        3: "If the farmer Dan sells 8 apples and 9 pears each morning, how many people came along with him",
        4: "If the farmer Dan sells 8 apples and 8 pears each morning, how many people came along with him",
        5: "Nothing in common with any of these items at all, but 120 km in 2 hours.",
        6: None, 7: "", 8: "IF THE FARMER bob sells 15 apples and 15 pears",
        9: "we say seven plain words make one whole item here", 10: "word " * 30000 + ITEMS[1][1]}
    rows = [(i, t, None, None, 0) for i, t in texts.items()] + [(None, ITEMS[0][1], None, None, 0), (1, texts[1], None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("hits", F.lit(1)).withColumn("at", F.lit(1)).repartition(3)
    got = decontaminate.contamination(docs, bench).collect()
    assert len(got) == len(rows)
    # the first windows of 2 hold only one of its two hour slots: those stay consistent
    flags = {r["doc_id"]: r["contaminated"] for r in got}
    assert flags == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False, 7: False, 8: False, 9: True, 10: True, None: True}
    assert {r["doc_id"]: r["item_id"] for r in got if r["contaminated"]} == {1: 0, 2: 0, 4: 1, 9: 5, 10: 1, None: 0}
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {3, 5, 6, 7, 8}
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_items_of_few_plain_words_and_of_unspaced_scripts_are_found_verbatim(spark):
    """Numbers, units, names, short items and scripts without spaces: a copy is a hit, other values are not."""
    items = {1: "Solve 12 + 7 * 3 - 4 / 2 + 9 - 15 * 8 / 6 + 31", 2: "2, 3, 5, 8, 13, 21, 34, 55", 3: "Compute sin 45 degrees",
             4: "\u5c0f\u660e\u6709\u5341\u4e8c\u4e2a\u82f9\u679c\u4ed6\u5403\u4e86\u4e09\u4e2a\u8fd8\u5269\u591a\u5c11\u4e2a", 5: "\u0e41\u0e21\u0e27\u0e01\u0e34\u0e19\u0e1b\u0e25\u0e32\u0e01\u0e35\u0e48\u0e15\u0e31\u0e27\u0e43\u0e19\u0e27\u0e31\u0e19\u0e19\u0e35\u0e49",
             6: "Berlin Paris London Rome Madrid Vienna Lisbon Oslo Athens Dublin Prague", 7: "Name all primes below ninety"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = {i * 10: f"we saw, in the exam: {t} and so on" for i, t in items.items()} | {i * 10 + 1: t for i, t in items.items()}
    clean = {900: "Solve 13 + 7 * 3 - 4 / 2 + 9 - 16 * 8 / 6 + 32", 901: "2, 3, 5, 7, 11, 13, 17, 19", 902: "Compute sin 46 degrees",
             903: "\u5c0f\u660e\u6709\u4e5d\u4e2a\u68a8\u5b50\u4ed6\u9001\u4e86\u4e09\u4e2a\u7ed9\u670b\u53cb", 904: "Berlin Paris London Rome and the sea", 905: "name all the primes"}
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in (texts | clean).items()], SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert {i: got[i]["item_id"] for i in texts} == {i: i // 10 for i in texts}
    assert not [i for i in clean if got[i]["contaminated"]]
    assert got[71]["n_windows"] == 1  # by template and by words: one window


def test_decontamination_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_decontamination_matches_verbatim_search(spark):
    """On the driver's rows: every text that holds an item word for word is found."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    flags = {r["doc_id"]: r["contaminated"] for r in decontaminate.contamination(docs, bench).collect()}
    items = [r["text"] for r in bench.collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = {i for i, t in texts.items() if any(x in t for x in items)}
    assert held and held <= {i for i, f in flags.items() if f}

    def grams(t):
        w = ["".join(c for c in x if c.isalnum()).lower() for x in t.split()]
        return {tuple(w[k:k + 6]) for k in range(len(w) - 5)}
    known = set().union(*map(grams, items))
    assert all(grams(texts[i]) & known for i, f in flags.items() if f)


def test_window_counts_are_those_of_all_pairs_of_windows(spark):
    """n_windows against a plain comparison of every text window with every benchmark window."""
    items = [t for _, t in ITEMS if t] + ["Compute sin 45 degrees", "2, 3, 5, 8, 13, 21, 34, 55 and 89 more", "Berlin Paris London Rome Madrid Vienna Lisbon Oslo Athens Dublin Prague"]
    rng = random.Random(3)
    words = " ".join(items).split()
    texts = ["", "we say " + items[0]] + [" ".join(rng.choice(items) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: (r["n_windows"], r["item_id"]) for r in decontaminate.contamination(docs, bench).collect()}

    def tokens(frame, key):
        out = frame.select(key, decontaminate.marked(F.col("text")).alias("m"))
        return {r[0]: r["m"].split() for r in out.collect()}
    marks = "\x02\x03\x04"

    def pattern(window):
        slots = [w for w in window if w[0] in marks]
        return tuple(slots.index(w) for w in slots)

    def frame(window):
        return tuple(w[0] if w[0] in marks else w for w in window)

    def bare(window):
        return tuple(x for x in (w.translate({2: None, 3: None, 4: None}) for w in window) if x)
    by_template, by_words = {}, {}
    for i, ws in tokens(bench, "item_id").items():
        n = min(len(ws), 10)
        for at in range(len(ws) - n + 1):
            w = ws[at:at + n]
            plain = sum(x[0] not in marks for x in w)
            typed = plain >= 5 and n >= 5
            if typed:
                by_template.setdefault((frame(w), pattern(w)), set()).add(i)
            if not typed or n < 10:
                by_words.setdefault(bare(w), set()).add(i)
    for d, ws in tokens(docs, "doc_id").items():
        hits = {}
        for n in range(1, 11):
            for at in range(len(ws) - n + 1):
                w = ws[at:at + n]
                found = by_template.get((frame(w), pattern(w)), set()) | by_words.get(bare(w), set())
                if found:
                    hits[at, n] = min(found)
        assert got[d] == (len(hits), min(hits.values(), default=None)), texts[d]
    assert len({n for n, _ in got.values()}) > 5


# ---------------------------------------------------------------- pipeline

def test_extra_columns_may_have_any_name(spark):
    names = ["ats", "cut_doc", "cut_key", "kept_text", "n_lines", "n_removed", "gone_lines", "all_lines", "kept_row", "kept_doc",
             "own_text", "own_row", "own_doc", "own_key", "hit_doc", "hit_key", "text_key", "fp", "row", "h", "size", "words"]
    page = "one line here\nanother line there\nand a third one"
    rows = [(1, page + "\nfirst end"), (2, page + "\nquite another ending of this text"), (3, "we say " + ITEMS[1][1]), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], SCHEMA)
    wide = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for stage in (line_dedup.deduplicated, simhash.representatives, lambda d: decontaminate.decontaminated(d, bench)):
        plain = sorted(map(tuple, stage(docs).collect()), key=str)
        got = stage(wide)
        assert got.columns == wide.columns
        out = got.collect()
        assert sorted((tuple(r)[:len(docs.columns)] for r in out), key=str) == plain
        assert all(r[n] == f"{n}{r['doc_id']}" for r in out for n in names)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    at = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        at = corpus_pipeline.stored(out, name)
        kept[name] = {r["doc_id"]: r["text"] for r in at.collect()}
    assert set(kept["language_id"]) == {i for i, t in before.items() if any(c.isalpha() for c in t)}
    # lines: brute force over what language identification kept
    seen, cut = set(), {}
    for i, t in sorted(kept["language_id"].items()):
        lines, gone = t.split("\n"), set()
        for k in range(len(lines) - line_dedup.RUN + 1):
            w = tuple(lines[k:k + line_dedup.RUN])
            if w in seen:
                gone |= set(range(k, k + line_dedup.RUN))
            seen.add(w)
        if len(gone) < len(lines):
            cut[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert kept["line_dedup"] == cut
    # near-duplicates: one of each component stays
    fps = {i: simhash._fingerprint(t.encode(), 3, 42) for i, t in cut.items()}
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in ids:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert set(kept["simhash_near_dedup"]) == {i for i in ids if find(i) == i}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [r["text"] for r in bench.collect()]
    left = kept["benchmark_decontamination"]
    assert set(left) < set(kept["simhash_near_dedup"]) and not any(x in t for t in left.values() for x in items)
    last = {r["doc_id"]: r for r in at.collect()}
    assert set(last) == set(left) and all(r["round_trip"] and r["n_piece_ids"] == len(r["piece_ids"]) for r in last.values())
    ran = corpus_pipeline.run(spark, SF)
    assert Counter(r["doc_id"] for r in ran.collect()) == Counter(list(last))


def test_pipeline_odd_rows(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice(["the", "cat", "and", "dog", "bird", "tree"]) for _ in range(60))
    rows = [(1, text, "en", "s", 5), (2, text, "en", "s", 5), (2, text, "en", "s", 5), (3, None, "en", None, None), (4, "", None, "s", 0), (5, "123", None, "s", 0),
            (None, text + " more", "en", "s", 1), (6, "a\nb\nc\nd", "en", "s", 7), (7, "x y\na\nb\nc\nd", "en", "s", 7)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("fp", F.lit("x"))
    for df in (docs, docs.limit(0)):
        at = df
        for _, stage in corpus_pipeline.STAGES:
            at = corpus_pipeline.stored(stage(spark, at, SF), "odd")
        got = at.collect()
        if df is docs:
            assert {1, 6, 7} <= {r["doc_id"] for r in got} and not {2, 3, 4, 5} & {r["doc_id"] for r in got}
            assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got}[7] == ("x y\nd", 5) or {r["doc_id"]: (r["text"], r["n_chars"]) for r in got}[7] == ("x y", 3)
        else:
            assert got == []
