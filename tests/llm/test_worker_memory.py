"""What an operator keeps in a Python worker goes when another one's task starts there."""

import json

import pyarrow as pa

import corpus_pipeline
from churnlake.llm import common, langid, pieces
from churnlake.llm.queries import TOKENIZER


def test_a_stage_drops_what_others_keep_in_a_worker():
    p = pieces._pieces(("a", "b"), ("piece", "piece"))
    assert p.encode("ab") and pieces._pieces.cache_info().currsize
    samples = json.dumps({"en": ["some words of a text"], "de": ["ein paar Worte"]})
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3]), "parsed_text": pa.array(["some words", None, "ein paar"])})
    out = list(langid._pass(samples, 1, False, True)(iter([rows])))
    assert out[0].column(1).to_pylist() == ["en", "und", "de"]
    assert pieces._pieces.cache_info().currsize == 0 and langid._parser.cache_info().currsize == 1
    common.make_room()
    assert langid._parser.cache_info().currsize == 0


def test_the_parsed_text_is_one_of_the_kept_columns_and_rows_go_on_in_small_batches(monkeypatch):
    samples = json.dumps({"en": ["some words of a text"], "de": ["ein paar Worte"]})
    monkeypatch.setattr(langid, "SLAB_CHARS", 12)
    rows = pa.RecordBatch.from_pydict({"c0": pa.array([1, 2, 3, 4]), "c1": pa.array(["some words", None, "ein paar", "of a text"]), "c2": pa.array(["a", "b", None, "d"])})
    out = list(langid._pass(samples, 3, False, True, 1)(iter([rows])))
    assert len(out) > 1 and max(len(b) for b in out) < 4
    whole = pa.Table.from_batches(out)
    assert whole.column_names == ["c0", "c1", "c2", "lang_pred", "best", "second", "symbols"]
    assert whole.select(["c0", "c1", "c2"]).to_pydict() == rows.to_pydict()
    assert whole.column("lang_pred").to_pylist() == ["en", "und", "de", "en"]


def test_a_stage_sends_the_text_once_and_takes_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "some words of a text", "en", "s", 20), (2, None, "en", "s", None), (3, "ein paar Worte", "de", "s", 14), (4, "...", "de", "s", 3)],
                                 "doc_id long, text string, lang string, source string, n_chars long")

    def sent(df):
        lines = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in x]
        assert len(lines) == 1
        return lines[0]

    learned = {"en": ["some words of a text", "some other words"], "de": ["ein paar Worte", "ein Wort"]}
    kept = langid.identified(docs, learned)
    assert "parsed_text" not in kept._jdf.queryExecution().optimizedPlan().toString() and sent(kept)
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {1: "some words of a text", 3: "ein paar Worte"}
    coded = corpus_pipeline.sentencepiece(spark, docs, "")
    assert sent(coded)  # the other one, encode, ran before: its rows are written
    got = {r["doc_id"]: (r["n_piece_ids"], r["round_trip"]) for r in coded.collect()}
    assert got[2] == (0, True) and all(ok for _, ok in got.values()) and got[1][0] > 0
    plan = pieces.encode(docs, TOKENIZER)._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce" not in plan and "cast(text" not in plan


def test_texts_of_another_type_and_many_languages_are_parsed(spark, monkeypatch):
    rows = [(1, bytearray(b"some words")), (2, None), (3, bytearray(b"ein paar"))]
    docs = spark.createDataFrame(rows, "doc_id long, text binary")
    learned = {"en": ["some words of a text", "some other words"], "de": ["ein paar Worte", "ein Wort"]}
    monkeypatch.setattr(langid, "LANGS_A_PASS", 1)
    got = {r["doc_id"]: r["text"] for r in langid.identified(docs, learned).collect()}
    assert got == {1: bytearray(b"some words"), 3: bytearray(b"ein paar")}
    texts = docs.withColumn("text", docs["text"].cast("string"))
    assert {r["doc_id"] for r in langid.identified(texts, learned).collect()} == {1, 3}
    assert [len(r["ids"]) > 0 for r in pieces.encode(docs, TOKENIZER).orderBy("doc_id").collect()] == [True, False, True]


def test_a_language_of_many_letters_has_its_own_bound(spark):
    slices = ["".join(chr(0x4E00 + (i * 37 + k * 11) % 400) for k in range(60)) for i in range(8)]
    learned = {"xx": slices, "en": ["some words of a text"] * 3}
    want = langid._own_rate("xx", slices)
    high = langid.bounds(spark, learned, 0.0)
    assert high["xx"] == min(1.25 * want, (1 + want) / 2)
