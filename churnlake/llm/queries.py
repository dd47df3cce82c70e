"""One query per operator, over its whole intended table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, brown_lm, decontaminate, langid, line_dedup, nn_descent, periodic, pieces, secret_scan, simhash,
               suffix_dedup, token_counts, toxicity)

#: The public tokenizers that op9, op11 and op13 use; never copied into the repository.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Tokens over which op13 marks a document.
TOKEN_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_brown_lm(spark, sf_dir):
    return brown_lm.brown_scores(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark, sf_dir):
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", "n_windows", "item_id")


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), span=400, gram=200)


def op4_nn_descent(spark, sf_dir):
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0", top=20)


def op5_line_dedup(spark, sf_dir):
    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.coalesce("kept_text", F.lit("")).alias("kept_text"))


def op6_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, bits=2, seed=42)


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark, sf_dir):
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)
    back = pieces.decode(coded, TOKENIZER)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark, sf_dir):
    """Groups and links between the tokens of both vocabularies, per document (see ``alignment.alignments``)."""
    out = alignment.alignments(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, TOKENIZER)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the hash of its id, is made periodic from one of its words on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark, sf_dir):
    """Digests of the periodic runs of every document and of its text without their repeats (see
    ``periodic.periodic_runs``). Without a run the four columns of the greatest run are null."""
    out = periodic.periodic_runs(table(spark, sf_dir, "documents"), planted_period)
    greatest = F.aggregate("runs", F.element_at(F.slice("runs", 1, 1), 1), lambda m, r: F.when(
        r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    best = F.when(F.size("runs") > 0, greatest)
    return (out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_token_counts(spark, sf_dir):
    """Tokens of every document, and whether they are over the limit (see ``token_counts.token_counts``)."""
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES = {f.__name__: f for f in (
    op1_brown_lm, op2_benchmark_decontamination, op3_suffix_dedup, op4_nn_descent, op5_line_dedup,
    op6_language_id, op7_simhash_near_dedup, op8_toxicity, op9_sentencepiece, op10_secret_scan,
    op11_cross_tokenizer_alignment, op12_periodic_runs, op13_token_counts)}

#: DuckDB text where SQL can express the operator.
ORACLE: dict[str, str] = {"op5_line_dedup": line_dedup.oracle()}
