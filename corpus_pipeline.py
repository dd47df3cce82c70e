"""Corpus pipeline over ``documents``: language identification, line dedup, near-dedup,
benchmark decontamination, SentencePiece ids. Each stage takes (spark, docs, sf_dir);
its result is written as Parquet and reread as the next one's docs. All but the last
return the columns of their docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import decontaminate, langid, line_dedup, pieces, simhash
from churnlake.llm.common import stored
from churnlake.llm.queries import TOKENIZER, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and texts that no learned language explains."""
    return langid.identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines; a document that loses all its lines goes."""
    return line_dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    return simhash.representatives(docs, width=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of a benchmark item, re-parameterised ones included."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of the whole text, and whether they decode to it exactly. The ids are
    written between: coding and decoding in one task would take two Python workers for each core,
    which Spark keeps and deals all later tasks out to."""
    coded = stored(pieces.encode(docs, TOKENIZER, "piece_ids"), "pipeline-piece-ids")
    back = pieces.decode(coded, TOKENIZER, "piece_ids", "piece_text")
    return (back.withColumn("n_piece_ids", F.size("piece_ids").cast("long"))
            .withColumn("round_trip", F.col("piece_text") == F.coalesce("text", F.lit(""))).drop("piece_text"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: SQL cannot express the stages; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
