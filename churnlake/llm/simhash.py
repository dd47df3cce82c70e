"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, dealt, keyed, make_room, stored
from .graph import components

#: Buckets of up to so many different fingerprints are joined pair by pair; larger
#: ones are cut further by exact two-wildcard variants, which lose no link either.
PAIR_BUCKET = 32
_BLOCK = 1 << 15


def _fingerprint(text: bytes, width: int, seed: int) -> int:
    import xxhash
    h = xxhash.xxh64_intdigest
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) < width:
        return h(b" ".join(words), seed)
    ones, total = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, total, _BLOCK):
        part = words[at:at + _BLOCK + width - 1]
        hashes = np.array([h(b" ".join(s), seed) for s in zip(*(part[i:] for i in range(width)))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp): one row per row; 64-bit SimHash (as a signed long) of the whole
    text's ``width``-word shingles, repeats included. No word: 0; fewer words than
    ``width``: the whole sequence is the one shingle."""
    def run(batches):
        make_room()
        for b in batches:
            out = np.array([_fingerprint(t.as_buffer().to_pybytes(), width, seed) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out.view(np.int64))], ["doc_id", "text_key", "fp"])
    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, fp long")


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(a, b), a < b or b a member's bucket minimum: pairs of different fingerprints
    at ``bits`` (2) or fewer differing bits whose transitive closure is that of all
    such pairs. ``fps`` has distinct ``fp``.

    The 64 bits are cut into two segments of 32, so of two fingerprints at most two
    bits apart some segment differs by one bit at most. Each fingerprint is indexed
    under 64 variants: a segment with one of its bits wiped out. Equal variants
    are joined and verified. A bucket of more than ``PAIR_BUCKET`` fingerprints
    gets no pair join: its members are indexed by further wildcards (one bit of the
    other segment, or two with the first segment whole), after which all members
    of a bucket are within two bits, and each links to the smallest one."""
    if bits != 2:
        raise ValueError("two segments with one wildcard each cover two differing bits")
    slot = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot")
    seg = F.when(F.col("slot") < 32, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    wipe = F.expr("~shiftleft(1L, slot % 32)")
    variants = (fps.select("fp", slot)
                .select("fp", "slot", (F.shiftleft(F.col("slot").cast("long"), 32)
                                       .bitwiseOR(seg.bitwiseAND(wipe))).alias("key")))
    sizes = variants.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(dealt(variants).join(sizes, "key"), "simhash-buckets")
    small = shared.filter(F.col("size") <= PAIR_BUCKET).select("key", "fp")
    pairs = (dealt(small.select("key", F.col("fp").alias("a"))).join(small.select("key", F.col("fp").alias("b")), "key")
             .filter(F.col("a") < F.col("b")).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
             .select("a", "b"))
    large = shared.filter(F.col("size") > PAIR_BUCKET)
    other = "(slot < 32)"
    one = F.expr(f"shiftleft(1L, if({other}, 32 + bit, bit))")
    by_one = (large.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(31))))
              .withColumn("mask", one.bitwiseOR(F.expr("shiftleft(1L, slot)"))))
    first = large.filter("slot % 32 = 0")
    by_two = (first.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(30))))
              .withColumn("next", F.explode(F.sequence(F.col("bit") + 1, F.lit(31))))
              .withColumn("mask", F.expr(f"shiftleft(1L, if({other}, 32 + bit, bit)) | shiftleft(1L, if({other}, 32 + next, next))")))
    wild = (by_one.select("fp", "mask").union(by_two.select("fp", "mask"))
            .select("fp", "mask", F.expr("fp & ~mask").alias("rest")).distinct())
    low = wild.groupBy("mask", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    stars = wild.join(low, ["mask", "rest"]).filter("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def _groups(own: DataFrame, bits: int) -> DataFrame:
    """(fp, root): fingerprints that are linked, over any number of steps, share a root."""
    nodes = own.select("fp").distinct()
    roots = components(links(nodes, bits))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    fingerprint: 16 lowercase hex digits; component_id: smallest doc_id among the
    rows reachable over links of ``bits`` or fewer differing bits. Rows with one
    fingerprint are one node, so thousands of copies cost one row in the joins.
    Null or empty texts have fingerprint zero and link like any other. Null doc_ids
    keep their rows and never name a component unless it has no other id."""
    own = stored(fingerprints(docs, width, seed), "simhash")
    first = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    placed = _groups(own, bits).join(first, "fp")
    lowest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = placed.join(lowest, "root").select("fp", "component_id")
    return (dealt(own).join(member, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, width: int = 3, bits: int = 2, seed: int = 42) -> DataFrame:
    """One row of ``docs`` (all its columns) per group of near-duplicates: the smallest
    doc_id (a null id only if the group has no other), then the smallest text hash; rows
    that repeat both are the same document."""
    own = stored(fingerprints(docs, width, seed), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    first = own.groupBy("fp").agg(F.min(order).alias("first"))
    best = (_groups(own, bits).join(first, "fp").groupBy("root").agg(F.min("first").alias("best"))
            .select(F.xxhash64("best.doc_id", "best.text_key").alias("kept_row"), F.col("best.doc_id").alias("kept_doc"), F.col("best.text_key").alias("kept_text")))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # the caller's columns travel as one struct: their names cannot clash with those used here
    marked = (docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_doc"), key.alias("own_text"))
              .withColumn("own_row", F.xxhash64("own_doc", "own_text")))
    kept = marked.join(best, (F.col("own_row") == F.col("kept_row")) & F.col("own_doc").eqNullSafe(F.col("kept_doc")) & (F.col("own_text") == F.col("kept_text")))
    return kept.dropDuplicates(["own_row", "kept_doc", "own_text"]).select("row.*")
