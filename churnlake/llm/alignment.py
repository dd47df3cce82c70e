"""Alignment of two tokenizations of the same text.

Both tokenizers see a space and the text. Each list of ids is turned into a dictionary
from the byte offset where a token ends to its index; the offsets that both dictionaries
hold cut the two lists into groups, and inside a group the tokens whose byte ranges
overlap are linked.

Hardly any token of the two vocabularies holds white space after another character, so
both end a token at such boundaries (those of a kind that some token crosses are left out).
A text's groups are therefore those of its chunks between the boundaries, one after
another. A task tokenizes and aligns the chunks that it hasn't met lately as one text of
different chunks; documents put their groups and links together from their chunks. The
links of each id pair are then counted over the corpus and joined back."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slabs, stored, texts_of, utf8

#: Short chunks that a worker remembers (twice as many at most), and the longest one that is (characters).
MEMO, MEMO_CHARS = 200_000, 64
#: Chunks that are tokenized together, and characters of a text that are looked at together.
TOGETHER, SEGMENT = 256, 1 << 20
#: Bytes of text between two output batches.
OUT_BYTES = 1 << 21
#: Most frequent id pairs that are broadcast (24 bytes each); the others are joined.
HOT_PAIRS = 1 << 18
#: White space as both tokenizers' patterns take it (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A character outside both vocabularies: B encodes what follows it as if alone.
GUARD = "\ue000"


def byte_level() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies use: printable Latin-1
    characters stand for themselves, the other bytes for those from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in own}
    for k, b in enumerate(sorted(set(range(256)) - set(own))):
        table[chr(256 + k)] = b
    return table


def align(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int]]:
    """(tokens of A, tokens of B) up to the end of each group: the indexes that the two
    end-to-index dictionaries hold under the sorted offsets common to both."""
    at_a = {e: i + 1 for i, e in enumerate(ends_a)}
    at_b = {e: i + 1 for i, e in enumerate(ends_b)}
    return [(at_a[e], at_b[e]) for e in sorted(at_a.keys() & at_b.keys())]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, index in A, index in B) of the overlaps of two lists of tokens over the same bytes,
    in order. Every stretch between neighbouring ends of either list lies in one token of each,
    and no two such stretches lie in the same two tokens: the slices of all groups are
    expanded at once."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class Pair:
    """A byte-level tokenizer (A, a .json file) and a SentencePiece model (B)."""

    def __init__(self, json_file: str, model_file: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(json_file)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        table = byte_level()
        self.raw_a = {i: bytes(table[c] for c in piece) for piece, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if m.normalize("a  ﬁ ") != "▁a▁▁ﬁ▁":
            raise ValueError("the model changes texts before it cuts them; ends in bytes need one that does not")
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.raw_b = [bytes([int(n[3:5], 16)]) if m.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.len_a = np.zeros(max(self.raw_a) + 1, np.int64)
        self.len_a[list(self.raw_a)] = [len(r) for r in self.raw_a.values()]
        self.len_b = np.array([len(r) for r in self.raw_b], np.int64)
        # white space that some token holds after another character is no boundary
        inner = re.compile(f"[^{WHITE}]([{WHITE}])").findall
        held = {c for r in (*self.raw_a.values(), *self.raw_b) for c in inner(r.decode("utf-8", "replace"))}
        if " " in held:
            raise ValueError("a token holds a space after another character; the chunks need one that does not")
        none = "".join(held)
        on = f"(?:[{none}][{WHITE}]*[^{WHITE}]+)*(?:[{none}][{WHITE}]*\\Z)?" if held else ""
        self.cut = re.compile(f"[{WHITE}]*[^{WHITE}]+{on}|[{WHITE}]+").findall
        self.boundary = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])" + (f"(?![{none}])" if held else "")).search
        self.closed = re.compile(f"[^{WHITE}]\\Z").search
        self.guard = len(m.encode(GUARD))
        self.text_a = np.array([[f"{i}," for i in range(len(self.len_a))], [f"{i}|" for i in range(len(self.len_a))]], object)
        self.text_b = np.array([[f"{i}," for i in range(len(self.len_b))], [f"{i};" for i in range(len(self.len_b))]], object)
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def segments(self, text: str | None):
        """Lists of the chunks of space+text, about SEGMENT characters at a time. A null or empty
        text, and one with U+2581 (which B gives back as a space), has none."""
        if not text or "▁" in text:
            return
        text, at = " " + text, 0
        while at < len(text):
            hit = self.boundary(text, at + SEGMENT) if at + SEGMENT < len(text) else None
            to = hit.start() if hit else len(text)
            yield self.cut(text if to - at == len(text) else text[at:to])
            at = to

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B of a text that starts at a boundary."""
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(GUARD + text)[self.guard:]

    def records(self, parts: list[str]) -> list[tuple]:
        """(tokens of A, tokens of B, groups, text of the groups, linked id pairs as a << 32 | b) of each
        of some chunks that all end in a character that is no white space, or of a single chunk."""
        text = "".join(parts)
        raw = text.encode()
        ids_a, ids_b = self.ids(text)
        if b"".join([self.raw_a[i] for i in ids_a]) != raw or b"".join([self.raw_b[i] for i in ids_b]) != raw:
            raise ValueError("a tokenizer does not give the bytes of the text back")
        ids_a, ids_b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        to_a, to_b = np.array(align(ends_a.tolist(), ends_b.tolist())).T
        # the ids as text, those of A before those of B in each group
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[to_a - 1] = last_b[to_b - 1] = 1
        tokens = np.empty(len(ids_a) + len(ids_b), object)
        tokens[np.arange(len(ids_a)) + np.repeat(to_b - n_b, n_a)] = self.text_a[last_a, ids_a]
        tokens[np.arange(len(ids_b)) + np.repeat(to_a, n_b)] = self.text_b[last_b, ids_b]
        tokens = tokens.tolist()
        at, i, j = links(ends_a, ends_b)
        linked = (ids_a[i] << 32 | ids_b[j]).tolist()
        ends = np.cumsum([len(p.encode()) for p in parts]) if len(parts) > 1 else np.array([len(raw)])
        group = np.searchsorted(ends_a[to_a - 1], ends) + 1
        cut_a, cut_b, cut_l = to_a[group - 1], to_b[group - 1], np.searchsorted(at, ends) + 1
        size = [np.diff(c, prepend=0).tolist() for c in (cut_a, cut_b, group)]
        t, l = [0, *(cut_a + cut_b).tolist()], [0, *cut_l.tolist()]
        return [(*n, "".join(tokens[t[x]:t[x + 1]])[:-1], tuple(linked[l[x]:l[x + 1]])) for x, n in enumerate(zip(*size))]

    def known(self, parts: set[str]) -> dict[str, tuple]:
        """The records of chunks; those not met lately are tokenized together."""
        found, young, old = {}, self.young, self.old
        together, alone = [], []
        for p in parts:
            r = young.get(p)
            if r is None:
                r = old.get(p)
                if r is not None:
                    young[p] = r
            if r is not None:
                found[p] = r
            elif len(p) <= MEMO_CHARS and self.closed(p):
                together.append(p)
            else:
                alone.append(p)
        for at in range(0, len(together), TOGETHER):
            some = together[at:at + TOGETHER]
            made = dict(zip(some, self.records(some)))
            found.update(made)
            young.update(made)
        for p in alone:
            found[p] = self.records([p])[0]
        if len(young) > MEMO:
            self.old, self.young = young, {}
        return found


@lru_cache(maxsize=2)
def pair(json_file: str, model_file: str) -> Pair:
    return Pair(json_file, model_file)


ALIGNED = ("doc_id long, n_bytes long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "links array<struct<a: int, b: int, k: int>>")


def aligned(docs: DataFrame, json_file: str, model_file: str) -> DataFrame:
    """One row per row of ``docs``: its tokens, groups and links, the digest of its groups, and
    its linked id pairs with their frequencies."""
    schema = T._parse_datatype_string(ALIGNED)

    def run(batches):
        p, types = pair(json_file, model_file), to_arrow_schema(schema)
        for b in batches:
            _, offs = utf8(b.column(1))
            for i, j in slabs(offs, OUT_BYTES):
                part = b.slice(i, j - i)
                rows = _documents(p, part.column(1).to_pylist())
                counted = [r.pop() for r in rows]
                pairs = np.fromiter(chain.from_iterable(c.keys() for c in counted), np.int64)
                times = np.fromiter(chain.from_iterable(c.values() for c in counted), np.int32)
                struct = pa.StructArray.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)),
                                                     pa.array(times)], ["a", "b", "k"])
                ends = pa.array(np.cumsum([0, *map(len, counted)]), pa.int32())
                lengths = pa.array(np.diff(offs[i:j + 1]))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types.types[2:7])]
                yield pa.RecordBatch.from_arrays([part.column(0), lengths, *columns, pa.ListArray.from_arrays(ends, struct)], names=types.names)

    return texts_of(docs).mapInArrow(run, schema)


def _documents(p: Pair, texts: list[str]) -> list[list]:
    """Per text: tokens of A, of B, groups, links, digest, frequencies of the linked pairs. Texts
    of one segment are looked up together, a longer text segment by segment."""
    short = {x: next(p.segments(t), []) for x, t in enumerate(texts) if len(t) < SEGMENT}
    known = p.known(set(chain.from_iterable(short.values())))
    return [_document([(short[x], known)] if x in short else ((c, p.known(set(c))) for c in p.segments(t))) for x, t in enumerate(texts)]


def _document(segments) -> list:
    """The same for one text, from (chunks, their records) of its segments."""
    total, pairs, digest = [0, 0, 0, 0], Counter(), None
    for chunks, known in segments:
        if not chunks:
            continue
        found = [known[c] for c in chunks]
        linked = list(chain.from_iterable([r[4] for r in found]))
        pairs.update(linked)
        sizes = *(sum([r[x] for r in found]) for x in range(3)), len(linked)
        total = [a + b for a, b in zip(total, sizes)]
        text = ";".join([r[3] for r in found]).encode()
        if digest is None:
            digest = hashlib.sha256(text)
        else:
            digest.update(b";" + text)
    return [*total, digest.hexdigest() if digest else "", pairs]


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, links, best) from (a, b, k): corpus-wide links of each id pair, and whether no pair
    with its B id has more."""
    counts = stored(linked.groupBy("a", "b").agg(F.sum("k").alias("links")), "pairs")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))  # a row per id of B: bounded by its vocabulary
    return counts.join(F.broadcast(most), "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, n: str, most: int) -> Column:
    """Condition that holds for the rows with the greatest ``n``, ``most`` of them at most: a
    threshold from a histogram of a few hundred steps."""
    step = F.floor(F.log2(n) * 16).cast("int")
    least, room = None, most
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if r["count"] > room:
            break
        room -= r["count"]
        least = r["step"]
    return F.lit(False) if least is None else step >= least


def alignments(docs: DataFrame, json_file: str, model_file: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_a, n_b (tokens), n_groups, n_links,
    n_best (links whose id pair has the corpus-wide highest count of its B id, ties
    included), count_sum (sum over the links of their pair's count) and groups_sha256
    (of all groups as ``a1,a2|b1;a3|b2,b3``; empty where there are no tokens).

    Null and empty texts, and texts with U+2581 (whose pieces give other bytes back), have no
    tokens: zeros. Repeated rows count each, also in the corpus-wide counts; a null doc_id
    stays null; an empty table gives an empty result; only doc_id and text are read. A text
    of any length is looked at a segment at a time; a long stretch without white space is one
    chunk. See ``groups_of`` for the groups themselves."""
    rows = stored(aligned(docs, json_file, model_file).withColumn("row", F.monotonically_increasing_id()), "aligned")
    linked = rows.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", "l.k")
    counts = stored(pair_counts(linked), "pair-counts")
    hot = frequent(counts, "links", HOT_PAIRS)
    near = F.broadcast(counts.filter(hot))
    sums = (linked.join(near, ["a", "b"])
            .unionByName(linked.join(near.select("a", "b"), ["a", "b"], "left_anti").join(counts.filter(~hot), ["a", "b"]))
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(F.lit(0))).cast("long").alias("n_best"),
                                F.sum(F.col("k") * F.col("links")).alias("count_sum")))
    return rows.drop("links").join(sums, "row", "left").select(
        "doc_id", "n_bytes", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def groups_of(docs: DataFrame, json_file: str, model_file: str) -> DataFrame:
    """(doc_id, groups string): the groups themselves, ``a1,a2|b1;a3|b2,b3`` with decimal ids.
    Texts without tokens have an empty string."""
    def run(batches):
        p = pair(json_file, model_file)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                texts = []
                for t in part.column(1).to_pylist():
                    found = ((chunks, p.known(set(chunks))) for chunks in p.segments(t))
                    texts.append(";".join(";".join([known[c][3] for c in chunks]) for chunks, known in found))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "groups"])

    return texts_of(docs).mapInArrow(run, "doc_id long, groups string")
