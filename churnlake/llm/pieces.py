"""SentencePiece encoding and decoding with a streaming Viterbi search.

The pieces come from a public model file (a parameter). A text is a space followed
by its characters; its ids are those of the segmentation with the largest sum of
piece scores. Decoding is the exact inverse."""

from __future__ import annotations

import math
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, make_room, slabs, utf8

#: Score of one byte of a character that no piece has.
BYTE_SCORE = -20.0
#: Segments remembered per worker, and the longest one that is.
MEMO, MEMO_CHARS = 300_000, 64
#: Bytes of text encoded between two output batches.
OUT_BYTES = 1 << 21


class Pieces:
    """Vocabulary as a trie with scores. A piece ranked r scores -ln(r + 2): ranks of
    this model stand for frequencies, which by Zipf's law fall as 1/r."""

    def __init__(self, names: list[str], kinds: list[str]):
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.trie: dict = {}
        pieces, rank = [], 0
        for i, (name, kind) in enumerate(zip(names, kinds)):
            if kind == "byte":
                value = int(name[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif kind == "piece":
                text = name.replace("▁", " ")
                pieces.append(text)
                self.bytes_of.append(text.encode())
                node = self.trie
                for c in text:
                    node = node.setdefault(c, {})
                node[""] = (i, -math.log(rank + 2))
                rank += 1
            else:
                self.bytes_of.append(b"")
        self.longest = max(map(len, pieces), default=1)
        # a boundary that no piece crosses: before a space that follows something else, and around
        # line ends; between two such boundaries a segment has the same ids in every text
        crossed = any(re.search("[^ ] |\n", p) for p in pieces)
        self.segments = re.compile(r"(?s).+" if crossed else r" +[^ \n]*|\n|[^ \n]+").findall
        self.memo = _Memo(self)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def viterbi(self, text: str, longest: int | None = None) -> list[int]:
        """Ids of the best segmentation, committed while the text streams by.

        Open positions reach at most ``longest`` characters ahead. Once all surviving
        backpointer paths meet in one boundary, the ids up to it are final and the
        pointers before it are dropped. Ties: the longer last piece."""
        longest = longest or self.longest
        trie, out = self.trie, []
        # score, start and id by position; only positions from the last commit on are kept
        best: dict[int, tuple[float, int, tuple]] = {0: (0.0, -1, ())}
        done, n = 0, len(text)

        def commit(to: int, keep_from: int):
            nonlocal done
            ids, at = [], to
            while at > done:
                _, start, piece = best[at]
                ids.append(piece)
                at = start
            for p in reversed(ids):
                out.extend(p)
            for k in range(done, keep_from):
                best.pop(k, None)
            done = to

        reach, look = 0, 4 * longest
        for i in range(n):
            if i not in best:
                continue
            score = best[i][0]
            if reach <= i and i > done:  # no open path passes i: all meet here
                commit(i, i)
            elif i >= look and i - done > 4 * longest:  # else follow the open paths back until they meet
                ends = {j for j in range(i, reach + 1) if j in best}
                while len(ends) > 1:
                    j = max(ends)
                    ends.remove(j)
                    ends.add(best[j][1])
                meet = ends.pop()
                if meet > done:
                    commit(meet, meet)
                # the way back is as long as what is open: the next look is as far ahead, so that all
                # ways back together are as long as the text, also where paths never meet
                look = i + max(longest, i - done)
            node, j, whole = trie, i, False
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                hit = node.get("")
                if hit:
                    whole = whole or j == i + 1
                    s = score + hit[1]
                    if j not in best or s > best[j][0]:
                        best[j] = (s, i, (hit[0],))
                    if j > reach:
                        reach = j
            if not whole:  # the single character is no piece: its bytes
                raw = text[i].encode()
                s = score + BYTE_SCORE * len(raw)
                if i + 1 not in best or s > best[i + 1][0]:
                    best[i + 1] = (s, i, tuple(self.byte_ids[x] for x in raw))
                if i + 1 > reach:
                    reach = i + 1
        if n:
            commit(n, n)
        return out

    def short(self, text: str) -> list[int]:
        """The same for a text within the distance at which ``viterbi`` first looks for a meeting
        point: all of it is open until its end."""
        trie, n = self.trie, len(text)
        score, back, ids = [0.0] + [-math.inf] * n, [0] * (n + 1), [()] * (n + 1)
        for i in range(n):
            base = score[i]
            if base == -math.inf:
                continue
            node, j, whole = trie, i, False
            for c in text[i:i + self.longest]:
                node = node.get(c)
                if node is None:
                    break
                j += 1
                hit = node.get("")
                if hit is not None:
                    if j == i + 1:
                        whole = True
                    s = base + hit[1]
                    if s > score[j]:
                        score[j], back[j], ids[j] = s, i, (hit[0],)
            if not whole:  # the single character is no piece: its bytes
                raw = text[i].encode()
                s = base + BYTE_SCORE * len(raw)
                if s > score[i + 1]:
                    score[i + 1], back[i + 1], ids[i + 1] = s, i, tuple(self.byte_ids[x] for x in raw)
        out, at = [], n
        while at:
            out.append(ids[at])
            at = back[at]
        return [x for piece in reversed(out) for x in piece]

    def encode_raw(self, text: str | None) -> bytes:
        """The ids as 32-bit integers, one after another; none for a null text."""
        return b"".join(map(self.memo.__getitem__, self.segments(" " + text))) if text else b""

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_raw(text), np.int32).tolist()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw[1:].decode("utf-8", "replace")

    def decode_rows(self, lists: pa.ListArray) -> pa.Array:
        """Texts of many id lists: the bytes of all pieces are gathered at once."""
        counts = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id is not in the vocabulary")
        n = self.lengths[ids]
        ends = np.cumsum(n)
        raw = self.blob[np.arange(int(n.sum())) + np.repeat(self.starts[ids] - (ends - n), n)]
        offs = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        full = offs[1:] > offs[:-1]
        keep = np.ones(len(raw), bool)
        keep[offs[:-1][full]] = False  # the space that stands before each text
        raw, offs = raw[keep], offs - np.append(0, np.cumsum(full))
        try:
            raw.tobytes().decode()
        except UnicodeDecodeError:  # ids that no text has
            return pa.array([None if x is None else self.decode(x) for x in lists.to_pylist()], pa.string())
        out = pa.StringArray.from_buffers(len(lists), pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes()))
        return pc.if_else(lists.is_valid(), out, None) if lists.null_count else out


class _Memo(dict):
    """Ids (as bytes) of the segments met so far, MEMO short ones at most."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, part: str) -> bytes:
        p = self.pieces
        ids = array("i", p.short(part) if len(part) <= 4 * p.longest else p.viterbi(part)).tobytes()
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[part] = ids
        return ids


@kept(2)
def _pieces(names: tuple, kinds: tuple) -> Pieces:
    return Pieces(list(names), list(kinds))


@lru_cache(maxsize=4)
def vocabulary(model_file: str) -> tuple[tuple, tuple]:
    """(names, kinds) of a SentencePiece model file: kinds are piece, byte or other.
    Pieces that hold the space mark together with other marks keep their place."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = m.get_piece_size()
    return (tuple(m.id_to_piece(i) for i in range(n)),
            tuple("byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) else "piece" for i in range(n)))


def _shared(spark: SparkSession, model_file: str):
    return spark.sparkContext.broadcast(vocabulary(model_file))


def encode(docs: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``docs`` (all its columns) with an array<int> column ``ids`` of the whole text's
    piece ids. Null and empty texts have no ids. Characters outside the vocabulary,
    and a literal U+2581, become byte pieces, so every text comes back exactly."""
    spark = docs.sparkSession
    voc = _shared(spark, model_file)
    out = "encoded_piece_ids"
    n, places = len(docs.columns), [i for i, f in enumerate(docs.schema.fields) if f.name == "text" and isinstance(f.dataType, T.StringType)]
    # a string column is sent to the workers once; another kind is cast into a last column
    rows, k = (docs, places[0]) if len(places) == 1 else (docs.withColumn(out, F.col("text").cast("string")), n)

    def run(batches):
        make_room(_pieces)
        p = _pieces(*voc.value)
        for b in batches:
            _, offs = utf8(b.column(k))
            for i, j in slabs(offs, OUT_BYTES):
                part = b.slice(i, j - i)
                each = [p.encode_raw(t) for t in part.column(k).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in each)])
                flat = np.frombuffer(b"".join(each), np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                                                 names=[*b.schema.names[:n], out])

    schema = T.StructType(docs.schema.fields[:n]).add(out, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema).drop(ids).withColumnRenamed(out, ids)


def decode(rows: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` (all columns) with a string column ``text`` decoded from ``ids``. Null ids: null;
    unknown and control ids add nothing. Ids outside the vocabulary raise an error."""
    spark = rows.sparkSession
    voc = _shared(spark, model_file)
    out = "decoded_piece_text"

    def run(batches):
        make_room(_pieces)
        p = _pieces(*voc.value)
        for b in batches:
            step = 256
            for at in range(0, len(b), step):
                part = b.slice(at, step)
                yield pa.RecordBatch.from_arrays([*part.columns, p.decode_rows(part.column(ids))], names=[*b.schema.names, out])

    schema = T.StructType(list(rows.schema.fields)).add(out, T.StringType())
    return rows.mapInArrow(run, schema).drop(text).withColumnRenamed(out, text)
