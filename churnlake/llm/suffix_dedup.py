"""Exact substring deduplication by a hash-compared suffix sort.

A string of ``span`` bytes that starts at two places has, in both, the same
smallest hash among its ``gram``-byte substrings (its anchor), at the same offset.
So only anchors are compared across the corpus: a string whose anchor is unique
is unique. Suffixes that share an anchor and an offset are sorted by mergesort;
a comparison finds the common extension of two suffixes by binary search over
prefix polynomial hashes, and neighbours with ``span`` common bytes are compared
byte by byte before they count. Whole contexts that stand more than once (copies) are
verified by a second hash of all their bytes that is independent of the first."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import keyed, mix64, prefix_hash, slabs, span_hash, stored, utf8

#: Window starts handled in one numpy step; positions inside fit the low bits of a packed hash.
_STEP_BITS = 20
_STEP = (1 << 19)
#: Different contexts of one anchor that one task sorts together (some 150 MB); an anchor with
#: more is dealt out, and the sorted parts are merged by window.
SORT_ROWS = 8192
#: Window starts sorted in one numpy step.
_CHUNK = 200_000


def _windows(offsets: np.ndarray, span: int):
    """(first, last, base): byte ranges to hash and the rows they cover, of at most ``_STEP``
    window starts; a long row is cut with an overlap of span - 1 bytes."""
    for i, j in slabs(offsets, _STEP):
        if offsets[j] - offsets[i] <= _STEP + span:
            yield int(offsets[i]), int(offsets[j]), i, j
        else:
            for at in range(int(offsets[i]), int(offsets[j]) - span + 1, _STEP):
                yield at, min(at + _STEP + span - 1, int(offsets[j])), i, j


def anchors(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(doc_id, text_key, lo, hi, at, gram_hash, context): the window starts lo..hi
    of a row (bytes) whose anchor is ``at`` bytes after lo. context: XXH3 of the bytes
    [lo, hi + span) with ``at``, a hash of another kind than the polynomial gram_hash, so
    text made to collide under one (Thue-Morse words) differs under the other; rows equal
    in both repeat every window in them."""
    width = span - gram + 1

    def run(batches):
        for b in batches:
            buf, offs = utf8(b.column(2))
            raw = memoryview(np.ascontiguousarray(buf))
            cols = [[] for _ in range(6)]
            for s, e, i, j in _windows(offs, span):
                n = e - s - span + 1
                if n <= 0:
                    continue
                p = prefix_hash(buf[s:e])
                h = mix64(span_hash(p, np.arange(e - s - gram + 1), np.arange(gram, e - s + 1)))
                x = (h >> np.uint64(_STEP_BITS) << np.uint64(_STEP_BITS)) | np.arange(len(h), dtype=np.uint64)
                size = 1
                while size * 2 <= width:
                    x = np.minimum(x[:-size], x[size:])
                    size *= 2
                if size < width:
                    x = np.minimum(x[:len(x) - (width - size)], x[width - size:])
                at = (x & np.uint64((1 << _STEP_BITS) - 1)).astype(np.int64)[:n]
                start = np.arange(s, s + n)
                row = np.searchsorted(offs, start, side="right") - 1
                ok = start + span <= offs[row + 1]
                cut = np.ones(n, bool)
                cut[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (ok[1:] != ok[:-1])
                lo = np.flatnonzero(cut)
                hi = np.append(lo[1:], n) - 1
                good = ok[lo]
                lo, hi = lo[good], hi[good]
                a = at[lo]
                ctx = np.array([xxh3_64_intdigest(raw[s + i:s + j], k) for i, j, k in
                                zip(lo.tolist(), (hi + span).tolist(), (a - lo).tolist())], np.uint64)
                for c, v in zip(cols, (row[lo], s + lo - offs[row[lo]], s + hi - offs[row[lo]], a - lo, h[a].view(np.int64), ctx.view(np.int64))):
                    c.append(v)
            row, lo, hi, at, h, ctx = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
            ids = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(ids), b.column(1).take(ids), pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(h), pa.array(ctx)],
                                             ["doc_id", "text_key", "lo", "hi", "at", "gram_hash", "context"])

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, lo long, hi long, at int, gram_hash long, context long")


class _Suffixes:
    """Suffixes of one byte buffer, compared by hashes."""

    def __init__(self, buf: np.ndarray, span: int):
        self.buf, self.span = buf, span
        self.prefix = prefix_hash(buf)
        pad = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.head = np.zeros(len(buf) + 1, np.uint64)  # the next 8 bytes, most significant first
        for k in range(8):
            self.head |= pad[k:k + len(buf) + 1] << np.uint64(56 - 8 * k)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, ``span`` at most: binary
        search for the longest prefix with equal hashes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.span)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            same = span_hash(self.prefix, x, x + mid) == span_hash(self.prefix, y, y + mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def compare(self, x: np.ndarray, y: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for suffix x against y over ``span`` bytes. ``whole`` has each
        suffix's window hash; most others differ in the first eight bytes."""
        out = np.zeros(len(x), np.int8)
        todo = np.flatnonzero(whole[0] != whole[1])
        a, b = self.head[x[todo]], self.head[y[todo]]
        out[todo] = np.where(a < b, -1, 1)
        todo = todo[a == b]
        if len(todo):
            ext = self.extension(x[todo], y[todo])
            full = ext >= self.span
            a = self.buf[np.minimum(x[todo] + ext, len(self.buf) - 1)]
            b = self.buf[np.minimum(y[todo] + ext, len(self.buf) - 1)]
            out[todo] = np.where(full, 0, np.where(a < b, -1, 1))
        return out


def merge_sort(suffixes: _Suffixes, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes at ``start``: by group, then by their next ``span`` bytes.
    Bottom-up mergesort of all groups at once: in each round every suffix finds its
    rank in the neighbouring run by binary search, which takes log2(run) comparisons."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    sizes = np.diff(np.append(first, len(g)))
    base = np.repeat(first, sizes)
    room = np.repeat(sizes, sizes)
    local = np.arange(len(g)) - base
    whole = mix64(span_hash(suffixes.prefix, start, start + suffixes.span))
    run = 1
    while (sizes > run).any():
        live = np.flatnonzero(room > run)
        pos, b, size = local[live], base[live], room[live]
        own = pos // run
        left = own % 2 == 0
        other = np.where(left, own + 1, own - 1) * run
        n = np.clip(size - other, 0, run)
        low, high = np.zeros(len(live), np.int64), n.copy()
        e = order[live]
        while True:
            k = np.flatnonzero(low < high)
            if not len(k):
                break
            mid = (low[k] + high[k]) // 2
            o = order[b[k] + other[k] + mid]
            c = suffixes.compare(start[o], start[e[k]], (whole[o], whole[e[k]]))
            before = np.where(left[k], c < 0, c <= 0)  # siblings that stand before this suffix
            low[k] = np.where(before, mid + 1, low[k])
            high[k] = np.where(before, high[k], mid)
        to = b + (own - own % 2) * run + pos % run + low
        order[to] = e
        run *= 2
    return order


def _classes(buf: np.ndarray, start: np.ndarray, group: np.ndarray, row: np.ndarray, span: int):
    """(order, class): suffixes in sorted order and a class number for each, equal for
    neighbours whose next ``span`` bytes are the same, byte by byte."""
    s = _Suffixes(buf, span)
    order = merge_sort(s, start, group)
    g, at = group[order], start[order]
    near = np.flatnonzero(g[1:] == g[:-1])
    same = np.zeros(len(order), bool)
    ext = s.compare(at[near], at[near + 1], (mix64(span_hash(s.prefix, at[near], at[near] + span)), mix64(span_hash(s.prefix, at[near + 1], at[near + 1] + span)))) == 0
    near = near[ext]
    # windows that follow each other in the same two rows are verified as one range
    x, y = at[near], at[near + 1]
    by = np.lexsort((x, y - x))
    x, y, near = x[by], y[by], near[by]
    raw = buf.tobytes()
    cuts = np.flatnonzero(np.append(True, (np.diff(x) != 1) | (np.diff(y) != 1)))
    for i, j in zip(cuts, np.append(cuts[1:], len(x))):
        a, b, n = int(x[i]), int(y[i]), int(x[j - 1]) - int(x[i]) + span
        if raw[a:a + n] == raw[b:b + n]:
            same[near[i:j] + 1] = True
        else:  # a hash collision: each window is looked at by itself
            for k in range(i, j):
                same[near[k] + 1] = raw[x[k]:x[k] + span] == raw[y[k]:y[k] + span]
    return order, np.cumsum(~same), s


def _sort_parts(batches, span: int):
    """Sorts the suffixes of each part (rows in order of part) and yields, per context,
    runs of window starts found twice (one to last, no hashes) and, where an anchor
    has several parts, one start per class with two hashes of its bytes, to be merged."""
    held: list[pa.Table] = []

    def solve(t: pa.Table):
        t = t.combine_chunks()
        part = t.column("gram_hash").to_numpy().astype(np.int64)
        piece = t.column("part").to_numpy()
        ctx = t.column("context").to_numpy()
        keep = np.ones(len(part), bool)  # repeated rows bring the same context again
        keep[1:] = (part[1:] != part[:-1]) | (piece[1:] != piece[:-1]) | (ctx[1:] != ctx[:-1])
        t = t.filter(pa.array(keep))
        part, piece, ctx = part[keep], piece[keep], ctx[keep]
        at, count = t.column("at").to_numpy().astype(np.int64), t.column("windows").to_numpy().astype(np.int64)
        parts = t.column("parts").to_numpy()
        buf, offs = utf8(t.column("bytes").combine_chunks())
        base = offs[0]
        buf, offs = buf[offs[0]:offs[-1]], offs - base
        bucket = np.cumsum(np.append(False, (part[1:] != part[:-1]) | (piece[1:] != piece[:-1])))
        row = np.repeat(np.arange(len(part)), count)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = offs[row] + shift
        group = bucket[row] * (1 << 20) + (at[row] - shift)
        order, cls, s = _classes(buf, start, group, row, span)
        n = np.bincount(cls)
        twice = np.zeros(len(row), bool)
        twice[order] = n[cls] > 1
        d = np.flatnonzero(twice)
        new = np.ones(len(d), bool)
        new[1:] = (np.diff(d) != 1) | (row[d[1:]] != row[d[:-1]])
        f = np.flatnonzero(new)
        last = np.append(f[1:], len(d)) - 1
        r0, p0, p1 = row[d[f]] if len(d) else d, shift[d[f]] if len(d) else d, shift[d[last]] if len(d) else d
        lead = order[np.append(True, cls[1:] != cls[:-1])] if len(order) else order
        lead = lead[parts[row[lead]] > 1]
        w = mix64(span_hash(s.prefix, start[lead], start[lead] + span))
        v = [int.from_bytes(hashlib.blake2b(buf[i:i + span], digest_size=8).digest(), "little", signed=True) for i in start[lead]]
        r = np.concatenate([r0, row[lead]]).astype(np.int64)
        none = np.concatenate([np.ones(len(r0), bool), np.zeros(len(lead), bool)])
        pad = np.zeros(len(r0), np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(part[r]), pa.array(ctx[r]),
            pa.array(np.concatenate([p0, shift[lead]]).astype(np.int64)), pa.array(np.concatenate([p1, shift[lead]]).astype(np.int64)),
            pa.array(np.concatenate([pad, w.view(np.int64)]), mask=none), pa.array(np.concatenate([pad, np.array(v, np.int64)]), mask=none)],
            ["gram_hash", "context", "from", "to", "w", "v"])

    size = 0
    for b in batches:
        held.append(pa.Table.from_batches([b]))
        size += sum(b.column("windows").to_pylist())
        if size >= _CHUNK:
            t = pa.concat_tables(held)
            h, p = t.column("gram_hash").to_numpy(), t.column("part").to_numpy()
            change = np.flatnonzero((h[1:] != h[:-1]) | (p[1:] != p[:-1])) + 1
            if not len(change):
                held = [t]
                continue
            counts = np.cumsum(t.column("windows").to_numpy())
            done = 0
            while True:  # whole parts, about _CHUNK windows at a time
                past = counts[done - 1] if done else 0
                ready = change[change > done]
                if not len(ready) or counts[ready[-1] - 1] - past < _CHUNK:
                    break
                to = int(ready[np.searchsorted(counts[ready - 1], past + _CHUNK)])
                yield solve(t.slice(done, to - done))
                done = to
            held = [t.slice(done)]
            size = int(counts[-1] - (counts[done - 1] if done else 0))
    t = pa.concat_tables(held) if held else None
    if t is not None and len(t):
        yield solve(t)


def repeated_starts(docs: DataFrame, span: int = 400, gram: int = 200) -> DataFrame:
    """(doc_id, text_key, lo, hi): every run of window starts whose next ``span`` bytes
    also start anywhere else in the corpus."""
    rows = keyed(docs)
    marks = anchors(docs, span, gram)
    # written first: next to a plain exchange on either side, Spark can split an anchor that stands very often
    known = stored(marks.groupBy("gram_hash").agg(F.count("*").alias("n")).filter("n > 1").select("gram_hash"), "suffix-repeated")
    # everything below works on anchors that stand at two places at least
    some = stored(marks.join(known, "gram_hash"), "suffix-anchors")
    group = (some.groupBy("gram_hash", "context")
             .agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key", "lo", "hi", "at")).alias("one")))
    group = stored(group, "suffix-contexts")
    bucket = (group.groupBy("gram_hash").agg(F.count("*").alias("kinds")).filter("kinds > 1")
              .withColumn("parts", F.ceil(F.col("kinds") / SORT_ROWS).cast("int")))
    wanted = (group.join(bucket, "gram_hash")
              .select("gram_hash", "context", "one.*", "parts",
                      F.pmod(F.xxhash64("context"), F.col("parts")).cast("int").alias("part")))
    per_row = (wanted.groupBy("doc_id", "text_key")
               .agg(F.collect_list(F.struct("gram_hash", "context", "lo", "hi", "at", "parts", "part")).alias("want")))
    from_text = rows.alias("d").join(per_row.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_key") == F.col("w.text_key")))
    cut = (from_text.select(F.encode("d.text", "UTF-8").alias("raw"), F.explode("w.want").alias("x"))
           .select("x.gram_hash", "x.part", "x.context", "x.parts", "x.at", (F.col("x.hi") - F.col("x.lo") + 1).cast("int").alias("windows"),
                   F.expr(f"substring(raw, cast(x.lo + 1 as int), cast(x.hi - x.lo + {span} as int))").alias("bytes")))
    dealt = cut.repartition("gram_hash", "part").sortWithinPartitions("gram_hash", "part", "context")
    found = stored(dealt.mapInArrow(lambda it: _sort_parts(it, span),
                                    "gram_hash long, context long, `from` long, `to` long, w long, v long"), "suffix-sorted")
    open_ = found.filter("w is not null")
    again = open_.groupBy("gram_hash", "w", "v").agg(F.count("*").alias("n")).filter("n > 1").select("gram_hash", "w", "v")
    part_hits = found.filter("w is null").select("gram_hash", "context", "from", "to")
    hits = part_hits.union(open_.join(again, ["gram_hash", "w", "v"]).select("gram_hash", "context", "from", "to"))
    hits = hits.groupBy("gram_hash", "context").agg(F.collect_list(F.struct(F.col("from").alias("p"), F.col("to").alias("q"))).alias("hit"))
    copies = group.select("gram_hash", "context", "copies")
    state = copies.join(hits, ["gram_hash", "context"], "left").filter("copies > 1 or hit is not null")
    placed = some.join(state, ["gram_hash", "context"])
    whole = placed.filter("copies > 1").select("doc_id", "text_key", "lo", "hi")
    partly = (placed.filter("copies = 1").select("doc_id", "text_key", "lo", F.explode("hit").alias("h"))
              .select("doc_id", "text_key", (F.col("lo") + F.col("h.p")).alias("lo"), (F.col("lo") + F.col("h.q")).alias("hi")))
    return whole.union(partly)


def _merge(starts, span: int):
    """Disjoint removed byte runs of sorted window-start runs."""
    out: list[list[int]] = []
    for lo, hi in starts:
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + span)
        else:
            out.append([lo, hi + span])
    return out


def dedup(docs: DataFrame, span: int = 400, gram: int = 200, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), one row per row.

    Every byte covered by a ``span``-byte string (UTF-8) that also starts anywhere
    else in ``docs``, the same row included, is removed; overlaps count, and strings
    are judged on the input. Null text is empty; a repeated row repeats all its strings,
    so both rows lose them. ``kept`` (binary) holds the remaining bytes."""
    rows = keyed(docs)
    spans = (repeated_starts(docs, span, gram).groupBy("doc_id", "text_key")
             .agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))
    both = (rows.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key")), "left")
            .select("d.doc_id", F.expr("transform(array_sort(runs), x -> x.lo)").alias("lo"), F.expr("transform(array_sort(runs), x -> x.hi)").alias("hi"), "d.text"))

    def run(batches):
        for b in batches:
            buf, offs = utf8(b.column(3))
            lows, highs = b.column(1).to_pylist(), b.column(2).to_pylist()
            n, gone, count, sha, kept = [], [], [], [], []
            for k in range(len(b)):
                raw = buf[offs[k]:offs[k + 1]].tobytes()
                cut = _merge(zip(lows[k] or (), highs[k] or ()), span)
                left, at = [], 0
                for i, j in cut:
                    left.append(raw[at:i])
                    at = j
                left = b"".join([*left, raw[at:]])
                n.append(len(raw))
                gone.append(len(raw) - len(left))
                count.append(len(cut))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else b"")
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * with_text, names + ["kept"] * with_text)

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
