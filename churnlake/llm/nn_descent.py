"""Approximate nearest neighbours by inner product: an NN-descent graph built with
joins of neighbours of neighbours, and greedy graph search for the queries.

Vectors get one more coordinate that gives all the same length, so the largest
inner product with a query is the smallest angle. Equal vectors are one node."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, stored

#: Neighbours kept per node, and how many nodes that list a node join its neighbourhood.
DEGREE, REVERSE = 32, 24
#: Start: so many random orders (by hyperplane signs), cut into blocks of so many nodes,
#: and the neighbours that a block gives each of its nodes.
ORDERS, BLOCK, BLOCK_NEAR = 16, 384, 14
#: Nodes (as powers of two) whose neighbourhoods are compared together in the graph's rounds, and
#: searched together: a vector is sent once to each block that needs it.
CENTERS, AREA = 8, 13
#: Rounds of neighbours of neighbours at most, and the share of changed entries that ends them.
ROUNDS, SETTLED = 4, 0.02
#: Search: pool per query, nodes expanded per round, rounds at most.
POOL, EXPAND, SEARCH_ROUNDS = 320, 64, 5


def usable(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id long, v array<double>) without null ids, and without vectors that are null, empty,
    all zero or hold a null or non-finite component. Vectors of another length than the
    most frequent one (ties: the longer) take no part either. One row per (id, vector)."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(good)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    dims = [r["d"] for r in size.collect()]
    return rows.filter(F.size("v") == (dims[0] if dims else 0))


def _matrix(col) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _raw(m: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(m)], pa.binary())


def _floats(col) -> np.ndarray:
    """(rows, dims) float32 of a binary column of equal-length rows of float16."""
    if not len(col):
        return np.zeros((0, 1), np.float32)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int32)[col.offset:col.offset + len(col) + 1]
    x = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(x.tobytes(), np.float16).reshape(len(col), -1).astype(np.float32)


def nodes_of(vectors: DataFrame, keep: int) -> DataFrame:
    """(node, ids, v): one row per different vector. ids: its ``keep`` smallest ids; node: the
    smallest. Each batch first keeps its own smallest ids of a vector, so a vector that
    a third of all rows share brings few to the final aggregate."""
    def thin(batches):
        for b in batches:
            m = _matrix(b.column(1)) + 0.0  # -0.0 is 0.0
            ids = b.column(0).to_numpy(zero_copy_only=False)
            of: dict[bytes, list] = {}
            for i in np.argsort(ids, kind="stable"):
                own = of.setdefault(m[i].tobytes(), [])
                if len(own) < keep and (not own or own[-1] != ids[i]):
                    own.append(int(ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(list(of.values()), pa.list_(pa.int64())), pa.array(list(of), pa.binary())], ["ids", "raw"])

    part = vectors.mapInArrow(thin, "ids array<long>, raw binary")
    return (part.groupBy("raw").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))
            .select(F.col("ids")[0].alias("node"), "ids", "raw"))


def _unit(nodes: DataFrame) -> DataFrame:
    """(node, x): vectors of length 1, one coordinate longer. Half precision halves what the joins
    move; it only steers the graph, results are measured on the original vectors."""
    def norms(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([max((float((np.frombuffer(r.as_buffer(), np.float64) ** 2).sum()) for r in b.column(0)), default=0.0)])], ["top"])

    top = nodes.select("raw").mapInArrow(norms, "top double").agg(F.max("top")).collect()[0][0] or 1.0

    def run(batches):
        for b in batches:
            v = np.array([np.frombuffer(r.as_buffer(), np.float64) for r in b.column(1)]).reshape(len(b), -1)
            rest = np.sqrt(np.maximum(top - (v * v).sum(1, keepdims=True), 0.0))
            yield pa.RecordBatch.from_arrays([b.column(0), _raw((np.hstack([v, rest]) / np.sqrt(top)).astype(np.float16))], ["node", "x"])

    return nodes.select("node", "raw").mapInArrow(run, "node long, x binary")


_PAIR = "a long, b long, sim float"


def _top(a, b, sim, k):
    """The k best b of each a, without repeats."""
    by = np.lexsort((-sim, b, a))
    a, b, sim = a[by], b[by], sim[by]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, sim = a[new], b[new], sim[new]
    by = np.lexsort((b, -sim, a))
    a, b, sim = a[by], b[by], sim[by]
    first = np.searchsorted(a, a)
    ok = np.arange(len(a)) - first < k
    return a[ok], b[ok], sim[ok]


def _coded(batches, orders: int):
    """(code, node, x) for each random order: the signs of the vector against 30 random hyperplanes."""
    for b in batches:
        x = _floats(b.column(1))
        for order in range(orders):
            planes = np.random.default_rng(1000 + order).standard_normal((x.shape[1], 30))
            bits = (x @ planes > 0).astype(np.int64) @ (1 << np.arange(30, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(bits + (order << 30)), b.column(0), b.column(1)], ["code", "node", "x"])


def blocks(units: DataFrame) -> DataFrame:
    """(node, number, x): nodes numbered along one random order, without gaps. The high bits of a number
    name the node's block, so no join is needed to tell it, and every block but the last is full,
    however many partitions the rows are dealt to."""
    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(np.full(len(b), part)), pa.array(at + np.arange(len(b))), b.column(2)], ["node", "part", "at", "x"])
            at += len(b)

    order = units.mapInArrow(lambda it: _coded(it, 1), "code long, node long, x binary")
    placed = stored(order.repartitionByRange("code", "node").sortWithinPartitions("code", "node")
                    .mapInArrow(run, "node long, part long, at long, x binary"), "ann-places")
    sizes = sorted(placed.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row a partition
    before, rows = 0, []
    for r in sizes:
        rows.append((r["part"], before))
        before += r["n"]
    first = units.sparkSession.createDataFrame(rows, "part long, before long")
    return placed.join(F.broadcast(first), "part").select("node", (F.col("before") + F.col("at")).alias("number"), "x")


def _block(node: str, bits: int):
    return F.shiftright(F.col(node), bits)


def _start(units: DataFrame) -> DataFrame:
    """Pairs (a, b, sim) within blocks of nodes that are neighbours in some random order:
    sorted by the signs against random hyperplanes, then cut every BLOCK rows. Blocks
    have a fixed size, so clusters and hot spots cannot overfill one."""
    def near(batches):
        ids, vecs = [], []

        def solve(n):
            i, x = np.concatenate(ids), np.concatenate(vecs)
            ids[:], vecs[:] = [i[n:]], [x[n:]]
            i, one = np.unique(i[:n], return_index=True)  # where two orders meet, a node may be there twice
            x, n = x[:n][one], len(one)
            s = x @ x.T
            np.fill_diagonal(s, -2.0)
            k = min(BLOCK_NEAR, n - 1)
            if k < 1:
                return None
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            a = np.repeat(i, k)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(i[best].ravel()), pa.array(np.take_along_axis(s, best, 1).ravel().astype(np.float32))], ["a", "b", "sim"])

        for b in batches:
            ids.append(b.column(1).to_numpy())
            vecs.append(_floats(b.column(2)))
            while sum(map(len, ids)) >= 2 * BLOCK:
                if (out := solve(BLOCK)) is not None:
                    yield out
        if sum(map(len, ids)) > 1:
            out = solve(sum(map(len, ids)))
            if out is not None:
                yield out

    spread = units.mapInArrow(lambda it: _coded(it, ORDERS), "code long, node long, x binary")
    # range partitions are in order, so a partition holds whole stretches of an order
    # (a small table is one partition, so that no node stands alone)
    parts = min(max(1, units.count() * ORDERS // 4096), int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.repartitionByRange(parts, "code", "node").sortWithinPartitions("code", "node").mapInArrow(near, _PAIR)


def _by_center(rows: DataFrame, solve, schema: str) -> DataFrame:
    """``solve`` gets a table with whole centers (column ``center``), a few thousand rows at a time."""
    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) >= 4096:
                c = held.column("center").to_numpy()
                at = int(np.searchsorted(c, c[-1]))
                if at:
                    yield from solve(held.slice(0, at).combine_chunks())
                    held = held.slice(at)
        if held is not None and len(held):
            yield from solve(held.combine_chunks())
    return rows.repartition("center").sortWithinPartitions("center").mapInArrow(run, schema)


def _best(pairs: DataFrame, degree: int) -> DataFrame:
    """(a, b, sim, fresh) with the ``degree`` best b of each a; fresh: not known before."""
    def solve(t):
        a, b, sim, fresh = (t.column(c).to_numpy() for c in ("center", "b", "sim", "fresh"))
        by = np.lexsort((fresh, b, a))  # an old entry stands before the same pair found anew
        a, b, sim, fresh = a[by], b[by], sim[by], fresh[by]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        a, b, sim, fresh = a[new], b[new], sim[new], fresh[new]
        by = np.lexsort((b, -sim, a))
        a, b, sim, fresh = a[by], b[by], sim[by], fresh[by]
        ok = np.arange(len(a)) - np.searchsorted(a, a) < degree
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok]), pa.array(sim[ok]), pa.array(fresh[ok])], ["a", "b", "sim", "fresh"])
    return _by_center(pairs.withColumnRenamed("a", "center"), solve, _PAIR + ", fresh boolean")


def graph(units: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(a, b, sim): the neighbour graph by NN-descent. In each round the neighbours of a
    node, and some of the nodes that list it, are compared with each other; a pair
    counts if one of the two is new there and it beats the other's worst neighbour."""
    pairs = _start(units).withColumn("fresh", F.lit(True))
    edges = stored(_best(pairs, degree), "ann-graph-0")
    total = edges.count()
    for k in range(rounds):
        worst = edges.groupBy(F.col("a").alias("member")).agg(F.min("sim").alias("worst"), F.count("*").alias("have"))
        ahead = edges.select(F.col("a").alias("center"), F.col("b").alias("member"), "fresh")
        back = W.partitionBy("b").orderBy(F.desc("fresh"), F.xxhash64("a"))
        behind = (edges.withColumn("r", F.row_number().over(back)).filter(F.col("r") <= REVERSE)
                  .select(F.col("b").alias("center"), F.col("a").alias("member"), "fresh"))
        at = stored(ahead.union(behind).withColumn("block", _block("center", CENTERS)), f"ann-members-{k}")
        known = units.join(worst, F.col("node") == F.col("member"), "left").select(
            "node", "x", F.when(F.coalesce("have", F.lit(0)) >= degree, F.col("worst")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
        need = (at.select(F.col("block").alias("home"), F.col("member").alias("id")).distinct().join(known, F.col("id") == F.col("node"))
                .select("home", "id", "x", "worst"))

        def solve(left, right):
            ids = right.column("id").to_numpy()
            by = np.argsort(ids)
            ids = ids[by]
            x = _floats(right.column("x").combine_chunks())[by]
            bar = right.column("worst").to_numpy()[by]
            c = left.column("center").to_numpy()
            order = np.argsort(c, kind="stable")
            c = c[order]
            m = np.searchsorted(ids, left.column("member").to_numpy()[order])
            fresh = left.column("fresh").to_numpy()[order]
            cuts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            found, held = [], 0
            for i, j in zip(cuts, np.append(cuts[1:], len(c))):
                if not fresh[i:j].any():
                    continue
                one, back = np.unique(m[i:j], return_inverse=True)  # a node may be there both ways
                new = np.bincount(back, fresh[i:j]) > 0
                v = x[one]
                s = v @ v.T
                ok = (s > bar[one][:, None]) & (new[:, None] | new[None, :])
                np.fill_diagonal(ok, False)
                p, q = np.nonzero(ok)
                found.append((one[p], one[q], s[p, q].astype(np.float32)))
                held += len(p)
                if held > 4_000_000:  # keep the best of each so far
                    found, held = [_top(*(np.concatenate(z) for z in zip(*found)), degree)], 0
            a, b, s = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
            a, b, s = _top(a, b, s, degree)
            return pa.table({"a": ids[a], "b": ids[b], "sim": s})

        better = (at.groupBy("block").cogroup(need.groupBy("home")).applyInArrow(solve, _PAIR)).withColumn("fresh", F.lit(True))
        edges = stored(_best(edges.withColumn("fresh", F.lit(False)).unionByName(better), degree), f"ann-graph-{k + 1}")
        if edges.filter("fresh").count() <= SETTLED * total:
            break
    return edges.select("a", "b", "sim")


def _known(units: DataFrame, edges: DataFrame) -> DataFrame:
    """(block, id, x, near): what searching a block takes. Each of its nodes with its neighbours both
    ways (of those that list it, the REVERSE nearest), and the vectors of all of them, each once."""
    back = W.partitionBy("b").orderBy(F.desc("sim"), "a")
    behind = edges.withColumn("r", F.row_number().over(back)).filter(F.col("r") <= REVERSE).select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select("a", "b").union(behind).distinct().select(_block("a", AREA).alias("block"), "a", "b")
    lists = both.groupBy("block", F.col("a").alias("id")).agg(F.collect_list("b").alias("near"))
    need = both.select("block", F.col("b").alias("id")).union(units.select(_block("node", AREA).alias("block"), F.col("node").alias("id"))).distinct()
    return (need.join(lists, ["block", "id"], "left").join(units, F.col("id") == F.col("node")).select("block", "id", "x", "near"))


def search(queries: DataFrame, units: DataFrame, edges: DataFrame, top: int) -> DataFrame:
    """(q, hit): candidates of each query (q, x) after greedy search. A query starts at its
    own node (``queries`` are nodes); each round visits the best nodes of its pool not
    visited before, in the blocks that hold them, and takes their neighbours, until no pool
    changes near the top."""
    known = stored(_known(units, edges), "ann-blocks")
    pool = queries.select("q", "x", F.array(F.struct(F.col("q").alias("id"), F.lit(2.0).cast("float").alias("sim"), F.lit(False).alias("seen"))).alias("pool"))
    pool_type = "array<struct<id: long, sim: float, seen: boolean>>"
    pool = cut(pool)

    def visit(left, right):
        ids = right.column("id").to_numpy()
        by = np.argsort(ids)
        ids = ids[by]
        x = _floats(right.column("x").combine_chunks())[by]
        lists = right.column("near").combine_chunks()
        q, worst = left.column("q").to_numpy(), left.column("worst").to_numpy()
        mine = _floats(left.column("x").combine_chunks())
        asked = left.column("nodes").to_pylist()
        flat, offs = lists.flatten().to_numpy(), np.append(0, np.cumsum([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]))
        out = []
        for i in range(len(q)):
            at = by[np.searchsorted(ids, asked[i])]
            near = np.unique(np.concatenate([flat[offs[k]:offs[k + 1]] for k in at]))
            sims = x[np.searchsorted(ids, near)] @ mine[i]
            ok = sims > worst[i]
            out.append((np.full(ok.sum(), q[i]), near[ok], sims[ok].astype(np.float32)))
        a, b, s = (np.concatenate(z) for z in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        return pa.table({"q": a, "id": b, "sim": s})

    def merge(t):
        c = t.column("center").to_numpy()
        cuts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        rows = []
        for i, j in zip(cuts, np.append(cuts[1:], len(c))):
            part = t.slice(i, j - i)
            own = next(r for r in part.filter(pc.is_valid(part.column("pool"))).to_pylist())
            visited, old = 0, []
            for p in own["pool"]:
                visited += not p["seen"]
                old.append((p["id"], p["sim"], p["seen"] or visited <= EXPAND))
            have = {p[0] for p in old}
            new = part.filter(pc.is_null(part.column("pool")))
            found = dict(zip(new.column("id").to_pylist(), new.column("sim").to_pylist()))
            old += [(n, v, False) for n, v in found.items() if n not in have]
            old.sort(key=lambda p: (-p[1], p[0]))
            old = old[:POOL]
            rows.append({"q": int(c[i]), "x": own["x"], "pool": [{"id": p[0], "sim": p[1], "seen": p[2]} for p in old],
                         "moved": any(p[0] not in have for p in old[:top + 1])})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("q", pa.int64()), ("x", pa.binary()), ("pool", pa.list_(pa.struct([("id", pa.int64()), ("sim", pa.float32()), ("seen", pa.bool_())]))), ("moved", pa.bool_())]))

    for _ in range(SEARCH_ROUNDS):
        step = F.expr(f"slice(filter(pool, p -> not p.seen), 1, {EXPAND})")
        full = F.when(F.size("pool") >= POOL, F.element_at("pool", -1)["sim"]).otherwise(F.lit(-3.0)).cast("float")
        asked = (pool.select("q", "x", full.alias("worst"), F.explode(step).alias("p")).withColumn("node", F.col("p.id"))
                 .groupBy(_block("node", AREA).alias("block"), "q").agg(F.first("x").alias("x"), F.first("worst").alias("worst"), F.collect_list("node").alias("nodes")))
        got = asked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(visit, "q long, id long, sim float")
        both = (got.select(F.col("q").alias("center"), "id", "sim", F.lit(None).cast("binary").alias("x"), F.lit(None).cast(pool_type).alias("pool"))
                .union(pool.select("q", F.lit(None).cast("long"), F.lit(None).cast("float"), "x", "pool")))
        after = cut(_by_center(both, merge, f"q long, x binary, pool {pool_type}, moved boolean"))
        pool = after.drop("moved")
        if not after.filter("moved").limit(1).count():
            break
    return pool.select("q", F.explode("pool").alias("p")).select("q", F.col("p.id").alias("hit"))


def nearest(table: DataFrame, query: str, top: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every usable row for which the SQL condition ``query``
    on ``id`` holds, the ``top`` rows with the largest inner products that the search finds,
    its own row left out; rank from 1, ties to the smaller id. score: the inner product of the
    original vectors in double precision. Fewer usable rows give fewer results, an empty
    table gives none. Rows that repeat an id and a vector count once."""
    vectors = usable(table, id_col, vec_col)
    different = stored(nodes_of(vectors, top + 1), "ann-vectors")
    numbered = stored(blocks(_unit(different)), "ann-numbers")
    units = numbered.select(F.col("number").alias("node"), "x")
    nodes = stored(different.join(numbered.select("node", "number"), "node").select(F.col("number").alias("node"), "ids", "raw"), "ann-nodes")
    edges = graph(units)
    asked = stored(vectors.filter(query).select("id", "v").distinct(), "ann-queries")

    def key(batches):
        for b in batches:
            m = _matrix(b.column(1)) + 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), _raw(m)], ["id", "raw"])

    own = asked.mapInArrow(key, "id long, raw binary").join(nodes.select("node", "raw"), "raw").select("id", "raw", "node")
    own = stored(own, "ann-own")
    starts = own.select(F.col("node").alias("q")).distinct().join(units, F.col("q") == F.col("node")).select("q", "x")

    # the extra coordinate of a query is 0: the best node has the largest inner product
    def flat(batches):
        for b in batches:
            x = _floats(b.column(1)).copy()
            x[:, -1:] = 0
            yield pa.RecordBatch.from_arrays([b.column(0), _raw(x.astype(np.float16))], ["q", "x"])

    found = search(starts.mapInArrow(flat, "q long, x binary"), units, edges, top)
    measured = (own.select("node", F.col("raw").alias("q_raw")).distinct()
                .join(found, F.col("node") == F.col("q")).select("q", "q_raw", "hit"))
    measured = measured.join(nodes.select(F.col("node").alias("hit"), "ids", "raw"), "hit").select("q", "q_raw", "ids", "raw")

    def exact(batches):
        for b in batches:
            x = np.array([np.frombuffer(r.as_buffer(), np.float64) for r in b.column(1)]).reshape(len(b), -1)
            y = np.array([np.frombuffer(r.as_buffer(), np.float64) for r in b.column(3)]).reshape(len(b), -1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.einsum("ij,ij->i", x, y))], ["q", "ids", "score"])

    scored = measured.mapInArrow(exact, "q long, ids array<long>, score double")
    each = scored.select("q", "score", F.explode("ids").alias("vec_id"))
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = each.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top + 1)  # one more: a query's own row goes
    mine = own.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(lists, "q").filter("vec_id <> query_id")
    order = W.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (mine.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
