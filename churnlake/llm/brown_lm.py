"""Brown class-based n-gram scores.

Words fall into classes by exchange clustering on the bigram counts of the training
texts. The model's probability of a token is P(class | class before) times
P(word | class), both smoothed. Counts are over all training tokens.

Word types are named by 64-bit hashes. The most frequent ones are clustered one by
one; all other words are clustered in groups that share an ending, so every word
has a class that any task can tell without a lookup in the whole vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, keyed, mix64, prefix_hash, slabs, span_hash, stored, crc_mod, utf8, word_spans

#: Classes of words (one more is that of the end token), words clustered one by one, groups of the rest.
CLASSES, LEXICON, GROUPS = 96, 8192, 4096
#: Words whose counts every task gets (an exact shortcut: all other words are joined).
FREQUENT = 200_000
#: Exchange rounds at most, and the gain in log-likelihood per token that ends them.
ROUNDS, SETTLED = 8, 1e-3
#: Weight of the class unigrams in a class transition.
SMOOTH = 8.0
#: The end token's unit.
_END = 0


class Words:
    """Units of the words: 0 the end token, then the lexicon by rank, then the groups."""

    def __init__(self, lexicon: np.ndarray):
        by = np.argsort(lexicon, kind="stable")
        self.sorted, self.rank = lexicon[by], by
        self.size = 1 + len(lexicon) + GROUPS

    def units(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = 1 + len(self.sorted) + (endings % np.uint64(GROUPS)).astype(np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
            hit = self.sorted[at] == words
            out[hit] = 1 + self.rank[at[hit]]
        return out


def tokens(buf: np.ndarray, offsets: np.ndarray):
    """(word hash, hash of its last three bytes, first): lower-cased A-Z, white space removed."""
    low = LOWER[buf]
    s, e, first = word_spans(low, offsets)
    p = prefix_hash(low)
    words = mix64(span_hash(p, s, e) + (e - s).astype(np.uint64))
    tail = np.maximum(s, e - 3)
    return words, mix64(span_hash(p, tail, e) + np.uint64(77)), first


def _batches(it, text: int):
    for b in it:
        buf, offs = utf8(b.column(text))
        for i, j in slabs(offs):
            yield b, i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def word_counts(train: DataFrame) -> DataFrame:
    """(word, ending, n) over all tokens of the texts but the end tokens; ending: the word's group."""
    def run(it):
        kept, held = [], 0

        def merge():
            w, at, back = np.unique(np.concatenate([x[0] for x in kept]), return_index=True, return_inverse=True)
            g = np.concatenate([x[1] for x in kept])[at]
            n = np.bincount(back, np.concatenate([x[2] for x in kept])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(g.astype(np.int32)), pa.array(n)], ["word", "ending", "n"])

        for _, _, _, buf, offs in _batches(it, 2):
            words, endings, _ = tokens(buf, offs)
            w, at, n = np.unique(words, return_index=True, return_counts=True)
            kept.append((w, endings[at] % np.uint64(GROUPS), n))
            held += len(w)
            if held > 2_000_000:
                yield merge()
                kept, held = [], 0
        if held:
            yield merge()

    return train.mapInArrow(run, "word long, ending int, n long").groupBy("word", "ending").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> pa.Table:
    """(word, ending, n), n descending: every word whose count reaches a bound that at most ``most``
    words reach. The bound comes from the counts' histogram over steps of a 64th of a doubling."""
    step = F.floor(F.log2("n") * 64).cast("int")
    seen, bound = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("least")).collect(), key=lambda r: -r["s"]):
        seen += r["k"]
        if seen > most:
            break
        bound = r["least"]
    some = counts.filter(F.col("n") >= bound) if bound else counts.limit(0)
    return some.toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def unit_bigrams(train: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """(u, v, n): how often unit v follows unit u; every text starts after an end token and ends with one."""
    def run(it):
        names = Words(lexicon)
        kept, held = [], 0

        def merge():
            k, at = np.unique(np.concatenate([x for x, _ in kept]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in kept])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array((k // names.size).astype(np.int32)), pa.array((k % names.size).astype(np.int32)), pa.array(n)], ["u", "v", "n"])

        for _, _, _, buf, offs in _batches(it, 2):
            words, endings, first = tokens(buf, offs)
            seq = np.insert(names.units(words, endings), first[1:], _END)
            before = np.concatenate([[_END], seq[:-1]])
            pair = np.unique(before * names.size + seq, return_counts=True)
            kept.append(pair)
            held += len(pair[0])
            if held > 3_000_000:
                yield merge()
                kept, held = [], 0
        if held:
            yield merge()

    return train.mapInArrow(run, "u int, v int, n long").groupBy("u", "v").agg(F.sum("n").alias("n"))


def _class_rows(pairs: DataFrame, of: str, other: str, classes: np.ndarray, units: int, count: int) -> np.ndarray:
    """(units, classes): per unit how often each class is its neighbour. ``pairs`` is dealt
    out by ``of``, so each task sums up its own units and few of them come from two."""
    def run(it):
        table = np.zeros((units, count))
        for b in it:
            u, v, n = (b.column(c).to_numpy() for c in (of, other, "n"))
            np.add.at(table, (u, classes[v]), n)
        names = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array([table[k].tobytes() for k in names], pa.binary())], ["unit", "row"])

    out = np.zeros((units, count))
    for r in pairs.mapInArrow(run, "unit int, row binary").collect():
        out[r["unit"]] += np.frombuffer(r["row"])
    return out


def _likelihood(c: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, up to a part that no exchange changes."""
    def xlogx(x):
        return float((x[x > 0] * np.log(x[x > 0])).sum())
    return xlogx(c) - xlogx(c.sum(0)) - xlogx(c.sum(1))


def exchange(pairs: DataFrame, units: int, classes: int = CLASSES, rounds: int = ROUNDS):
    """(class of each unit, class bigram counts): exchange clustering of the units.

    In each round every unit's neighbour-class counts (a Spark job over the bigram
    table) give the class under which its own bigrams are likeliest, and half of the
    units (in turn) exchange their class. A round that lowers the corpus log-likelihood is taken back and ends the search. The driver
    holds only (units x classes), both parameters."""
    parts = max(8, pairs.sparkSession.sparkContext.defaultParallelism)
    right = stored(pairs.repartition(parts, "u"), "brown-right")
    left = stored(right.repartition(parts, "v"), "brown-left")
    count = classes + 1  # class 0: the end token
    of = np.zeros(units, np.int64)
    of[1:] = 1 + np.arange(units - 1) % classes

    def table_of(ahead, current):
        c = np.zeros((count, count))
        np.add.at(c, current, ahead)
        return c

    best, kept, last = None, None, None
    for k in range(rounds + 1):
        ahead = _class_rows(right, "u", "v", of, units, count)
        behind = _class_rows(left, "v", "u", of, units, count)
        c = table_of(ahead, of)
        value = _likelihood(c)
        if best is not None and value < best:
            return kept, last
        done = best is not None and value - best < SETTLED * max(c.sum(), 1.0)
        best, kept, last = value, of.copy(), c
        if done or k == rounds:
            break
        log_next = np.log((c + 0.1) / (c.sum(1, keepdims=True) + 0.1 * count))  # log P(next | class)
        log_prev = np.log((c + 0.1) / (c.sum(0, keepdims=True) + 0.1 * count))  # log P(before | class), by column
        # log-likelihood of the unit's bigrams in each class; dividing by the class's size is in both logs
        gain = ahead @ log_next.T + behind @ log_prev
        stay = gain[np.arange(units), of]
        gain[:, 0] = -np.inf  # the end token's own class
        to = gain.argmax(1)
        turn = (mix64(np.arange(units, dtype=np.uint64) + np.uint64(9)) >> np.uint64(40)) % np.uint64(2) == k % 2
        move = turn & (ahead.sum(1) > 0) & (gain[np.arange(units), to] > stay)
        move[0] = False
        of = np.where(move, to, of)
    return kept, last


class Model:
    """What a task needs: classes of the units, log10 transition table, log10 size of each
    class's words, and the frequent words' counts."""

    def __init__(self, lexicon, of, transitions, room, known, counts):
        self.names, self.of, self.transitions, self.room = Words(lexicon), of, transitions, room
        self.known, self.counts = known, counts


def fit(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS):
    """(model, counts, totals) from the rows whose crc32(doc_id) mod 7 is not 2 (a null id
    teaches nothing). counts: (word, n) of every training word. totals: end tokens, N, V."""
    train = keyed(docs.filter(crc_mod(F.col("doc_id"), 7) != 2))
    counts = stored(word_counts(train), "brown-words")
    ends = train.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()[0]
    n, v = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    top = most_frequent(counts, FREQUENT)
    words, freq = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    lexicon = words[:LEXICON]
    names = Words(lexicon)
    of, c = exchange(unit_bigrams(train, lexicon), names.size, classes, rounds)
    mass = c.sum(0)
    prior = (mass + 1.0) / (mass.sum() + len(mass))
    move = (c + SMOOTH * prior) / (c.sum(1, keepdims=True) + SMOOTH)
    # different words per class: the lexicon one by one, the rest by their groups
    types = np.zeros(classes + 1)
    np.add.at(types, of[1:1 + len(lexicon)], 1)
    rest = np.zeros(GROUPS)
    for r in counts.groupBy("ending").agg(F.count("*").alias("k")).collect():
        rest[r["ending"]] = r["k"]
    np.subtract.at(rest, top.column("ending").to_numpy()[:len(lexicon)], 1)
    np.add.at(types, of[1 + len(lexicon):], rest)
    types[0] = 1
    room = np.log10(mass + types + 1.0)
    by = np.argsort(words, kind="stable")
    return Model(lexicon, of, np.log10(move), room, words[by], freq[by].astype(np.int64)), counts, (ends, n, v)


def score(docs: DataFrame, model: Model, counts: DataFrame, totals) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity), one row per row.

    score: log10 probability of the whole text, end token included. An unknown word
    takes the place that each class keeps for unseen words. Null and empty texts are the end
    token alone. base_score: add-one unigrams, log10((c + 1) / (N + V + 1)) per token."""
    ends, n, v = totals
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = keyed(docs)
    end_log = float(np.log10(ends + 1.0))

    def run(it):
        m = shared.value
        log_counts = np.log10(m.counts + 1.0)
        for b, i, j, buf, offs in _batches(it, 2):
            words, endings, first = tokens(buf, offs)
            k = np.diff(first)
            row = np.repeat(np.arange(j - i), k)
            seq = np.insert(m.of[m.names.units(words, endings)], first[1:], 0)
            before = np.concatenate([[0], seq[:-1]])
            at = first + np.arange(j - i + 1)
            local = m.transitions[before, seq] - m.room[seq]
            sums = np.add.reduceat(local, at[:-1]) if j > i else np.zeros(0)
            if len(m.known):
                pos = np.minimum(np.searchsorted(m.known, words), len(m.known) - 1)
                hit = m.known[pos] == words
                known = np.bincount(row[hit], minlength=j - i)
                logs = np.bincount(row[hit], log_counts[pos[hit]], j - i)
            else:
                hit, known, logs = np.zeros(len(words), bool), np.zeros(j - i, np.int64), np.zeros(j - i)
            part = [b.column(c).slice(i, j - i) for c in (0, 1)]
            none = pa.nulls(j - i, pa.int64())
            yield pa.RecordBatch.from_arrays([*part, none, pa.array(k + 1), pa.array(known.astype(np.int64) + (ends > 0)), pa.array(logs + end_log), pa.array(sums)],
                                             ["doc_id", "text_key", "word", "n_tokens", "n_known", "logs", "local"])
            rare = np.flatnonzero(~hit)
            if len(rare):
                rare = rare[np.lexsort((words[rare], row[rare]))]
                w, r = words[rare], row[rare]
                new = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (r[1:] != r[:-1])))
                times = np.diff(np.append(new, len(w)))
                ids = pa.array(r[new])
                zero = pa.array(np.zeros(len(new)))
                yield pa.RecordBatch.from_arrays([part[0].take(ids), part[1].take(ids), pa.array(w[new].view(np.int64)), pa.array(times), pa.array(np.zeros(len(new), np.int64)), zero, zero],
                                                 ["doc_id", "text_key", "word", "n_tokens", "n_known", "logs", "local"])

    return _finish(rows.mapInArrow(run, "doc_id long, text_key long, word long, n_tokens long, n_known long, logs double, local double"), counts, n, v)


def _finish(parts: DataFrame, counts: DataFrame, n: int, v: int) -> DataFrame:
    """Adds the counts of the words outside the frequent table, then sums up each row. Rows that
    repeat id and text are summed together, divided by their number and given back."""
    whole = parts.filter("word is null").select("doc_id", "text_key", F.lit(1).alias("rows"), "n_tokens", "n_known", "logs", "local")
    rare = parts.filter("word is not null").select("doc_id", "text_key", "word", F.col("n_tokens").alias("times"))
    looked = rare.join(counts.select("word", "n"), "word").select("doc_id", "text_key", F.lit(0).alias("rows"), F.lit(0).cast("long").alias("n_tokens"), F.col("times").alias("n_known"),
                                              (F.col("times") * F.log10(F.col("n") + 1)).alias("logs"), F.lit(0.0).alias("local"))
    per_row = (whole.union(looked).groupBy("doc_id", "text_key")
               .agg(F.sum("rows").cast("int").alias("rows"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "logs", "local"))))
    each = per_row.select("doc_id", "rows", (F.col("n_tokens") / F.col("rows")).cast("long").alias("n_tokens"), (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
                          (F.col("logs") / F.col("rows")).alias("logs"), (F.col("local") / F.col("rows")).alias("local"),
                          F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1.0)))
    total = F.col("logs") + F.col("local")
    return each.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                       F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), total.alias("score"),
                       F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))


def brown_scores(docs: DataFrame) -> DataFrame:
    """Fits on ``docs`` and scores every row of it; see ``fit`` and ``score``."""
    return score(docs, *fit(docs))
