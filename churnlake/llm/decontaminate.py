"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units and names become typed placeholders. Windows of template tokens are
hash-joined against the benchmark's; a hit then needs the same template, token by
token, and consistent slots: two slots hold the same value in the text exactly
where they do in the benchmark item. So a question with other numbers and names
is found, and a text that only shares the frame is not. Windows with too few plain words
for that, and items shorter than a window, are also sought word for word, values included.
Scripts without spaces are cut into characters, each a token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, stored

#: Template tokens per window; an item with fewer is one window.
WINDOW, LEAST_ITEM = 10, 5
#: A window whose values may differ needs so many tokens that are no placeholder, and an item LEAST_ITEM tokens.
LEAST_LITERALS = 5
#: Kinds of windows: equal templates and slot patterns, or equal words.
BY_TEMPLATE, BY_WORDS = 0, 1
#: Benchmark windows, and rows with hits, up to this many (8-byte hashes) are broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 2_000_000

#: FIXED VALUES: words and signs that count as units after a number.
UNITS = ["%", "percent", "kilometers?", "kilometres?", "km", "kmh", "mph", "meters?", "metres?", "cm", "mm", "m", "miles?", "feet",
         "foot", "inches", "inch", "yards?", "kilograms?", "kg", "grams?", "g", "mg", "pounds?", "lbs?", "ounces?", "oz", "tons?",
         "tonnes?", "liters?", "litres?", "l", "ml", "gallons?", "hours?", "hrs?", "h", "minutes?", "mins?", "min", "seconds?", "secs?",
         "s", "days?", "weeks?", "months?", "years?", "dollars?", "euros?", "cents?", "usd", "eur", "degrees?", "celsius", "watts?",
         "kw", "kwh", "volts?", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb"]
NUMBER, UNIT, NAME = "\x02", "\x03", "\x04"
_MARKS = f"{NUMBER}{UNIT}{NAME}"
#: Letters of scripts that put no space between words (all of them stand after U+0E00, which is quickly seen).
_UNSPACED = r"[\x{E00}-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]&&\p{L}]\p{M}*"


def marked(text: Column) -> Column:
    """Lower-case words separated by spaces, punctuation dropped; a mark stands before the
    value of each number, unit (after a number) and name (a capitalised word inside a sentence).
    Each pattern begins with a look at one character, so most places are passed at once."""
    x = F.regexp_replace(F.regexp_replace(text, f"[{_MARKS}]", " "), f"({_UNSPACED})", " $1 ")
    x = F.regexp_replace(x, r"(?=\p{Lu})(?<=[\p{Ll}\p{N}][,;:]? )(\p{Lu}[\p{L}\p{M}]*)", NAME + "$1")
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    x = F.regexp_replace(x, rf"(?i)(?=\d)(?<![\p{{L}}\p{{N}}])(\d+(?:[.,]\d+)*)(?:[ -]?({units}))?(?![\p{{L}}\p{{N}}])", f" {NUMBER}$1 {UNIT}$2 ")
    # signs that depend on their neighbours first, then all others (two quick patterns; one with both is slow)
    x = F.regexp_replace(x, rf"(?=[.,%{UNIT}])(?:[.,](?!\d)|(?<!\d)[.,]|{UNIT}(?![\p{{L}}%])|(?<!{UNIT})%)", " ")
    x = F.regexp_replace(x, rf"[^ a-zA-Z0-9\p{{L}}\p{{M}}\p{{N}}{_MARKS}.,%]+", " ")
    return F.lower(F.trim(x))


def template(words: Column) -> Column:
    """The marked text with only the mark of each slot left."""
    return F.regexp_replace(words, rf"([{_MARKS}])[^ ]+", "$1")


def _tokens(words: Column) -> Column:
    return F.filter(F.split(words, " "), lambda t: t != "")


def _window_hash(tokens: Column) -> Column:
    """The hash of a window: that of the hashes of its tokens, so a text hashes each token once."""
    return F.xxhash64(F.transform(tokens, lambda t: F.xxhash64(t)))


def _windows(hashes: str, size: str) -> Column:
    return F.expr(f"if(size({hashes}) >= {size}, transform(sequence(1, size({hashes}) - {size} + 1), i -> xxhash64(slice({hashes}, i, {size}))), cast(array() as array<bigint>))")


def _pattern(window: str) -> Column:
    """For each slot of a window of marked words, the first slot with its value."""
    slots = f"filter({window}, t -> substring(t, 1, 1) in ('{NUMBER}', '{UNIT}', '{NAME}'))"
    return F.expr(f"transform({slots}, t -> array_position({slots}, t))")


def _bare(words: Column) -> Column:
    """The tokens of a marked text without the marks: what the text says, wherever it stands."""
    return _tokens(F.regexp_replace(words, f"[{_MARKS}]", ""))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(kind, size, hash, frame, pattern, item_id): the windows of every item, one row per
    different (kind, frame, pattern), with its smallest item. Template windows of fewer than
    LEAST_LITERALS plain words or of items of fewer than LEAST_ITEM tokens are windows of words
    instead; an item shorter than a window is both, as its only window may begin with a name
    in the text but not in the item. Only items without a token have none."""
    items = (benchmark.filter("text is not null")
             .select(F.col("item_id").cast("long").alias("item_id"), marked(F.col("text").cast("string")).alias("words")))
    items = (items.select("item_id", _tokens(F.col("words")).alias("raw"), _tokens(template(F.col("words"))).alias("tpl"), _bare(F.col("words")).alias("bare"))
             .filter(F.size("tpl") >= 1)
             .withColumn("size", F.least(F.size("tpl"), F.lit(window))))
    each = items.select("item_id", "size", "raw", "tpl", "bare", F.explode(F.expr("sequence(1, size(tpl) - size + 1)")).alias("at"))
    each = each.select("item_id", "size", *(F.expr(f"slice({of}, at, size)").alias(to) for of, to in (("tpl", "t"), ("raw", "r"), ("bare", "w"))))
    plain = F.size(F.filter("t", lambda t: ~t.isin(NUMBER, UNIT, NAME)))
    by_template = (plain >= LEAST_LITERALS) & (F.col("size") >= min(LEAST_ITEM, window))
    some = (each.filter(by_template)
            .select(F.lit(BY_TEMPLATE).alias("kind"), "item_id", "size", _window_hash(F.col("t")).alias("hash"), F.concat_ws(" ", "t").alias("frame"), _pattern("r").alias("pattern")))
    rest = (each.filter(~by_template | (F.col("size") < window))
            .select(F.lit(BY_WORDS).alias("kind"), "item_id", "size", _window_hash(F.col("w")).alias("hash"), F.concat_ws(" ", "w").alias("frame"), _pattern("cast(array() as array<string>)").alias("pattern")))
    return some.union(rest).groupBy("kind", "size", "hash", "frame", "pattern").agg(F.min("item_id").alias("item_id"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, at, size, item_id): windows of the texts (token position from 1)
    whose template and slot pattern, or whose words, are those of a benchmark window."""
    bench = stored(benchmark_windows(benchmark, window), "bench-windows")
    sizes = sorted((r["size"], r["kind"]) for r in bench.select("size", "kind").distinct().collect())  # at most 2 * ``window`` pairs
    rows = keyed(docs)
    if not sizes:
        return rows.limit(0).selectExpr("doc_id", "text_key", "1 as at", "1 as size", "cast(null as bigint) as item_id")
    hashes = bench.select("kind", "size", "hash").distinct()
    if hashes.count() <= BROADCAST_WINDOWS:
        hashes = F.broadcast(hashes)
    # one pass over the texts (explode_outer: for explode Spark adds a filter on the array's size, for which
    # patterns and windows would be computed twice; rows without a window have a null hash): tokens are hashed once, every (size, kind) takes its windows of the hashes
    words = rows.select("doc_id", "text_key", marked(F.col("text")).alias("words"))
    tokens = {BY_TEMPLATE: _tokens(template(F.col("words"))), BY_WORDS: _bare(F.col("words"))}
    kinds = sorted({k for _, k in sizes})
    hashed = words.select("doc_id", "text_key", F.array(*(F.struct(F.lit(k).alias("kind"), F.transform(tokens[k], lambda t: F.xxhash64(t)).alias("hashes")) for k in kinds)).alias("sorts"))
    each = hashed.select("doc_id", "text_key", F.explode_outer("sorts").alias("s")).select("doc_id", "text_key", "s.kind", "s.hashes")
    lengths = F.create_map(*(x for k in kinds for x in (F.lit(k), F.array(*(F.lit(s) for s, of in sizes if of == k)))))
    each = each.select("doc_id", "text_key", "kind", "hashes", F.explode_outer(lengths[F.col("kind")]).alias("size"))
    found = (each.select("doc_id", "text_key", "size", "kind", F.posexplode_outer(_windows("hashes", "size")).alias("at", "hash"))
             .join(hashes, ["kind", "size", "hash"]).select("doc_id", "text_key", (F.col("at") + 1).alias("at"), "size", "kind"))
    per_row = stored(found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "size", "kind")).alias("hits")), "bench-hits")
    # only rows with hits are looked at again: where they are few, the texts are filtered where they lie
    names = per_row.select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key"))
    if names.count() <= BROADCAST_WINDOWS:
        names = F.broadcast(names)
    again = rows.join(names, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("text_key") == F.col("hit_key")), "left_semi")
    again = (again.alias("d").join(per_row.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key")))
             .select("d.doc_id", "d.text_key", "f.hits", marked(F.col("d.text")).alias("words")))
    # the row once: rows that repeat an id and a text have the same windows
    again = again.dropDuplicates(["doc_id", "text_key"])
    again = again.select("doc_id", "text_key", "hits", _tokens(F.col("words")).alias("raw"), _tokens(template(F.col("words"))).alias("tpl"), _bare(F.col("words")).alias("bare"))
    shown = again.select("doc_id", "text_key", F.explode_outer(F.expr(
        f"transform(hits, h -> struct(h.at as at, h.size as size, h.kind as kind, if(h.kind = {BY_WORDS}, cast(array() as array<string>), slice(raw, h.at, h.size)) as r, "
        f"slice(if(h.kind = {BY_WORDS}, bare, tpl), h.at, h.size) as t))")).alias("w"))
    shown = shown.select("doc_id", "text_key", "w.at", "w.size", "w.kind", F.concat_ws(" ", "w.t").alias("frame"), _pattern("w.r").alias("pattern"))
    return (shown.join(bench.select("kind", "size", "frame", "pattern", "item_id"), ["kind", "size", "frame", "pattern"])
            .groupBy("doc_id", "text_key", "at", "size").agg(F.min("item_id").alias("item_id")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, contaminated, n_windows, item_id), one row per row of ``docs``:
    n_windows is the number of consistent window hits, item_id the smallest item hit. Null and
    empty texts have none; null benchmark texts are left out; an empty benchmark marks nothing."""
    hits = (matches(docs, benchmark, window).groupBy("doc_id", "text_key")
            .agg(F.count("*").alias("n"), F.min("item_id").alias("item_id")))
    rows = keyed(docs).select("doc_id", "text_key")
    joined = rows.alias("d").join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_key") == F.col("h.text_key")), "left")
    return joined.select("d.doc_id", "d.text_key", F.col("h.n").isNotNull().alias("contaminated"),
                         F.coalesce("h.n", F.lit(0)).cast("long").alias("n_windows"), "h.item_id")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` (all columns) with no consistent window hit."""
    hits = matches(docs, benchmark, window).select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_doc"), key.alias("own_key"))  # other columns cannot clash
    return rows.join(hits, F.col("own_doc").eqNullSafe(F.col("hit_doc")) & (F.col("own_key") == F.col("hit_key")), "left_anti").select("row.*")
