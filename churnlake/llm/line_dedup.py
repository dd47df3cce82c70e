"""Line deduplication by winnowing over line hashes.

In every ``run`` consecutive lines the smallest line hash is a fingerprint, so a run
of ``run`` or more lines that two places share has a fingerprint in common. Only
positions of fingerprints that stand at two places are joined; around each one the
match is extended both ways, window by window, and every run of lines that stands
earlier (by doc_id, then position) is deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, stored

#: Lines of the shortest repeated run that is deleted (and of the winnowing window).
RUN = 3


def _hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, a, b): two independent 64-bit hashes of every line."""
    lines = F.split(F.col("text"), "\n", -1)
    return (keyed(docs).select("doc_id", "text_key", lines.alias("lines"))
            .select("doc_id", "text_key", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
                    F.transform("lines", lambda x: F.xxhash64(F.lit("second"), x, F.length(x))).alias("b")))


def repeated_windows(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, text_key, at): positions (from 1) of ``run`` lines that also stand earlier."""
    own = stored(_hashed(docs).filter(F.size("a") >= run).dropDuplicates(["doc_id", "text_key"]), "line-hashes")
    lows = own.withColumn("low", F.expr(f"transform(sequence(1, size(a) - {run} + 1), i -> array_min(slice(a, i, {run})))"))
    # a line is a fingerprint if it is the minimum of some window that holds it
    marked = lows.select("doc_id", "text_key", F.posexplode(F.expr(
        f"transform(a, (h, p) -> if(array_contains(slice(low, greatest(p - {run} + 2, 1), least(p + 1, size(low)) - greatest(p - {run} + 2, 1) + 1), h), h, null))")).alias("p", "h"))
    marked = marked.filter("h is not null").select("doc_id", "text_key", "h", (F.col("p") + 1).alias("p"))
    twice = marked.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    joined = marked.join(twice, "h").groupBy("doc_id", "text_key").agg(F.collect_set("p").alias("ps"))
    around = own.alias("o").join(joined.alias("j"), F.col("o.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("o.text_key") == F.col("j.text_key")))
    starts = F.array_distinct(F.flatten(F.expr(f"transform(ps, p -> sequence(greatest(p - {run} + 1, 1), least(p, size(a) - {run} + 1)))")))
    windows = (around.select("o.doc_id", "o.text_key", "a", "b", F.explode(starts).alias("at"))
               .select("doc_id", "text_key", "at", F.expr(f"xxhash64(slice(a, at, {run}))").alias("x"), F.expr(f"xxhash64(slice(b, at, {run}))").alias("y")))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "at")
    windows = stored(windows.withColumn("place", place), "line-windows")
    first = windows.groupBy("x", "y").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return windows.join(first, ["x", "y"]).filter(F.col("place") != F.col("first")).select("doc_id", "text_key", "at")


def dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` (all columns) with ``kept_text``, ``n_lines``, ``n_removed`` and ``n_runs``.

    A line goes if it lies in ``run`` consecutive lines that also stand earlier: in a
    smaller doc_id, or further up in the same text (null ids come last; among rows
    of one id, texts are ordered by their hash). Lines are compared exactly, and a text
    without a line end is one line. Rows that repeat id and text count once and are cut
    alike. A null text has no lines and stays null; if every line goes, kept_text is empty."""
    cut = (repeated_windows(docs, run).groupBy("doc_id", "text_key")
           .agg(F.collect_set("at").alias("ats")).select(F.col("doc_id").alias("cut_doc"), F.col("text_key").alias("cut_key"), "ats"))
    text = F.col("text").cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    both = docs.join(cut, F.col("doc_id").cast("long").eqNullSafe(F.col("cut_doc")) & (key == F.col("cut_key")), "left")
    gone = F.expr(f"array_sort(array_distinct(flatten(transform(ats, p -> sequence(p, p + {run} - 1)))))")
    both = both.withColumn("gone_lines", F.when(text.isNull(), F.lit(None)).otherwise(F.coalesce(gone, F.expr("array(0)"))))
    has = "ats is not null and text is not null"
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col("gone_lines"))
    return (both.withColumn("all_lines", lines).withColumn("kept_text", F.when(F.expr(has), F.array_join(F.transform(left, lambda p: F.get(F.col("all_lines"), p - 1)), "\n")).otherwise(text))
            .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.when(F.expr(has), F.size("gone_lines")).otherwise(0).cast("long"))
            .withColumn("n_runs", F.when(F.expr(has), F.expr("size(filter(gone_lines, (g, i) -> i = 0 or gone_lines[i - 1] != g - 1))")).otherwise(0).cast("long"))
            .drop("gone_lines", "ats", "cut_doc", "cut_key", "all_lines"))


def deduplicated(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` (its own columns) with the text cut, and ``n_chars``, if there, counted anew.
    A document that had text and loses every line goes."""
    # the caller's columns travel as one struct: their names cannot clash with those of ``dedup``
    cut = dedup(docs.select("doc_id", "text", F.struct("*").alias("row")), run)
    left = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    own = F.col("row").getField
    out = [F.col("kept_text").alias(c) if c == "text" else
           F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(own(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else own(c).alias(c)
           for c in docs.columns]
    return left.select(*out)


def oracle(run: int = RUN) -> str:
    """DuckDB text for (doc_id, n_lines, n_removed, n_runs, kept_text) of ``documents``."""
    ahead = ", ".join(f"lead(line, {k}) over d as l{k}" for k in range(1, run))
    names = ", ".join(["line", *(f"l{k}" for k in range(1, run))])
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t),
    w AS (SELECT doc_id, line, pos, {ahead} FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
    r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY {names} ORDER BY doc_id, pos) AS k FROM w WHERE l{run - 1} IS NOT NULL),
    gone AS (SELECT DISTINCT doc_id, pos + i AS pos FROM r, range({run}) AS s(i) WHERE k > 1),
    f AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS gone,
                 g.pos IS NOT NULL AND lag(g.pos) OVER (PARTITION BY l.doc_id ORDER BY l.pos) IS NULL AS new_run
          FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos)
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
           CAST(sum(CASE WHEN new_run THEN 1 ELSE 0 END) AS BIGINT) AS n_runs,
           coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '') AS kept_text
    FROM f GROUP BY doc_id"""
