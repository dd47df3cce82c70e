"""Feature drift between a reference and a current frame.

Both sides are unpivoted once to (feature, value) and counted per distinct
value -- a partial aggregate, so repeated values cost nothing -- giving one
table (batch, feature, value, n_ref, n_cur).  Every test runs on it for
all features at once: KS from per-feature prefix sums (no sort of raw
rows), PSI from exact interpolated percentiles of the pooled counts,
chi-square from the per-value counts.  ``batch_cols`` lets several current
batches be tested against one reference in the same job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.prefix import _few, exact_quantiles, prefix_sums, value_ranges
from churnlake.params import MONITORED_FEATURES, Params

EPS = 1e-10


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("user_id",)) -> list[str]:
    num = ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in num or f.dataType.simpleString().startswith("decimal")
            if f.name not in exclude]


def monitored_columns(df: DataFrame, monitored: Sequence[str] = MONITORED_FEATURES, min_present: int = 5,
                      fallback_max: int = 50) -> list[str]:
    """H1 column choice: the monitored features present; when fewer than
    ``min_present`` are, the first ``fallback_max`` numeric columns but the user's id."""
    present = [c for c in monitored if c in df.columns]
    return present if len(present) >= min_present else numeric_columns(df)[:fallback_max]


def _long(df: DataFrame, features: Sequence[str], batch_cols: Sequence[str] = ()) -> DataFrame:
    typed = df.select(*batch_cols, *[F.col(f).cast("double").alias(f) for f in features])
    x = typed.unpivot(list(batch_cols), list(features), "feature", "value")
    return x.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(ref: DataFrame, cur: DataFrame, features: Sequence[str],
                 batch_cols: Sequence[str] = ()) -> DataFrame:
    """(batch..., feature, value, n_ref, n_cur) over the common features."""
    rc = _long(ref, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    cc = _long(cur, features, batch_cols).groupBy(*batch_cols, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    if batch_cols:
        # the reference is compared with every batch: equi-join on feature
        keys = cc.select(*batch_cols, "feature").distinct()
        rc = rc.join(keys, "feature")
    both = (rc.select(*batch_cols, "feature", "value", F.col("n").alias("n_ref"), F.lit(0).cast("bigint").alias("n_cur"))
              .unionByName(cc.select(*batch_cols, "feature", "value", F.lit(0).cast("bigint").alias("n_ref"),
                                     F.col("n").alias("n_cur"))))
    return both.groupBy(*batch_cols, "feature", "value").agg(F.sum("n_ref").alias("n_ref"),
                                                           F.sum("n_cur").alias("n_cur"))


def ks_test(counts: DataFrame, batch_cols: Sequence[str] = (), terms: int = 100) -> DataFrame:
    """H3 + H4: two-sample KS statistic (sup of the ECDF distance) and its
    p-value (``ks_pvalue``)."""
    g = [*batch_cols, "feature"]
    cum = prefix_sums(counts, "value", ["n_ref", "n_cur"], g)
    tot = counts.groupBy(*g).agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    d = (cum.join(tot, g).groupBy(*g)
            .agg(F.max(F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur")))
                 .alias("ks_statistic"), F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur")))
    return d.withColumn("ks_pvalue", ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"), terms))


#: Sides of up to this many rows get the exact p-value.
EXACT_ROWS = 10_000
#: Beyond this scaled distance the p-value is under 1e-13, the rounding of the exact sum: the series serves.
FAR = 4.0


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """H4: p-value of the two-sample distance ``d`` of sides with ``n`` and ``m`` rows: exact when
    both have at most EXACT_ROWS rows, else the Kolmogorov series of d * sqrt(n m / (n + m))."""
    z = d * F.sqrt(n.cast("double") * m / (n + m))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * z * z))
    limit = F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    exact = (n > 0) & (m > 0) & (F.greatest(n, m) <= EXACT_ROWS) & (z < FAR)
    return F.when(z <= 0, F.lit(1.0)).when(exact, _exact_ks(d, n, m, exact)).otherwise(limit)


def _exact_ks(d: Column, n: Column, m: Column, on: Column) -> Column:
    """The chance that a random order of n and m values has a distance of at least ``d``.

    An order is a lattice path: after s values, i of them from the first side, it stands at
    (i, s - i), and its distance there is |i m - (s - i) n| / (n m). Going s = 1, 2, ..., n + m,
    the share of the paths to each point that have stayed nearer than ``d`` is that of the point
    before on the same side, times its chance of being the point before (i / s, or (s - i) / s).
    Only points nearer than ``d`` are kept: a band of some 2 d n m / (n + m) points."""
    dist = F.round(d * n * m).cast("bigint")

    def step(state, s):
        lo = F.greatest(F.lit(0).cast("bigint"), s - m, F.floor((s * n - dist) / (n + m)) + 1)
        hi = F.least(n, s, F.ceil((s * n + dist) / (n + m)) - 1)
        before, at = state["share"], state["lo"]
        share = F.when(lo <= hi, F.transform(F.sequence(lo, hi), lambda i: (
            F.coalesce(F.get(before, (i - 1 - at).cast("int")), F.lit(0.0)) * i
            + F.coalesce(F.get(before, (i - at).cast("int")), F.lit(0.0)) * (s - i)) / s)).otherwise(F.array().cast("array<double>"))
        return F.struct(lo.alias("lo"), share.alias("share"))

    start = F.struct(F.lit(0).cast("bigint").alias("lo"), F.array(F.lit(1.0)).alias("share"))
    steps = F.when(on, F.sequence(F.lit(1).cast("bigint"), n + m)).otherwise(F.array().cast("array<bigint>"))
    inside = F.aggregate(steps, start, step)["share"]
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.coalesce(F.get(inside, F.lit(0)), F.lit(0.0)))


def psi(counts: DataFrame, batch_cols: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    """H5: population stability index on bins at linearly interpolated
    percentiles of the pooled values (duplicate edges removed, last bin
    closed, +1e-10 per bin, normalised); fewer than 2 edges -> 0.

    Edges (at most ``n_bins + 1`` numbers per group) are joined to the value
    counts; nothing is collected, however many batches there are."""
    g = [*batch_cols, "feature"]
    pooled = counts.withColumn("w", F.col("n_ref") + F.col("n_cur"))
    qs = [i / n_bins for i in range(n_bins + 1)]
    edges = (exact_quantiles(pooled, "value", qs, g, weight_col="w")
             .groupBy(*g).agg(F.array_sort(F.collect_set("value")).alias("edges")))
    # the interior edges decide the bin (v < e1 -> 0, e1 <= v < e2 -> 1, ...): the last bin is closed
    inner = F.slice("edges", 2, F.size("edges") - 2)
    binned = (counts.join(edges.where(F.size("edges") >= 2), g)
                    .withColumn("bin", F.size(F.filter(inner, lambda e: e <= F.col("value"))))
                    .groupBy(*g, "bin").agg(F.sum("n_ref").alias("c_ref"), F.sum("n_cur").alias("c_cur")))
    spine = (edges.where(F.size("edges") >= 2)
                  .select(*g, F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin")))
    full = (spine.join(binned, [*g, "bin"], "left")
                 .select(*g, "bin", (F.coalesce("c_ref", F.lit(0)) + EPS).alias("e"),
                         (F.coalesce("c_cur", F.lit(0)) + EPS).alias("a")))
    sums = full.groupBy(*g).agg(F.sum("e").alias("se"), F.sum("a").alias("sa"))
    val = (full.join(sums, g)
               .select(*g, (F.col("e") / F.col("se")).alias("e"), (F.col("a") / F.col("sa")).alias("a"))
               .groupBy(*g).agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi")))
    return (edges.select(*g).join(val, g, "left")
                 .select(*g, F.coalesce("psi", F.lit(0.0)).alias("psi")))


def erfc(x: Column) -> Column:
    """Complementary error function (Chebyshev fit, |rel. error| < 1.2e-7),
    for x >= 0.  Spark SQL has no erf."""
    t = 1.0 / (1.0 + 0.5 * x)
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
              1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def chi2_sf(x: Column, dof: Column) -> Column:
    """Chi-square survival function in closed form for 1-4 degrees of
    freedom (enough for the at-most-5-category test); 0 dof -> 1."""
    h = x / 2.0
    return (F.when(dof <= 0, F.lit(1.0))
             .when(dof == 1, erfc(F.sqrt(h)))
             .when(dof == 2, F.exp(-h))
             .when(dof == 3, erfc(F.sqrt(h)) + F.sqrt(2.0 * x / math.pi) * F.exp(-h))
             .when(dof == 4, F.exp(-h) * (1.0 + h)))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL, which the result has once (those of the left side)."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__{k}"]) for k in keys])
    return left.join(r, on, how).drop(*[f"__{k}" for k in keys])


def chi_square_test(counts: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """H6: categories = values seen on either side; statistic
    sum (c - r')^2 / r' with +1e-10 per cell and the expected counts
    rescaled to the current total; p from chi2(k - 1)."""
    g = [*batch_cols, "feature"]
    c = counts.select(*g, (F.col("n_ref") + EPS).alias("r"), (F.col("n_cur") + EPS).alias("c"))
    tot = c.groupBy(*g).agg(F.sum("r").alias("sr"), F.sum("c").alias("sc"), F.count(F.lit(1)).alias("k"))
    stat = (_null_safe(c, tot, g)
             .select(*g, "k", (F.col("r") * F.col("sc") / F.col("sr")).alias("r2"), "c")
             .groupBy(*g).agg(F.sum(F.pow(F.col("c") - F.col("r2"), 2) / F.col("r2")).alias("chi2_statistic"),
                              F.first("k").alias("k")))
    return stat.withColumn("chi2_pvalue", chi2_sf(F.col("chi2_statistic"), F.col("k") - 1)).drop("k")


#: Rank buckets of a feature of the reference, for looking up its order statistics.
RANK_BUCKETS = 4096


def order_statistics(ref: DataFrame, cur: DataFrame, totals: DataFrame, qs: Sequence[float],
                     batch_cols: Sequence[str] = ()) -> DataFrame:
    """Per (batch, feature): ``ks_statistic`` and ``stats``, the pooled order statistics around the
    quantiles ``qs`` (two each, at floor and ceil of q (n - 1)) with the rows of the reference
    (rl, re) and of the batch (cl, ce) below and up to each.

    One running count: the counts of both sides meet in value ranges of the feature, dealt out and
    sorted once; those of the reference, taken once whatever the number of batches, are carried into
    the values of all batches, and every batch has its own. A pooled order statistic is either a
    value of the batch, known from its own row, or a value that only the reference has, looked up
    by its rank there (rank buckets hold a bounded share of the reference, so no feature is one
    key). ``ref`` (feature, value, n) and ``cur`` (batch..., feature, value, n) are counts;
    ``totals`` has n_ref and n_cur, none 0, of each (batch, feature) asked for. ``k_both``: values
    of the batch that the reference has."""
    from churnlake.session import cut_lineage
    g = [*batch_cols, "feature"]
    zero = F.lit(0).cast("bigint")
    both = (ref.select("feature", "value", F.lit(False).alias("__own"), F.col("n").alias("n_ref"), zero.alias("n"))
            .unionByName(cur.select(*g, "value", F.lit(True).alias("__own"), zero.alias("n_ref"), "n"), allowMissingColumns=True))
    ranged, _, _ = value_ranges(both, "value", ["feature"])
    by_range = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut_lineage(ranged.groupBy(*g, "__own", "__range").agg(F.sum("n_ref").alias("n_ref"), F.sum("n").alias("n")))
    before = (sizes.groupBy("feature", "__range").agg(F.sum("n_ref").alias("n_ref"))
              .select("feature", "__range", F.coalesce(F.sum("n_ref").over(by_range.partitionBy("feature")), zero).alias("off_ref")))
    own_before = (sizes.where("__own").select(*g, "__range", F.coalesce(F.sum("n").over(by_range.partitionBy(*g)), zero).alias("off")))
    # the ranges of a feature are dealt out once: the windows below are within (feature, range)
    at = Window.partitionBy("feature", "__range")
    rows = ranged.select(*g, "value", "__own", "n", "__range",
                         F.sum("n_ref").over(at.orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("re"),
                         F.sum("n_ref").over(Window.partitionBy("feature", "__range", "value")).alias("n_ref")) \
        .withColumn("ce", F.sum("n").over(Window.partitionBy("feature", "__range", "__own", *batch_cols).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    rows = cut_lineage(rows)
    few = sizes.count()
    known = (rows.where("not __own").join(_few(before, few), ["feature", "__range"])
             .select("feature", "value", "n_ref", (F.col("re") + F.col("off_ref")).alias("cum_n_ref")))
    rows = rows.where("__own").join(_few(before, few), ["feature", "__range"])
    rows = _null_safe(rows, _few(own_before, few), [*g, "__range"])
    rows = _null_safe(rows, _few(totals.select(*g, F.col("n_ref").alias("m_ref"), F.col("n_cur").alias("m_cur")), few), g)
    re, ce = F.col("re") + F.col("off_ref"), F.col("ce") + F.col("off")
    rows = rows.select(*g, "__range", "value", "m_ref", "m_cur", (re - F.col("n_ref")).alias("rl"), re.alias("re"),
                       (ce - F.col("n")).alias("cl"), ce.alias("ce"))
    rl, re, cl, ce, m, n = (F.col(c) for c in ("rl", "re", "cl", "ce", "m_ref", "m_cur"))
    ends = cut_lineage(rows.groupBy(*g, "__range").agg(
        F.max(F.greatest(F.abs(re / m - ce / n), F.abs(rl / m - cl / n))).alias("d"), F.count_if(rl < re).alias("k"),
        F.max(re + ce).alias("last"), F.max("m_ref").alias("m_ref"), F.max("m_cur").alias("m_cur")))
    per = cut_lineage(ends.groupBy(*g).agg(F.max("d").alias("ks_statistic"), F.sum("k").alias("k_both"),
                                           F.max("m_ref").alias("m_ref"), F.max("m_cur").alias("m_cur")))
    position = [F.lit(float(q)) * (m + n - 1) for q in qs]
    rank = [r for p in position for r in (F.floor(p), F.ceil(p))]
    each = per.select(*g, "m_ref", "m_cur", F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), r.alias("r")) for j, r in enumerate(rank)])).alias("x")).select(*g, "m_ref", "m_cur", "x.*")
    # the first value of the batch whose pooled running count exceeds a rank is sought in one range only
    each = cut_lineage(_null_safe(each, ends.select(*g, "__range", "last"), g)
                       .groupBy(*g, "m_ref", "m_cur", "j", "r").agg(F.min(F.when(F.col("last") > F.col("r"), F.col("__range"))).alias("__range")))
    sought = each.where(F.col("__range").isNotNull()).select(*g, "__range", "j", "r")
    first = (_null_safe(rows.drop("m_ref", "m_cur"), _few(sought, each.count()), [*g, "__range"]).where(re + ce > F.col("r"))
             .groupBy(*g, "j").agg(F.min(F.struct((re + ce).alias("at"), F.col("value").alias("v"), "rl", "re", "cl", "ce")).alias("s")))
    each = _null_safe(each.drop("__range"), first, [*g, "j"], "left").withColumn("k", F.coalesce("s.cl", "m_cur"))
    each = cut_lineage(each.withColumn("s", F.when(F.col("s.rl") + F.col("s.cl") <= F.col("r"), F.struct("s.v", "s.rl", "s.re", "s.cl", "s.ce"))))
    width = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("m_ref") / RANK_BUCKETS))
    asked = each.where(F.col("s").isNull()).drop("s").withColumn("t", F.col("r") - F.col("k")).withColumn("bucket", F.floor(F.col("t") / width))
    asked = cut_lineage(asked)
    size = ref.groupBy("feature").agg(F.sum("n").alias("m_ref"))  # a row per feature
    held = (known.where("n_ref > 0").join(F.broadcast(size), "feature")
            .select("feature", "value", "n_ref", "cum_n_ref", F.explode(F.sequence(
                F.floor((F.col("cum_n_ref") - F.col("n_ref")) / width), F.floor((F.col("cum_n_ref") - 1) / width))).alias("bucket")))
    found = (held.join(_few(asked, asked.count()), ["feature", "bucket"])
             .where((F.col("t") >= F.col("cum_n_ref") - F.col("n_ref")) & (F.col("t") < F.col("cum_n_ref")))
             .select(*g, "j", F.struct(F.col("value").alias("v"), (F.col("cum_n_ref") - F.col("n_ref")).alias("rl"),
                                       F.col("cum_n_ref").alias("re"), F.col("k").alias("cl"), F.col("k").alias("ce")).alias("s")))
    both = each.where(F.col("s").isNotNull()).select(*g, "j", "s").unionByName(found)
    stats = both.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("j", "s"))).alias("stats"))  # two per quantile
    return _null_safe(per.select(*g, "ks_statistic", "k_both"), stats, g, "left")


def edges_of_statistics(stats: Column, n_ref: Column, n_cur: Column, qs: Sequence[float]) -> Column:
    """array<struct<e, r, c>>: the interpolated quantiles and the rows of both sides below each,
    known from the order statistics, whether the edge is a value or lies between two neighbours."""
    def edge(i, q):
        lo, hi = F.get(stats, F.lit(2 * i))["s"], F.get(stats, F.lit(2 * i + 1))["s"]
        p = F.lit(float(q)) * (n_ref + n_cur - 1)
        e = lo["v"] + (hi["v"] - lo["v"]) * (p - F.floor(p))

        def below(lt, le):
            return F.when(e <= lo["v"], lo[lt]).when(e >= hi["v"], hi[lt]).otherwise(lo[le])
        return F.struct(e.alias("e"), below("rl", "re").alias("r"), below("cl", "ce").alias("c"))

    return F.array(*[edge(i, q) for i, q in enumerate(qs)])


def psi_of_edges(edges: Column, n_ref: Column, n_cur: Column) -> Column:
    """H5 from the edges with the rows of both sides below each (``edges_of_statistics``). Equal
    edges are one; the last bin is closed; +1e-10 per bin, normalised; fewer than 2 edges -> 0."""
    def total(es):
        bins = F.size(es) - 1
        se, sa = n_ref + EPS * bins, n_cur + EPS * bins

        def term(j):
            first, last = j == 0, j == bins - 1
            up = F.get(es, j + 1)
            r = F.when(last, n_ref).otherwise(up["r"]) - F.when(first, 0).otherwise(F.get(es, j)["r"])
            c = F.when(last, n_cur).otherwise(up["c"]) - F.when(first, 0).otherwise(F.get(es, j)["c"])
            e, a = (r + EPS) / se, (c + EPS) / sa
            return (a - e) * F.log(a / e)
        terms = F.transform(F.sequence(F.lit(0), bins - 1), term)
        return F.when(bins < 1, F.lit(0.0)).otherwise(F.aggregate(terms, F.lit(0.0), lambda x, y: x + y))

    distinct = F.transform(F.array(edges), lambda all_: F.filter(
        all_, lambda x, i: (i == 0) | (x["e"] != F.get(all_, i - 1)["e"])))
    return F.transform(distinct, total)[0]


def column_drift(ref: DataFrame, cur: DataFrame, features: Sequence[str] | None = None,
                 params: Params = Params(), batch_cols: Sequence[str] = ()) -> DataFrame:
    """H7: per feature: fewer than ``min_samples`` values on a side -> no
    test (score 0, p 1); at most 5 distinct values -> chi-square (score =
    p); else KS with PSI (score = KS statistic; drift when p < .05 or
    PSI > .2).  Scores and p-values rounded to 4 (half-even).

    One running count of the reference and one of the batches give every
    statistic (``order_statistics``)."""
    from churnlake.session import cut_lineage
    if features is None:
        features = [c for c in ref.columns if c in cur.columns]
    g = [*batch_cols, "feature"]
    rc = cut_lineage(_long(ref, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    cc = cut_lineage(_long(cur, features, batch_cols).groupBy(*g, "value").agg(F.count(F.lit(1)).alias("n")))
    ref_size = rc.groupBy("feature").agg(F.sum("n").alias("n_ref"), F.count(F.lit(1)).alias("k_ref"))
    cur_size = cc.groupBy(*g).agg(F.sum("n").alias("n_cur"), F.count(F.lit(1)).alias("k_cur"))
    joined = cur_size.join(ref_size, "feature", "left" if batch_cols else "full")
    zero = F.lit(0).cast("bigint")
    sides = cut_lineage(joined.select(*g, *[F.coalesce(c, zero).alias(c) for c in ("n_ref", "n_cur", "k_ref", "k_cur")]))
    few = (F.col("n_ref") < params.min_samples) | (F.col("n_cur") < params.min_samples)
    qs = [i / 10 for i in range(11)]
    os_ = order_statistics(rc, cc, sides.where(~few), qs, batch_cols)
    # a side too small for a test has no count of the values that both have: none is needed
    summ = cut_lineage(_null_safe(sides, os_, g, "left")
                       .withColumn("n_unique", F.col("k_ref") + F.col("k_cur") - F.coalesce("k_both", zero)).drop("k_ref", "k_cur", "k_both"))
    cat = F.col("n_unique") <= params.categorical_max_distinct
    # at most five values: the counts of these features are a few rows
    cats = summ.where(~few & cat).select(*g)
    small = rc.join(ref_size.where(F.col("k_ref") <= params.categorical_max_distinct).select("feature"), "feature", "left_semi")
    counts = (cats.join(small, "feature").select(*g, "value", F.col("n").alias("n_ref"), zero.alias("n_cur"))
              .unionByName(_null_safe(cc, cats.withColumn("__cat", F.lit(True)), g).select(*g, "value", zero.alias("n_ref"), F.col("n").alias("n_cur")))
              .groupBy(*g, "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")))
    ch = chi_square_test(counts, batch_cols)
    j = _null_safe(summ, ch, g, "left")
    # one row per (batch, feature): the edges are computed once
    j = cut_lineage(j.withColumn("edges", edges_of_statistics(F.col("stats"), F.col("n_ref"), F.col("n_cur"), qs)).drop("stats"))
    j = j.withColumn("ks_pvalue", F.when(~few & ~cat, ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")))) \
         .withColumn("psi", F.when(~few & ~cat, psi_of_edges(F.col("edges"), F.col("n_ref"), F.col("n_cur"))))
    test = F.when(few, "none").when(cat, "chi_square").otherwise("ks")
    score = F.when(few, 0.0).when(cat, F.col("chi2_pvalue")).otherwise(F.col("ks_statistic"))
    pval = F.when(few, 1.0).when(cat, F.col("chi2_pvalue")).otherwise(F.col("ks_pvalue"))
    drifted = (F.when(few, False)
                .when(cat, F.col("chi2_pvalue") < params.ks_pvalue_threshold)
                .otherwise((F.col("ks_pvalue") < params.ks_pvalue_threshold) | (F.col("psi") > params.psi_threshold)))
    return j.select(*g, test.alias("test"), F.bround(score, 4).alias("drift_score"),
                    F.bround(pval, 4).alias("p_value"), "psi", drifted.alias("drifted"),
                    F.col("n_ref").cast("bigint").alias("n_ref"), F.col("n_cur").cast("bigint").alias("n_cur"))


def drift_report(col_drift: DataFrame, n_reference_samples, n_current_samples,
                 params: Params = Params(), batch_cols: Sequence[str] = ()) -> DataFrame:
    """H8: one row per batch: drifted share and status (>= .30 critical,
    >= .15 warning, else ok); ``dataset_drift`` uses share > .15."""
    share = F.col("n_drifted_features") / F.col("n_features")
    r = col_drift.groupBy(*batch_cols).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if("drifted").alias("n_drifted_features"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))), ",")
         .alias("drifted_features"))
    status = (F.when(share >= params.drift_critical_share, "critical")
               .when(share >= params.drift_warning_share, "warning").otherwise("ok"))
    nref = n_reference_samples if isinstance(n_reference_samples, Column) else F.lit(n_reference_samples)
    ncur = n_current_samples if isinstance(n_current_samples, Column) else F.lit(n_current_samples)
    return r.select(*batch_cols, status.alias("status"), "n_features", "n_drifted_features",
                    F.bround(share, 4).alias("drift_share"), (share > params.drift_warning_share).alias("dataset_drift"),
                    nref.cast("bigint").alias("n_reference_samples"), ncur.cast("bigint").alias("n_current_samples"),
                    "drifted_features")


def drift_history(reports: DataFrame, ts_col: str, params: Params = Params()) -> DataFrame:
    """Drift share over time with the warning / critical limits and
    a flag on the latest report."""
    from churnlake.functions.stats import lit_value
    latest = lit_value(reports, F.max(ts_col))
    return reports.withColumn("is_latest", F.col(ts_col) == latest) \
        .select(ts_col, "drift_share", "status", F.lit(params.drift_warning_share).alias("warning_limit"),
                F.lit(params.drift_critical_share).alias("critical_limit"), "is_latest")


def latest_reference(versions: DataFrame, keep: int = 3, version_col: str = "ref_version") -> DataFrame:
    """H2: per stored reference version: rows, newest flag, and whether
    retention keeps it (the ``keep`` newest)."""
    v = versions.groupBy(version_col).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.orderBy(F.col(version_col).desc())   # one row per version: tiny
    return v.select(version_col, "n_rows", (F.dense_rank().over(w) == 1).alias("is_latest"),
                    (F.dense_rank().over(w) <= keep).alias("retained"))
