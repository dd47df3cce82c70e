"""Scoring and explanation (G1-G7) as column expressions: no Python UDF,
one narrow stage per scored frame (the user id stays on the row).

A linear model is given as coefficients over standardised features; the
scaler is fitted with one aggregate (mean, population std; zero std -> 1).
Contributions are coefficient x standardised value (background zero in
scaled space), which is the exact linear-model attribution.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators import texts as T
from churnlake.functions.stats import one_row
from churnlake.params import FEATURES

_FIELD = re.compile(r"\{value:\.(\d)([f%])\}")


def fmt(x: Column, decimals: int, percent: bool = False) -> Column:
    """Python ``format(x, '.{d}f')`` / ``'.{d}%'``: round half-even on the
    scaled value first (Java's formatter rounds half-up), then print."""
    scale = 10 ** decimals * (100 if percent else 1)
    v = F.bround(x.cast("double") * F.lit(float(scale)), 0) / F.lit(float(10 ** decimals))
    s = F.format_string(f"%.{decimals}f", v)
    return F.concat(s, F.lit("%")) if percent else s


def render_template(template: str, value: Column) -> Column:
    m = _FIELD.search(template)
    if not m:
        return F.lit(template)
    pre, post = template[:m.start()], template[m.end():]
    return F.concat(F.lit(pre), fmt(value, int(m.group(1)), m.group(2) == "%"), F.lit(post))


def _by_feature(feature: Column, pick) -> Column:
    expr = None
    for name, entry in T.FEATURE_TEXTS.items():
        v = pick(name, entry)
        expr = F.when(feature == name, v) if expr is None else expr.when(feature == name, v)
    return expr


def _mapped(feature: Column) -> Column:
    return feature.isin(list(T.FEATURE_TEXTS))


def _fill(template: str, **values: Column) -> Column:
    """Concatenate a ``{name}`` template with column values."""
    parts = re.split(r"\{(\w+)\}", template)
    cols = [F.lit(x) if i % 2 == 0 else values[x] for i, x in enumerate(parts) if x != "" or i % 2]
    return F.concat(*cols)


def risk_level(p: Column, threshold: float | Column, low: float = 0.5, high: float = 1.5) -> Column:
    """G1: p < low*t -> Low; p < high*t -> Medium; else High."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(p < F.lit(low) * t, "Low").when(p < F.lit(high) * t, "Medium").otherwise("High")


def scaler_stats(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """E2 fit: one row of means and population standard deviations."""
    return df.agg(*[F.avg(f).alias(f"mean_{f}") for f in features],
                  *[F.stddev_pop(f).alias(f"std_{f}") for f in features])


def standardized(df: DataFrame, stats: DataFrame, features: Sequence[str] = FEATURES,
                 prefix: str = "z_") -> DataFrame:
    """E2 apply: (x - mean) / std, zero std -> divide by 1.  The one-row
    fit is collected (bounded: two numbers per feature) and enters as
    literals."""
    st = stats if isinstance(stats, dict) else one_row(stats)
    cols = []
    for f in features:
        mean = F.lit(st[f"mean_{f}"]).cast("double")
        std = F.lit(1.0 if not st[f"std_{f}"] else st[f"std_{f}"]).cast("double")
        cols.append(((F.col(f).cast("double") - mean) / std).alias(prefix + f))
    return df.select("*", *cols)


def linear_score(df: DataFrame, coefficients: Sequence[float], intercept: float,
                 features: Sequence[str] = FEATURES, prefix: str = "z_") -> DataFrame:
    """G2 core: margin and probability; G3: per-feature contributions as
    ``array<struct<feature, value, impact>>`` (value = unscaled feature)."""
    margin = F.lit(float(intercept))
    for f, c in zip(features, coefficients):
        margin = margin + F.lit(float(c)) * F.col(prefix + f)
    contrib = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                                 (F.lit(float(c)) * F.col(prefix + f)).alias("impact"))
                        for f, c in zip(features, coefficients)])
    return df.select("*", margin.alias("margin"), (1.0 / (1.0 + F.exp(-margin))).alias("churn_probability_raw"),
                     contrib.alias("contributions"))


def _sorted_by_abs(arr: Column) -> Column:
    """Stable sort by |impact| descending (ties keep list order)."""
    indexed = F.transform(arr, lambda e, i: F.struct(e["feature"].alias("feature"), e["value"].alias("value"),
                                                     e["impact"].alias("impact"), i.alias("idx")))

    def cmp(a, b):
        aa, bb = F.abs(a["impact"]), F.abs(b["impact"])
        return (F.when(aa > bb, -1).when(aa < bb, 1)
                 .when(a["idx"] < b["idx"], -1).when(a["idx"] > b["idx"], 1).otherwise(0))
    return F.array_sort(indexed, cmp)


def top_contributions(contributions: Column, n: int = 5, digits: int = 4) -> Column:
    """Impacts rounded to 4, the n largest |impact|, ties in feature
    order."""
    rounded = F.transform(contributions, lambda e: F.struct(
        e["feature"].alias("feature"), e["value"].alias("value"), F.bround(e["impact"], digits).alias("impact")))
    srt = _sorted_by_abs(rounded)
    return F.slice(F.transform(srt, lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value"),
                                                       e["impact"].alias("impact"))), 1, n)


def _signal(e) -> Column:
    mapped = _by_feature(e["feature"], lambda name, entry: render_template(entry[1], e["value"]))
    return F.when(_mapped(e["feature"]),
                  F.concat(mapped, F.lit(" (impact: +"), fmt(e["impact"], 3), F.lit(")"))) \
            .otherwise(F.concat(e["feature"], F.lit(" = "), fmt(e["value"], 2), F.lit(" increases risk (impact: +"),
                                fmt(e["impact"], 3), F.lit(")")))


def _strength(e) -> Column:
    action = _by_feature(e["feature"], lambda name, entry: F.lit(entry[3]))
    return F.when(_mapped(e["feature"]),
                  F.concat(action, F.lit(" (impact: -"), fmt(F.abs(e["impact"]), 3), F.lit(")"))) \
            .otherwise(F.concat(e["feature"], F.lit(" = "), fmt(e["value"], 2), F.lit(" reduces risk (impact: -"),
                                fmt(F.abs(e["impact"]), 3), F.lit(")")))


def _numbered(arr: Column, prefix: str, suffix: str) -> Column:
    return F.array_join(F.transform(arr, lambda a, i: F.concat(F.lit(prefix), (i + 1).cast("string"),
                                                               F.lit(". "), a, F.lit(suffix))), "")


def _let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def recommendation(p: Column, risk: Column, explanations: Column | None = None) -> Column:
    """Retention text per risk level from the (optional) explanation
    array, with the fixed fallbacks when there are no usable signals. The
    explanations are sorted and split once per row."""
    pct = fmt(p, 2, percent=True)
    medium_fallback = F.lit("\n\nRecommended actions:\n" + "\n".join(f"  - {a}" for a in T.MEDIUM_FALLBACK_ACTIONS))
    high_fallback = F.lit("\n\nRecommended actions:\n"
                          + "".join(f"  {i}. {a}\n" for i, a in enumerate(T.HIGH_FALLBACK_ACTIONS, 1)))

    def by_risk(low, medium, high):
        return F.when(risk == "Low", low).when(risk == "Medium", medium).otherwise(F.regexp_replace(high, r"\s+$", ""))

    if explanations is None:
        return by_risk(_fill(T.LOW_FALLBACK, p=pct), F.concat(_fill(T.MEDIUM_BASE, p=pct), medium_fallback),
                       F.concat(_fill(T.HIGH_BASE, p=pct), high_fallback))

    def actions(inc, n):
        return F.transform(F.filter(F.slice(inc, 1, n), lambda e: _mapped(e["feature"])),
                           lambda e: _by_feature(e["feature"], lambda name, entry: F.lit(entry[2])))

    def low(best):
        strength = _fill(T.LOW_STRENGTH, p=pct, s=_by_feature(best["feature"], lambda name, entry: F.lit(entry[3])))
        return F.when(best.isNotNull() & _mapped(best["feature"]), strength).otherwise(_fill(T.LOW_FALLBACK, p=pct))

    def medium(x):
        base = F.when(F.size(x["sig"]) > 0, _fill(T.MEDIUM_SIGNALS, p=pct, s=F.array_join(x["sig"], "; "))) \
                .otherwise(_fill(T.MEDIUM_BASE, p=pct))
        listed = F.array_join(F.transform(x["act"], lambda a, i: F.concat((i + 1).cast("string"), F.lit(". "), a)), "\n  ")
        return F.concat(base, F.when(F.size(x["act"]) > 0, F.concat(F.lit("\n\nRecommended actions:\n  "), listed))
                        .otherwise(medium_fallback))

    def lines(title, arr):
        each = F.transform(arr, lambda s: F.concat(F.lit("  - "), s, F.lit("\n")))
        return F.when(F.size(arr) > 0, F.concat(F.lit(title), F.array_join(each, ""))).otherwise(F.lit(""))

    def high(x):
        return F.concat(_fill(T.HIGH_BASE, p=pct), lines("\n\nRisk signals:\n", x["sig"]),
                        lines("\nStrengths to leverage:\n", x["str"]),
                        F.when(F.size(x["act"]) > 0, F.concat(F.lit("\nRecommended actions:\n"), _numbered(x["act"], "  ", "\n")))
                         .otherwise(high_fallback))

    def body(g):
        inc, dec, neg = g["inc"], g["dec"], g["neg"]
        return by_risk(
            _let(F.get(neg, F.lit(0)), low),
            _let(F.struct(F.transform(F.slice(inc, 1, 2), _signal).alias("sig"), actions(inc, 2).alias("act")), medium),
            _let(F.struct(F.transform(F.slice(inc, 1, 4), _signal).alias("sig"),
                          F.transform(F.slice(dec, 1, 2), _strength).alias("str"), actions(inc, 4).alias("act")), high))

    expl = F.coalesce(explanations, F.array().cast("array<struct<feature:string,value:double,impact:double>>"))
    return _let(_sorted_by_abs(expl), lambda srt: _let(
        F.struct(F.filter(srt, lambda e: e["impact"] > T.SIGNAL_MIN_IMPACT).alias("inc"),
                 F.filter(srt, lambda e: e["impact"] < -T.SIGNAL_MIN_IMPACT).alias("dec"),
                 F.filter(srt, lambda e: e["impact"] < 0).alias("neg")), body))


def batch_score(features_df: DataFrame, stats: DataFrame, coefficients, intercept: float, threshold: float,
                explain: bool = False, features: Sequence[str] = FEATURES) -> DataFrame:
    """Align -> standardise -> probability -> risk band -> text; the
    probability is rounded to 4 after banding.  Batch scoring passes no
    explanations (fallback texts) unless ``explain``."""
    s = linear_score(standardized(features_df, stats, features), coefficients, intercept, features)
    p = F.col("churn_probability_raw")
    risk = risk_level(p, threshold)
    expl = top_contributions(F.col("contributions")) if explain else None
    return s.select("user_id", F.bround(p, 4).alias("churn_probability"), risk.alias("risk_level"),
                    recommendation(p, risk, expl).alias("business_recommendation"),
                    *([expl.alias("explanations")] if explain else []))


def global_importance(contributions_df: DataFrame, col: str = "contributions") -> DataFrame:
    """Mean |contribution| per feature over all rows, descending."""
    return (contributions_df.select(F.explode(col).alias("e"))
              .groupBy(F.col("e.feature").alias("feature"))
              .agg(F.avg(F.abs("e.impact")).alias("mean_abs_impact")))


def risk_counts(scored: DataFrame, threshold: float, p: str = "churn_probability") -> DataFrame:
    """Users per risk band and the share scored at or above the
    threshold."""
    total = one_row(scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(p) >= threshold).alias("above")))
    n, above = F.lit(total["n"]), F.lit(total["above"])
    return (scored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_users"))
                  .select("risk_level", "n_users", (F.col("n_users") / n).alias("share_of_users"),
                          (above / n).alias("share_above_threshold")))
