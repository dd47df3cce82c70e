"""Diagnostics and leakage studies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.columns import floor_days, ts_lit
from churnlake.functions.prefix import exact_quantiles
from churnlake.functions.stats import one_row
from churnlake.operators.labels import latest_per_user
from churnlake.params import Params

# Feature groups of the correlation study (fixed values).  Names absent
# from the matrix are skipped, as in the reference.
FEATURE_GROUPS = {
    "Subscription (tenure)": ["subscription_tenure_days", "monthly_price", "n_plan_changes"],
    "Recency": ["days_since_last_order", "days_since_high_value", "days_since_last_late"],
    "Frequency": ["total_orders", "unique_meal_plans", "order_frequency_per_month", "weekend_order_ratio",
                  "mean_days_between_orders"],
    "Monetary": ["total_spent", "avg_order_value", "max_order_value", "min_order_value", "avg_rating",
                 "spending_trend", "value_variability"],
    "Engagement": ["avg_app_logins", "avg_recipes_viewed", "avg_meals_skipped", "total_support_tickets",
                   "total_referral_clicks", "login_decline", "recipe_decline", "avg_orders_per_week",
                   "recent_avg_logins", "recent_avg_recipes"],
    "Demographic": ["age", "age_group_code", "diet_balanced", "diet_keto", "diet_low_carb",
                    "diet_mediterranean", "diet_paleo", "diet_vegan"],
}


def leaky_features(subs_clean: DataFrame, users: DataFrame, params: Params = Params()) -> DataFrame:
    """From each user's latest subscription by end date: is_sub_active
    (end > S), days since cancellation (0 if active), total subscription
    days (>= 0); left-joined onto ``users`` with NULL -> 0."""
    snap = ts_lit(params.snapshot)
    tie = "subscription_id" if "subscription_id" in subs_clean.columns else None
    latest = latest_per_user(subs_clean, "user_id", ["end_date", "start_date"], ["start_date", "end_date"], tie)
    active = (F.col("end_date") > snap).cast("bigint")
    leak = latest.select("user_id", active.alias("is_sub_active"),
                         F.when(active == 0, floor_days(snap, F.col("end_date"))).otherwise(0)
                          .alias("days_since_cancellation"),
                         F.greatest(floor_days(F.col("end_date"), F.col("start_date")), F.lit(0))
                          .alias("total_subscription_days"))
    out = users.join(leak, "user_id", "left")
    return out.fillna(0, subset=["is_sub_active", "days_since_cancellation", "total_subscription_days"])


def crosstab_margins(df: DataFrame, row: str, col: str) -> DataFrame:
    """Two-way counts with 'All' margins (one ``cube``)."""
    c = df.cube(row, col).agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("gr"), F.grouping(col).alias("gc"))
    return c.select(F.when(F.col("gr") == 1, "All").otherwise(F.col(row).cast("string")).alias(row),
                    F.when(F.col("gc") == 1, "All").otherwise(F.col(col).cast("string")).alias(col), "n")


def rate_by_group(df: DataFrame, group: str, label: str = "churned") -> DataFrame:
    """Rows, positives and rate per group value."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("n_churned"),
                                 F.avg(label).alias("churn_rate"))


def duration_by_group(users: DataFrame, subs: DataFrame, group: str = "is_active") -> DataFrame:
    """Mean and (exact) median subscription days per group, and the
    ratio of the group means (true / false)."""
    j = users.select("user_id", group).join(
        subs.select("user_id", floor_days(F.col("end_date"), F.col("start_date")).alias("duration_days")), "user_id")
    means = j.groupBy(group).agg(F.avg("duration_days").alias("mean_days"), F.count(F.lit(1)).alias("n"))
    med = exact_quantiles(j, "duration_days", [0.5], [group]).select(group, F.col("value").alias("median_days"))
    r = one_row(means.agg(F.max(F.when(F.col(group), F.col("mean_days"))).alias("t"),
                          F.max(F.when(~F.col(group), F.col("mean_days"))).alias("f")))
    ratio = r["t"] / r["f"] if r["t"] is not None and r["f"] else None
    return means.join(med, group).select(group, "n", "mean_days", "median_days", F.lit(ratio).alias("ratio"))


def end_date_buckets(subs: DataFrame, params: Params = Params()) -> DataFrame:
    """End before S / within [S, S + 30d] / after; counts and shares."""
    snap, end = ts_lit(params.snapshot), ts_lit(params.label_end)
    b = F.when(F.col("end_date") < snap, "before").when(F.col("end_date") <= end, "within").otherwise("after")
    c = subs.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    total = one_row(subs.agg(F.count(F.lit(1)).alias("n")))["n"]
    return c.withColumn("share", F.col("n") / F.lit(total))


def target_correlation(df: DataFrame, features: Sequence[str], label: str = "churned", top: int | None = 15) -> DataFrame:
    """Pearson r of each feature with the label (undefined dropped),
    largest |r| first, top ``top`` (the report's size; None: all)."""
    r = df.agg(*[F.corr(F.col(f).cast("double"), F.col(label).cast("double")).alias(f) for f in features])
    long = r.unpivot([], list(features), "feature", "correlation")
    long = long.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    long = long.withColumn("abs_correlation", F.abs("correlation"))
    return long if top is None else long.orderBy(F.col("abs_correlation").desc(), "feature").limit(top)


def group_correlation(corr: DataFrame, groups: dict = FEATURE_GROUPS) -> DataFrame:
    """Max and mean |r| per feature group (small map, joined)."""
    gm = corr.sparkSession.createDataFrame([(g, f) for g, fs in groups.items() for f in fs], "grp string, feature string")
    return (corr.join(F.broadcast(gm), "feature")
                .groupBy("grp").agg(F.max("abs_correlation").alias("max_abs_r"),
                                    F.avg("abs_correlation").alias("mean_abs_r")))


def score_percentiles(scored: DataFrame, p: str = "p", label: str = "churned") -> DataFrame:
    """Overall percentiles 1..99 and per-class deciles 10..90 plus mean
    and median; long format (group, stat, value)."""
    overall = exact_quantiles(scored, p, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) \
        .select(F.lit("all").alias("grp"), F.format_string("p%02d", F.round(F.col("q") * 100).cast("int")).alias("stat"),
                "value")
    by = exact_quantiles(scored.withColumn("__g", F.col(label).cast("string")), p,
                         [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], ["__g"])
    by = by.select(F.col("__g").alias("grp"),
                   F.format_string("p%02d", F.round(F.col("q") * 100).cast("int")).alias("stat"), "value")
    means = scored.groupBy(F.col(label).cast("string").alias("grp")).agg(F.avg(p).alias("value")) \
        .select("grp", F.lit("mean").alias("stat"), "value")
    medians = by.where(F.col("stat") == "p50").select("grp", F.lit("median").alias("stat"), "value")
    return overall.unionByName(by).unionByName(means).unionByName(medians)


def score_spread(scored: DataFrame, p: str = "p", wide_above: float = 0.3) -> DataFrame:
    """Min, max, mean, population std, range; 'wide' when max > .3."""
    return scored.agg(F.min(p).alias("min_p"), F.max(p).alias("max_p"), F.avg(p).alias("mean_p"),
                      F.stddev_pop(p).alias("std_p")) \
        .withColumn("range_p", F.col("max_p") - F.col("min_p")) \
        .withColumn("spread_ok", F.col("max_p") > wide_above)


def extreme_users(scored: DataFrame, p: str = "p", key: str = "user_id", n: int = 5) -> DataFrame:
    """The n highest, n lowest and n middle users by score (ties by
    id).  The ends are top-n reports; the middle is found by rank from the
    per-score prefix counts (no global sort of all rows)."""
    from churnlake.functions.prefix import prefix_sums
    hi = scored.orderBy(F.col(p).desc(), F.col(key).desc()).limit(n).withColumn("which", F.lit("highest"))
    lo = scored.orderBy(F.col(p).asc(), F.col(key).asc()).limit(n).withColumn("which", F.lit("lowest"))
    total = one_row(scored.agg(F.count(F.lit(1)).alias("n")))["n"]
    start = total // 2 - 2
    w_sc = scored.groupBy(p).agg(F.count(F.lit(1)).alias("cnt"))
    cum = prefix_sums(w_sc, p, ["cnt"]).select(p, (F.col("cum_cnt") - F.col("cnt")).alias("before"), "cnt")
    straddle = cum.where((F.col("before") < start + n) & (F.col("before") + F.col("cnt") > start))
    rows = scored.join(straddle, p).withColumn("__one", F.lit(1))
    # rank inside a (possibly very large) tie group by key: prefix counts
    ranked = prefix_sums(rows, key, ["__one"], [p])
    mid = (ranked.withColumn("__rank", F.col("before") + F.col("cum___one") - 1)
                 .where((F.col("__rank") >= start) & (F.col("__rank") < start + n))
                 .drop("before", "cnt", "__rank", "__one", "cum___one").withColumn("which", F.lit("middle")))
    return hi.unionByName(lo).unionByName(mid)


def score_histogram(scored: DataFrame, flag: str, p: str = "p", bins: int = 20) -> DataFrame:
    """Equal-width bins over each flag value's own score range;
    density = count / (n * width). The scores are written once: the ranges
    and the bins read them."""
    from churnlake.session import cut_lineage
    scored = cut_lineage(scored.select(flag, p))
    rng = scored.groupBy(flag).agg(F.min(p).alias("lo"), F.max(p).alias("hi"), F.count(F.lit(1)).alias("n"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0 / bins))
    b = F.least(F.floor((F.col(p) - F.col("lo")) / width), F.lit(bins - 1)).cast("bigint")
    h = (scored.join(rng, flag).select(flag, b.alias("bin"), width.alias("width"), "lo", "n")
               .groupBy(flag, "bin").agg(F.count(F.lit(1)).alias("count"), F.first("width").alias("width"),
                                        F.first("lo").alias("lo"), F.first("n").alias("n")))
    return h.select(flag, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), "count",
                    (F.col("count") / (F.col("n") * F.col("width"))).alias("density"))


def mean_score_by_flag(scored: DataFrame, flag: str, p: str = "p") -> DataFrame:
    """Mean score per flag value."""
    return scored.groupBy(flag).agg(F.avg(p).alias("mean_p"), F.count(F.lit(1)).alias("n"))


def leak_importance_share(importances: DataFrame, leaked: Sequence[str]) -> DataFrame:
    """Share of total importance held by the leaked columns."""
    flagged = importances.withColumn("is_leaked", F.col("feature").isin(list(leaked)))
    return flagged.agg(F.sum(F.when(F.col("is_leaked"), F.col("importance")).otherwise(0.0)).alias("leaked"),
                       F.sum("importance").alias("total")) \
        .select("leaked", "total", (F.col("leaked") / F.col("total")).alias("leak_share"))
