"""Data-quality rules for feature rows (D1-D6): the scoring request
contract re-aimed at a feature table.  Rules are parameters; every failed
rule is reported (not only the first)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.params import FEATURES

# Range rules of the request contract (fixed values): column -> (min, max).
RANGE_RULES = {
    "user_id": (1, None), "days_since_last_order": (0, None), "tenure_days": (0, None),
    "total_orders": (0, None), "std_days_between_orders": (0, None), "orders_last_30_days": (0, None),
    "avg_order_value": (0, None), "avg_rating": (1, 5), "coupon_usage_count": (0, None),
    "coupon_usage_rate": (0, 1), "n_plan_changes": (0, None), "monthly_price": (0, None),
    "subscription_tenure_days": (0, None), "avg_app_logins": (0, None), "avg_meals_skipped": (0, None),
    "total_support_tickets": (0, None), "age": (18, 100), "age_group_code": (0, 3),
}

# Request defaults for absent fields (fixed values): 0 except these.
REQUEST_DEFAULTS = {"avg_rating": 3.5, "age": 30}


def _rules_array(rules: list[tuple[str, Column]]) -> Column:
    """Names of the failed rules; a NULL test counts as not failed."""
    arr = F.array(*[F.when(F.coalesce(failed, F.lit(False)), F.lit(name)) for name, failed in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def range_rules(ranges: dict = RANGE_RULES) -> list[tuple[str, Column]]:
    out = []
    for c, (lo, hi) in ranges.items():
        if lo is not None:
            out.append((f"{c}_min", F.col(c) < lo))
        if hi is not None:
            out.append((f"{c}_max", F.col(c) > hi))
    return out


def business_rules() -> list[tuple[str, Column]]:
    c = F.col
    zero = c("total_orders") == 0
    return [
        ("orders_30_le_total", c("orders_last_30_days") > c("total_orders")),
        ("coupons_le_total", c("coupon_usage_count") > c("total_orders")),
        ("sub_tenure_le_tenure", c("subscription_tenure_days") > c("tenure_days")),
        ("recency_le_tenure", (c("tenure_days") > 0) & (c("days_since_last_order") > c("tenure_days"))),
        ("no_orders_no_recent", zero & (c("orders_last_30_days") != 0)),
        ("no_orders_no_coupons", zero & (c("coupon_usage_count") != 0)),
        ("no_orders_no_rate", zero & (c("coupon_usage_rate") != 0)),
    ]


def range_violations(df: DataFrame, ranges: dict = RANGE_RULES, out: str = "violations") -> DataFrame:
    """Array of failed range rules per row."""
    present = {k: v for k, v in ranges.items() if k in df.columns}
    return df.withColumn(out, _rules_array(range_rules(present)))


def business_rule_violations(df: DataFrame, out: str = "violations") -> DataFrame:
    """Array of failed cross-field rules per row."""
    return df.withColumn(out, _rules_array(business_rules()))


def all_violations(df: DataFrame, ranges: dict = RANGE_RULES, out: str = "violations") -> DataFrame:
    present = {k: v for k, v in ranges.items() if k in df.columns}
    return df.withColumn(out, _rules_array(range_rules(present) + business_rules()))


def schema_check(df: DataFrame, expected=("user_id", *FEATURES)) -> DataFrame:
    """D3: per column 'ok', 'missing' or 'unknown' against the contract,
    with the rows that carry a value, carry none, or carry one that is not a
    number (one aggregate over the rows, no pass per column)."""
    have = list(df.columns)
    status = [(c, "ok" if c in have else "missing") for c in expected]
    status += [(c, "unknown") for c in have if c not in expected]
    one = F.lit(1)
    per = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"),
                    (F.count(c) if c in have else F.count(F.lit(None))).alias("n_values"),
                    (F.count(one) - F.count(c) if c in have else F.count(one)).alias("n_null"),
                    (F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()) if c in have
                     else F.count(F.lit(None))).alias("n_not_numeric")) for c, s in status]
    return df.agg(F.array(*per).alias("columns")).select(F.explode("columns").alias("x")).select("x.*")


def default_features(df: DataFrame, features=FEATURES, defaults=REQUEST_DEFAULTS) -> DataFrame:
    """Absent or NULL request fields -> 0, avg_rating 3.5, age 30."""
    cols = []
    for f in features:
        d = F.lit(defaults.get(f, 0))
        cols.append(F.coalesce(F.col(f), d).alias(f) if f in df.columns else d.alias(f))
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, *cols)


def quarantine_split(df: DataFrame, ranges: dict = RANGE_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their reasons). The judged rows are
    written once and both branches read them: the matrix is computed once, and
    the optimizer doesn't copy its rules into the filters that it infers."""
    from churnlake.session import cut_lineage
    v = cut_lineage(all_violations(df, ranges))
    return (v.where(F.size("violations") == 0).drop("violations"), v.where(F.size("violations") > 0))


def rule_counts(invalid: DataFrame) -> DataFrame:
    return invalid.select(F.explode("violations").alias("rule")).groupBy("rule").agg(
        F.count(F.lit(1)).alias("n_rows"))


def align_features(df: DataFrame, features=FEATURES, key: str = "user_id") -> DataFrame:
    """Trained column order, missing -> 0, extras dropped, all double.
    Values that do not convert become NULL (``try_cast``) and are counted
    by ``non_numeric_counts``."""
    cols = [F.col(f).try_cast("double").alias(f) if f in df.columns else F.lit(0.0).alias(f) for f in features]
    return df.select(*([key] if key in df.columns else []), *cols)


def checked_align(df: DataFrame, features=FEATURES, key: str = "user_id") -> DataFrame:
    """D6 as the scoring entry: an input without rows, or with values that
    are no numbers, is an error that names the columns (one aggregate)."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(F.col(f).isNotNull() & F.col(f).try_cast("double").isNull()).alias(f)
                      for f in features if f in df.columns]).first().asDict()
    if not counts.pop("__rows"):
        raise ValueError("no rows to score")
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"values that are not numeric: {bad}")
    return align_features(df, features, key)


def non_numeric_counts(df: DataFrame, features=FEATURES) -> DataFrame:
    present = [f for f in features if f in df.columns]
    return df.agg(*[F.count_if(F.col(f).isNotNull() & F.col(f).try_cast("double").isNull()).alias(f)
                    for f in present])
