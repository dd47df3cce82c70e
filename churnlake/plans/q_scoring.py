"""Registered queries: quality rules (D1-D6) and scoring / explanation
(G1-G7) on the feature matrix, with a given linear model (the demo model
below: coefficients over standardised features, intercept, threshold)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import quality as Q
from churnlake.operators import scoring as S
from churnlake.operators import texts as T
from churnlake.params import FEATURES
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.registry import query
from churnlake.session import cut_lineage

# Demo model (query parameters, not fitted): one coefficient per feature
# in FEATURES order, over standardised values.
DEMO_COEFFICIENTS = [0.45, -0.30, -0.25, 0.10, -0.35, -0.05, -0.20, 0.08, 0.12, 0.15,
                     -0.10, 0.18, -0.22, 0.16, 0.20, 0.02, 0.01]
DEMO_INTERCEPT = -1.6
DEMO_THRESHOLD = 0.1373


def _matrix(spark, sf_dir):
    return Domain(spark, sf_dir, P).matrix


def _scored(spark, sf_dir, explain=False):
    m = cut_lineage(_matrix(spark, sf_dir))     # read by the scaler and by the scores
    return S.batch_score(m, S.scaler_stats(m), DEMO_COEFFICIENTS, DEMO_INTERCEPT, DEMO_THRESHOLD, explain)


def _contrib(spark, sf_dir):
    m = cut_lineage(_matrix(spark, sf_dir))
    return S.linear_score(S.standardized(m, S.scaler_stats(m)), DEMO_COEFFICIENTS, DEMO_INTERCEPT)


# --- SQL pieces ---------------------------------------------------------------

def sql_str(text: str) -> str:
    """SQL literal for a text that may hold newlines."""
    parts = text.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


def sql_fmt(x: str, decimals: int, percent: bool = False) -> str:
    scale = 10 ** decimals * (100 if percent else 1)
    v = f"printf('%.{decimals}f', round_even(CAST({x} AS DOUBLE) * {float(scale)}, 0) / {float(10 ** decimals)})"
    return f"({v} || '%')" if percent else v


def _sql_template(template: str, value: str) -> str:
    m = S._FIELD.search(template)
    if not m:
        return sql_str(template)
    pre, post = template[:m.start()], template[m.end():]
    return f"{sql_str(pre)} || {sql_fmt(value, int(m.group(1)), m.group(2) == '%')} || {sql_str(post)}"


def _sql_case(x: str, pick) -> str:
    whens = " ".join(f"WHEN '{f}' THEN {pick(f, e)}" for f, e in T.FEATURE_TEXTS.items())
    return f"(CASE {x}.feature {whens} END)"


STATS_SQL = "st AS (SELECT {cols} FROM matrix)".format(cols=", ".join(
    [f"avg({f}) AS m_{f}" for f in FEATURES]
    + [f"CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}" for f in FEATURES]))
Z_SQL = "z AS (SELECT m.*, {cols} FROM matrix m, st)".format(cols=", ".join(
    f"(CAST(m.{f} AS DOUBLE) - st.m_{f}) / st.s_{f} AS z_{f}" for f in FEATURES))
_margin = repr(float(DEMO_INTERCEPT))
for _f, _c in zip(FEATURES, DEMO_COEFFICIENTS):
    _margin = f"({_margin} + {float(_c)!r} * z_{_f})"
SCORE_SQL = f"sc AS (SELECT *, 1.0 / (1.0 + exp(-{_margin})) AS p FROM z)"
RISK_SQL = (f"CASE WHEN p < 0.5 * {DEMO_THRESHOLD} THEN 'Low' WHEN p < 1.5 * {DEMO_THRESHOLD} THEN 'Medium' "
            f"ELSE 'High' END")
PCT = sql_fmt("p", 2, True)
EXPL_SQL = "list_slice(list_sort([{items}]), 1, 5)".format(items=", ".join(
    f"{{'k': -abs(round_even({float(c)!r} * z_{f}, 4)), 'idx': {i}, 'feature': '{f}', "
    f"'value': CAST({f} AS DOUBLE), 'impact': round_even({float(c)!r} * z_{f}, 4)}}"
    for i, (f, c) in enumerate(zip(FEATURES, DEMO_COEFFICIENTS))))


def _fallback_text_sql() -> str:
    low = f"{sql_str('Low risk (P=')} || {PCT} || {sql_str(T.LOW_FALLBACK.split('{p}')[1])}"
    med = (f"{sql_str('At-risk (P=')} || {PCT} || {sql_str(T.MEDIUM_BASE.split('{p}')[1])} || "
           + sql_str("\n\nRecommended actions:\n" + "\n".join(f"  - {a}" for a in T.MEDIUM_FALLBACK_ACTIONS)))
    high = (f"{sql_str('⚠ HIGH CHURN RISK (P=')} || {PCT} || {sql_str(T.HIGH_BASE.split('{p}')[1])} || "
            + sql_str("\n\nRecommended actions:\n"
                      + "\n".join(f"  {i}. {a}" for i, a in enumerate(T.HIGH_FALLBACK_ACTIONS, 1))))
    return f"CASE risk WHEN 'Low' THEN {low} WHEN 'Medium' THEN {med} ELSE {high} END"


def _signal_sql(x: str) -> str:
    return (_sql_case(x, lambda f, e: _sql_template(e[1], f"{x}.value"))
            + f" || ' (impact: +' || {sql_fmt(f'{x}.impact', 3)} || ')'")


def _strength_sql(x: str) -> str:
    return (_sql_case(x, lambda f, e: sql_str(e[3]))
            + f" || ' (impact: -' || {sql_fmt(f'abs({x}.impact)', 3)} || ')'")


def _action_sql(x: str) -> str:
    return _sql_case(x, lambda f, e: sql_str(e[2]))


def _explained_text_sql() -> str:
    inc = "list_filter(expl, lambda x: x.impact > 0.001)"
    dec = "list_filter(expl, lambda x: x.impact < -0.001)"
    neg = "list_filter(expl, lambda x: x.impact < 0)"
    best = f"({neg})[1]"
    low = (f"CASE WHEN len({neg}) > 0 THEN {sql_str('Low risk (P=')} || {PCT} || "
           f"{sql_str('). User is in good standing — no retention action needed. Strength: ')} || "
           f"{_sql_case(best, lambda f, e: sql_str(e[3]))} || '.' "
           f"ELSE {sql_str('Low risk (P=')} || {PCT} || {sql_str(T.LOW_FALLBACK.split('{p}')[1])} END")
    sig2 = f"list_transform(list_slice({inc}, 1, 2), lambda x: {_signal_sql('x')})"
    act2 = f"list_transform(list_slice({inc}, 1, 2), lambda x: {_action_sql('x')})"
    base_m = (f"CASE WHEN len({sig2}) > 0 THEN 'At-risk (P=' || {PCT} || '). Signals: ' || "
              f"array_to_string({sig2}, '; ') || '.' ELSE 'At-risk (P=' || {PCT} || "
              f"{sql_str(T.MEDIUM_BASE.split('{p}')[1])} END")
    med = (f"CASE WHEN len({act2}) > 0 THEN {base_m} || {sql_str(chr(10) * 2 + 'Recommended actions:' + chr(10) + '  ')}"
           f" || array_to_string(list_transform({act2}, lambda a, i: i || '. ' || a), chr(10) || '  ') "
           f"ELSE {base_m} || "
           + sql_str("\n\nRecommended actions:\n" + "\n".join(f"  - {a}" for a in T.MEDIUM_FALLBACK_ACTIONS))
           + " END")
    sig4 = f"list_transform(list_slice({inc}, 1, 4), lambda x: {_signal_sql('x')})"
    str2 = f"list_transform(list_slice({dec}, 1, 2), lambda x: {_strength_sql('x')})"
    act4 = f"list_transform(list_slice({inc}, 1, 4), lambda x: {_action_sql('x')})"
    high = (f"rtrim({sql_str('⚠ HIGH CHURN RISK (P=')} || {PCT} || {sql_str(T.HIGH_BASE.split('{p}')[1])}"
            f" || CASE WHEN len({sig4}) > 0 THEN {sql_str(chr(10) * 2 + 'Risk signals:' + chr(10))} || "
            f"array_to_string(list_transform({sig4}, lambda s: '  - ' || s || chr(10)), '') ELSE '' END"
            f" || CASE WHEN len({str2}) > 0 THEN {sql_str(chr(10) + 'Strengths to leverage:' + chr(10))} || "
            f"array_to_string(list_transform({str2}, lambda s: '  - ' || s || chr(10)), '') ELSE '' END"
            f" || CASE WHEN len({act4}) > 0 THEN {sql_str(chr(10) + 'Recommended actions:' + chr(10))} || "
            f"array_to_string(list_transform({act4}, lambda a, i: '  ' || i || '. ' || a || chr(10)), '') ELSE "
            + sql_str("\n\nRecommended actions:\n"
                      + "".join(f"  {i}. {a}\n" for i, a in enumerate(T.HIGH_FALLBACK_ACTIONS, 1)))
            + " END, chr(10) || ' ')")
    return f"CASE risk WHEN 'Low' THEN {low} WHEN 'Medium' THEN {med} ELSE {high} END"


def _scoring_sql(select: str) -> str:
    return f"""
  WITH {STATS_SQL}, {Z_SQL}, {SCORE_SQL},
  r AS (SELECT *, {RISK_SQL} AS risk, {EXPL_SQL} AS expl FROM sc)
  {select}"""


# --- D: quality rules ---------------------------------------------------------

def _range_sql(table: str) -> str:
    parts = []
    for c, (lo, hi) in Q.RANGE_RULES.items():
        if lo is not None:
            parts.append(f"SELECT user_id, '{c}_min' AS rule FROM {table} WHERE {c} < {lo}")
        if hi is not None:
            parts.append(f"SELECT user_id, '{c}_max' AS rule FROM {table} WHERE {c} > {hi}")
    return "\n  UNION ALL ".join(parts)


_BUSINESS_SQL = """
  SELECT user_id, 'orders_30_le_total' AS rule FROM matrix WHERE orders_last_30_days > total_orders
  UNION ALL SELECT user_id, 'coupons_le_total' FROM matrix WHERE coupon_usage_count > total_orders
  UNION ALL SELECT user_id, 'sub_tenure_le_tenure' FROM matrix WHERE subscription_tenure_days > tenure_days
  UNION ALL SELECT user_id, 'recency_le_tenure' FROM matrix WHERE tenure_days > 0 AND days_since_last_order > tenure_days
  UNION ALL SELECT user_id, 'no_orders_no_recent' FROM matrix WHERE total_orders = 0 AND orders_last_30_days <> 0
  UNION ALL SELECT user_id, 'no_orders_no_coupons' FROM matrix WHERE total_orders = 0 AND coupon_usage_count <> 0
  UNION ALL SELECT user_id, 'no_orders_no_rate' FROM matrix WHERE total_orders = 0 AND coupon_usage_rate <> 0"""


@query("range_violations", _range_sql("matrix"))
def q_range_violations(spark, sf_dir):
    v = Q.range_violations(_matrix(spark, sf_dir))
    return v.select("user_id", F.explode("violations").alias("rule"))


@query("business_rule_violations", _BUSINESS_SQL)
def q_business_rule_violations(spark, sf_dir):
    v = Q.business_rule_violations(_matrix(spark, sf_dir))
    return v.select("user_id", F.explode("violations").alias("rule"))


_CHECKED = ["user_id", *[f for f in FEATURES if f != "monthly_price"]]


@query("schema_check", """
  SELECT "column", status, n_values, n - n_values AS n_null, n_not_numeric FROM (
    SELECT unnest([{names}]) AS "column", unnest([{status}]) AS status, count(*) AS n, unnest([{values}]) AS n_values,
           unnest([{bad}]) AS n_not_numeric FROM matrix)""".format(
    names=", ".join(f"'{c}'" for c in [*_CHECKED, "monthly_price", "extra"]),
    status=", ".join([*["'ok'"] * len(_CHECKED), "'missing'", "'unknown'"]),
    values=", ".join([*[f"count({c})" for c in _CHECKED], "0", "count_if(user_id % 2 = 0)"]),
    bad=", ".join([*["0"] * len(_CHECKED), "0", "count_if(user_id % 6 = 0)"])), ints=["n_values", "n_null", "n_not_numeric"])
def q_schema_check(spark, sf_dir):
    """D3 over the feature rows, with one column taken away and one put in
    that is null for odd users and text for every sixth."""
    extra = F.when(F.col("user_id") % 6 == 0, "none").when(F.col("user_id") % 2 == 0, "1.5")
    m = _matrix(spark, sf_dir).select("user_id", *[f for f in FEATURES if f != "monthly_price"])
    return Q.schema_check(m.withColumn("extra", extra))


@query("default_features", "SELECT user_id, {cols} FROM joined".format(cols=", ".join(
    f"coalesce({f}, {Q.REQUEST_DEFAULTS.get(f, 0)}) AS {f}" for f in FEATURES)),
    dbl=["std_days_between_orders", "avg_order_value", "avg_rating", "coupon_usage_rate", "monthly_price",
         "avg_app_logins", "avg_meals_skipped"])
def q_default_features(spark, sf_dir):
    return Q.default_features(Domain(spark, sf_dir, P).joined_matrix.drop("churned"))


@query("quarantine_split", f"""
  SELECT rule, count(*) AS n_rows FROM ({_range_sql('matrix')} UNION ALL {_BUSINESS_SQL}) GROUP BY rule
  UNION ALL
  SELECT '__valid__', count(*) FROM matrix WHERE user_id NOT IN (
    SELECT user_id FROM ({_range_sql('matrix')} UNION ALL {_BUSINESS_SQL}))""")
def q_quarantine_split(spark, sf_dir):
    valid, invalid = Q.quarantine_split(_matrix(spark, sf_dir))
    return Q.rule_counts(invalid).unionByName(
        valid.agg(F.lit("__valid__").alias("rule"), F.count(F.lit(1)).alias("n_rows")))


@query("align_features", "SELECT user_id, {cols} FROM matrix".format(cols=", ".join(
    ("0.0" if f == "monthly_price" else f"CAST({f} AS DOUBLE)") + f" AS {f}" for f in FEATURES)),
    dbl=FEATURES)
def q_align_features(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    shuffled = m.select("user_id", *reversed([f for f in FEATURES if f != "monthly_price"]),
                        F.lit("x").alias("extra_column"))
    return Q.align_features(shuffled)


# --- G: scoring ------------------------------------------------------------------

@query("risk_level", _scoring_sql("SELECT user_id, risk AS risk_level FROM r"))
def q_risk_level(spark, sf_dir):
    return _scored(spark, sf_dir).select("user_id", "risk_level")


@query("batch_score", _scoring_sql(
    f"SELECT user_id, round_even(p, 4) AS churn_probability, risk AS risk_level, "
    f"{_fallback_text_sql()} AS business_recommendation FROM r"), dbl=["churn_probability"])
def q_batch_score(spark, sf_dir):
    return _scored(spark, sf_dir)


@query("linear_contributions", _scoring_sql(
    "SELECT user_id, feature, value, impact FROM (SELECT user_id, unnest([{items}]) AS c FROM r) "
    "CROSS JOIN LATERAL (SELECT c.feature, c.value, c.impact)".replace("{items}", ", ".join(
        f"{{'feature': '{f}', 'value': CAST({f} AS DOUBLE), 'impact': {float(c)!r} * z_{f}}}"
        for f, c in zip(FEATURES, DEMO_COEFFICIENTS)))), dbl=["value", "impact"])
def q_linear_contributions(spark, sf_dir):
    c = _contrib(spark, sf_dir).select("user_id", F.explode("contributions").alias("c"))
    return c.select("user_id", "c.feature", "c.value", "c.impact")


@query("top_contributions", _scoring_sql(
    "SELECT user_id, rank, e.feature AS feature, e.value AS value, e.impact AS impact FROM ("
    "SELECT user_id, unnest(expl) AS e, unnest(range(1, len(expl) + 1)) AS rank FROM r)"),
    dbl=["value", "impact"])
def q_top_contributions(spark, sf_dir):
    c = _contrib(spark, sf_dir).select("user_id", F.posexplode(S.top_contributions(F.col("contributions"))))
    return c.select("user_id", (F.col("pos") + 1).cast("bigint").alias("rank"), "col.feature", "col.value",
                    "col.impact")


@query("recommendation_text", _scoring_sql(
    f"SELECT user_id, risk AS risk_level, {_explained_text_sql()} AS business_recommendation FROM r"))
def q_recommendation_text(spark, sf_dir):
    return _scored(spark, sf_dir, explain=True).select("user_id", "risk_level", "business_recommendation")


@query("global_importance", _scoring_sql(
    "SELECT feature, avg(abs(impact)) AS mean_abs_impact FROM (SELECT unnest([{items}], recursive := true) FROM r) "
    "GROUP BY feature".replace("{items}", ", ".join(
        f"{{'feature': '{f}', 'impact': {float(c)!r} * z_{f}}}" for f, c in zip(FEATURES, DEMO_COEFFICIENTS)))),
    dbl=["mean_abs_impact"])
def q_global_importance(spark, sf_dir):
    return S.global_importance(_contrib(spark, sf_dir))


@query("risk_counts", _scoring_sql(
    f"SELECT risk AS risk_level, count(*) AS n_users, count(*) / (SELECT count(*) FROM r) AS share_of_users, "
    f"(SELECT count_if(round_even(p, 4) >= {DEMO_THRESHOLD}) FROM r) / (SELECT count(*) FROM r) "
    f"AS share_above_threshold FROM r GROUP BY risk"), dbl=["share_of_users", "share_above_threshold"])
def q_risk_counts(spark, sf_dir):
    return S.risk_counts(_scored(spark, sf_dir), DEMO_THRESHOLD)
