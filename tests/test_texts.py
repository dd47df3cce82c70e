"""Retention texts (the reference's text tests plus rounding cases)."""

from pyspark.sql import functions as F

from churnlake.operators import scoring as S

EXPL = "array<struct<feature:string,value:double,impact:double>>"


def text(spark, p, risk, expl):
    df = spark.createDataFrame([(p, risk, expl)], f"p double, risk string, e {EXPL}")
    return df.select(S.recommendation(F.col("p"), F.col("risk"), F.col("e")).alias("t")).first()["t"]


def test_high_risk_text(spark):
    e = [("days_since_last_order", 35.0, .15), ("avg_rating", 2.0, .08), ("total_support_tickets", 5.0, .05),
         ("subscription_tenure_days", 480.0, -.10)]
    t = text(spark, .8, "High", e)
    assert "HIGH" in t and "Risk signals" in t and "Strengths to leverage" in t
    assert "Hasn't ordered in 35 days — disengagement signal (impact: +0.150)" in t
    assert "Long-term subscriber — recognize milestone with a reward (impact: -0.100)" in t
    assert t.startswith("⚠ HIGH CHURN RISK (P=80.00%).") and not t.endswith("\n")
    assert "  1. Send personalized re-engagement offer with free delivery on next order" in t


def test_low_and_medium_fallbacks(spark):
    assert text(spark, .01, "Low", None) == \
        "Low risk (P=1.00%). No action needed. User shows healthy engagement patterns."
    m = text(spark, .2, "Medium", None)
    assert m.startswith("At-risk (P=20.00%). Recommend proactive retention:")
    assert m.endswith("  - Offer a free recipe consultation")


def test_low_with_strength(spark):
    t = text(spark, .01, "Low", [("avg_rating", 4.5, -.2), ("age", 30.0, -.3)])
    assert t.endswith("Strength: Demographic profile is well-served — maintain targeting.")


def test_half_even_number_format(spark):
    df = spark.createDataFrame([(2.5, 0.125, 0.5)], "a double, b double, c double")
    r = df.select(S.fmt(F.col("a"), 0).alias("a"), S.fmt(F.col("b"), 2).alias("b"),
                  S.fmt(F.col("c"), 0, percent=True).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (format(2.5, ".0f"), format(0.125, ".2f"), format(0.5, ".0%"))
