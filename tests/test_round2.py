"""Faults found in review: overflow, held-out labels in weights, NULL categories,
filters on timestamps, storage on a cluster, whole-input checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlake import session
from churnlake.functions.prefix import prefix_sums
from churnlake.ml.split import with_weights
from churnlake.operators import clean, drift, feature_table, features, metrics, quality
from churnlake.params import FEATURES, Params


def test_ranking_and_ks_do_not_overflow(spark, monkeypatch):
    big = 4_000_000_000
    counts = spark.createDataFrame([(0.1, 0, big), (0.9, big, 0)], "p double, pos bigint, neg bigint")
    monkeypatch.setattr(metrics, "score_counts", lambda *a, **k: counts)
    df = spark.createDataFrame([(0, 0.1), (1, 0.9)], "y int, p double")
    got = metrics.ranking_metrics(df).first()
    assert got["roc_auc"] == 1.0 and got["pr_auc"] == 1.0
    pairs = spark.createDataFrame([("f", 0.0, big, 0), ("f", 1.0, 0, big)], "feature string, value double, n_ref bigint, n_cur bigint")
    got = drift.ks_test(pairs).first()
    assert got["ks_statistic"] == 1.0 and got["ks_pvalue"] < 1e-6


def test_class_weights_ignore_held_out_labels(spark):
    rows = [(i, "train" if i < 40 else "test", int(i % 4 == 0)) for i in range(60)]
    schema = "user_id bigint, split string, churned int"
    flipped = [(i, s, c if s == "train" else 1 - c) for i, s, c in rows]
    got = []
    for data in (rows, flipped):
        df = spark.createDataFrame(data, schema)
        w = with_weights(df, fit_on=df.where("split = 'train'"))
        got.append({r["churned"]: r["weight"] for r in w.select("churned", "weight").distinct().collect()})
    assert got[0] == got[1] == {1: 2.0, 0: 40 / 60}


def test_one_hot_of_a_null_category_is_zero(spark):
    u = spark.createDataFrame([(1, None, None), (2, "keto", "google")], "user_id bigint, dietary_preference string, referral_source string")
    got = {r["user_id"]: r.asDict() for r in features.one_hot(u).collect()}
    assert all(v == 0 for k, v in got[1].items() if k != "user_id")
    assert got[2]["diet_keto"] == 1 and got[2]["referral_google"] == 1


def test_order_date_filter_reaches_the_scan(spark, tmp_path):
    rows = [(i, i % 3, dt.datetime(2001, 1, 1) + dt.timedelta(days=i), 10.0, 4, True, "morning", "a") for i in range(30)]
    o = spark.createDataFrame(rows, "order_id bigint, user_id bigint, order_date timestamp, order_value double, rating int, "
                                    "on_time_delivery boolean, delivery_hour string, meal_plan string")
    o.write.parquet(str(tmp_path / "o"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    c = clean.clean_orders(spark.read.parquet(str(tmp_path / "o")), dt.datetime(2001, 1, 5), dt.datetime(2001, 1, 20))
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date" in plan and "LessThanOrEqual(order_date" in plan
    assert c.count() == 16


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_monitored_columns_drop_only_the_user_id(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4, "x")], "user_id bigint, amount_paid double, monkey double, n int, t string")
    assert drift.monitored_columns(df) == ["amount_paid", "monkey", "n"]


def test_schema_check_reads_the_rows(spark):
    df = spark.createDataFrame([(1, "5", "a"), (2, None, "b"), (3, "x", "c")], "user_id bigint, age string, more string")
    got = {r["column"]: tuple(r)[1:] for r in quality.schema_check(df, ("user_id", "age", "avg_rating")).collect()}
    assert got == {"user_id": ("ok", 3, 0, 0), "age": ("ok", 2, 1, 1), "avg_rating": ("missing", 0, 3, 0), "more": ("unknown", 3, 0, 3)}


def test_scoring_input_errors(spark):
    good = spark.createDataFrame([(1, "30")], "user_id bigint, age string")
    assert quality.checked_align(good).first()["age"] == 30.0
    with pytest.raises(ValueError, match="age"):
        quality.checked_align(spark.createDataFrame([(1, "old")], "user_id bigint, age string"))
    with pytest.raises(ValueError, match="no rows"):
        quality.checked_align(good.limit(0))


def test_publish_numbers_rows_without_a_key(spark):
    df = spark.createDataFrame([("c", 1.0), ("a", 2.0), ("b", 3.0)], "name string, x double")
    numbered = prefix_sums(df.withColumn("one", F.lit(1)), "name", ["one"], rows_per_range=1)
    assert {r["name"]: r["cum_one"] for r in numbered.collect()} == {"a": 1, "b": 2, "c": 3}
    with pytest.raises(ValueError):
        feature_table.publish_features(df.select("x"), dt.datetime(2025, 6, 1))
    ids = df.select("x").withColumn("rank_key", (F.col("x") * 10).cast("bigint"))
    got = feature_table.publish_features(ids, dt.datetime(2025, 6, 1), order_by="rank_key")
    assert {r["rank_key"]: r["user_id"] for r in got.collect()} == {10: 1, 20: 2, 30: 3}


def test_boosted_uses_all_its_settings():
    from churnlake.ml import models
    gb = models.boosted(max_features="0.8", min_samples_leaf=3)
    assert gb.getFeatureSubsetStrategy() == "0.8" and gb.getMinInstancesPerNode() == 3
