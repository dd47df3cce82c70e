"""Versioned reference store and quarantined documents."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.session import shared_path
from churnlake.sources import versions as V


def tables(spark, n):
    return {"features": spark.range(n).withColumn("x", F.col("id") * 2.0), "predictions": spark.range(n).select(F.lit(0.5).alias("prediction"))}


def test_newest_version_and_retention(spark):
    root = shared_path(spark, "t_store")
    assert V.latest_version(spark, root) is None and V.manifests(spark, root) == []
    for k in range(1, 6):
        V.save_version(tables(spark, k), root, f"ref_2024010{k}", f"2024-01-0{k} 00:00:00", "m")
    kept = V.manifests(spark, root)
    assert [m["version"] for m in kept] == ["ref_20240105", "ref_20240104", "ref_20240103"]
    assert [m["n_samples"] for m in kept] == [5, 4, 3] and kept[0]["n_features"] == 2 and kept[0]["model_name"] == "m"
    assert V.read_version(spark, kept[0], "features").count() == 5
    assert V.read_version(spark, kept[2], "predictions").count() == 3
    fs, cls = V._fs(spark, root)
    assert len(fs.listStatus(cls(f"{root}/data"))) == 3  # the tables of removed versions are gone
    with pytest.raises(KeyError):
        V.read_version(spark, kept[0], "labels")


def test_a_crash_before_publishing_leaves_the_old_version(spark):
    root = shared_path(spark, "t_crash")
    V.save_version(tables(spark, 4), root, "ref_1", "t1")
    V.write_version(tables(spark, 9), root, "ref_2")  # and no publish
    assert V.latest_version(spark, root)["version"] == "ref_1"
    assert V.read_version(spark, V.latest_version(spark, root), "features").count() == 4
    V.save_version(tables(spark, 7), root, "ref_2", "t2")  # the same version again, after the crash
    assert V.latest_version(spark, root)["n_samples"] == 7


def test_a_published_version_is_not_overwritten(spark):
    root = shared_path(spark, "t_same")
    V.save_version(tables(spark, 2), root, "ref_1", "t1")
    with pytest.raises(FileExistsError):
        V.save_version(tables(spark, 3), root, "ref_1", "t2")
    assert V.latest_version(spark, root)["n_samples"] == 2


def test_broken_documents_are_kept_apart(spark, tmp_path):
    texts = {"a": '{\n "report": "a",\n "share": 0.5\n}', "b": '{"report": "b", "share":', "c": '{"report": "c", "share": "none"}',
             "d": '{"report": "d"}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    schema = T.StructType([T.StructField("report", T.StringType()), T.StructField("share", T.DoubleType())])
    rows = V.quarantine_documents(spark, f"file://{tmp_path}/*.json", schema, shared_path(spark, "t_docs"))
    got = {r["source_file"].rsplit("/", 1)[1][0]: r for r in rows.collect()}
    assert len(got) == 4 and [got[k]["kept"] for k in "abcd"] == [True, False, False, True]
    assert got["a"]["share"] == 0.5 and got["d"]["share"] is None and got["b"]["broken"] == texts["b"]
