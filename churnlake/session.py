"""Spark session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "churnlake") -> SparkSession:
    """Session with the settings every job here relies on.

    UTC session time zone (zone-less driver timestamps are read as wall
    clock), AQE with partition coalescing and skew-join splitting.  On a
    cluster the master and sizes come from spark-submit; the arguments are
    for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        # Local runs only: a cluster sizes the driver through spark-submit.
        b = b.master(master).config("spark.driver.memory", "8g")
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may go without: it gets a scratch folder.
    On a cluster a driver-local folder would be invisible to the executors,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="churnlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables under the shared checkpoint folder
    (``spark.checkpoint.dir``); only when none is configured (local runs,
    tests) under a scratch folder."""
    import uuid
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
