"""Scans of the driver tables (parquet).

Zone-less timestamps (``timestamp_ntz``) are cast to session-zone
timestamps at load, so window functions, watermarks and ``unix_micros``
accept them.  The cast is a projection, so column pruning and filter
pushdown still reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = [
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*casts)


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: load_table(spark, sf_dir, n) for n in (names or DRIVER_TABLES)}
