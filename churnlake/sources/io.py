"""Scans and sinks.

Parquet between stages; CSV only as an external source or hand-off; JSON
for reports.  Row counts of a write are read back from the written files
(parquet: footer metadata only).  ``DataFrame.observe`` is not used: it
leaves a non-serialisable observation manager on the session that breaks
later jobs which ship the session (Spark ML fits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (no inference); malformed
    values become NULL; empty strings read as NULL like pandas."""
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
                 .option("nullValue", "").csv(path))


def load_tables(spark: SparkSession, base: str, schemas: dict[str, str], header: bool = True) -> dict[str, DataFrame]:
    """Every raw table ``<base>/<name>.csv`` with its declared schema; a
    missing one is an error before anything is read."""
    paths = {name: first_existing(spark, [f"{base}/{name}.csv"]) for name in schemas}
    return {name: load_csv(spark, paths[name], schema, header) for name, schema in schemas.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S2 / S4 scan."""
    return spark.read.parquet(path)


def read_by_suffix(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """``.parquet`` -> parquet, anything else -> CSV with header."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first candidate path that exists (Hadoop file system check
    on the driver; metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for c in candidates:
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(conf).exists(p):
            return c
    raise FileNotFoundError(f"none of {list(candidates)} exists")


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """S3: overwrite sink; returns the number of rows written, counted on
    the written files (for parquet from the footers)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark = df.sparkSession
    if fmt == "csv":
        w.option("header", True).csv(path)
        return spark.read.option("header", True).csv(path).count()
    w.format(fmt).save(path)
    return spark.read.format(fmt).load(path).count()


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Parquet sink partitioned by a version / date column, so readers
    prune partitions."""
    return write_counted(df, path, "parquet", partition_by)


def write_reports_json(df: DataFrame, path: str, name_col: str) -> None:
    """One JSON document per report, file folder keyed by report name
    (``report=<name>/part-*.json``)."""
    df.write.mode("overwrite").partitionBy(name_col).json(path)


def read_reports(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON scan over a folder of reports; malformed files dropped; the
    source file kept per row."""
    r = spark.read.option("mode", "DROPMALFORMED")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path).withColumn("source_file", F.input_file_name())


def list_reports(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """H9: newest ``n`` reports by name with their headline fields (a top-n
    over one row per report)."""
    rep = read_reports(spark, path)
    return (rep.select("report", F.col("b").alias("batch"), "status", "drift_share",
                       "n_drifted_features", "n_features")
               .orderBy(F.col("report").desc()).limit(n))
