"""A versioned store of drift references (H1, H2) and quarantined JSON documents.

A version is a set of Parquet tables under ``<root>/data/<version>-<id>``. It exists once its
manifest ``<root>/manifests/<version>.json`` does: the manifest is written under another name
and renamed, which the file system does at once or not at all. A job that dies before leaves
the older versions as they were; its tables are in no manifest and nobody reads them. Only
manifests, a few hundred bytes each, are handled on the driver."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

MANIFEST = ("version string, path string, timestamp string, n_samples bigint, n_features bigint, "
            "model_name string, tables map<string, bigint>")


def _fs(spark: SparkSession, path: str):
    """(file system, path class) of a path."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), cls


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file written whole under another name, then renamed; an existing one is an error."""
    fs, cls = _fs(spark, path)
    part = cls(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(cls(path)) or not fs.rename(part, cls(path)):
        fs.delete(part, False)
        raise FileExistsError(path)


def write_version(tables: dict[str, DataFrame], root: str, version: str) -> dict:
    """The tables of a version, not yet published: its manifest without time and model."""
    path, rows = f"{root}/data/{version}-{uuid.uuid4().hex[:12]}", {}
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
        rows[name] = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}").count()  # footers only
    first = next(iter(tables))
    return {"version": version, "path": path, "n_samples": rows[first], "n_features": len(tables[first].columns), "tables": rows}


def publish(spark: SparkSession, root: str, manifest: dict, timestamp: str, model_name: str = "unknown", keep: int = 3) -> None:
    """Makes a written version readable and removes those beyond the ``keep`` newest (their
    manifests first, so no reader is sent to tables that are gone). A version that was
    published before is an error."""
    _put(spark, f"{root}/manifests/{manifest['version']}.json", json.dumps({**manifest, "timestamp": timestamp, "model_name": model_name}))
    fs, cls = _fs(spark, root)
    for old in manifests(spark, root)[keep:]:
        fs.delete(cls(f"{root}/manifests/{old['version']}.json"), False)
        fs.delete(cls(old["path"]), True)


def save_version(tables: dict[str, DataFrame], root: str, version: str, timestamp: str, model_name: str = "unknown", keep: int = 3) -> None:
    """H1: tables (the first are the samples), metadata and retention in one call."""
    spark = next(iter(tables.values())).sparkSession
    publish(spark, root, write_version(tables, root, version), timestamp, model_name, keep)


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The published manifests, newest version first: at most one more than is kept."""
    fs, cls = _fs(spark, root)
    if not fs.exists(cls(f"{root}/manifests")):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(cls(f"{root}/manifests"))]
    rows = spark.read.schema(MANIFEST).option("pathGlobFilter", "*.json").json([n for n in names if n.endswith(".json")]).collect() \
        if any(n.endswith(".json") for n in names) else []
    return sorted((r.asDict() for r in rows), key=lambda r: r["version"], reverse=True)


def latest_version(spark: SparkSession, root: str) -> dict | None:
    """H2: the newest published manifest, or None."""
    found = manifests(spark, root)
    return found[0] if found else None


def read_version(spark: SparkSession, manifest: dict, table: str) -> DataFrame:
    """A table of a published version."""
    if table not in manifest["tables"]:
        raise KeyError(f"version {manifest['version']} has no table {table}")
    return spark.read.parquet(f"{manifest['path']}/{table}")


# ---------------------------------------------------------------- S6: documents that may be broken

def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents of any number of lines, one or more files. Every document gives a row:
    ``schema``'s fields, ``source_file``, and ``broken``: the text of a document that is no JSON
    or doesn't fit the schema (its other fields are NULL), else NULL."""
    fields = StructType([*schema.fields, StructField("broken", StringType())])
    return (spark.read.schema(fields).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "broken").json(path).withColumn("source_file", F.input_file_name()))


def quarantine_documents(spark: SparkSession, path: str, schema: StructType, out: str) -> DataFrame:
    """The documents of ``path`` in one pass and one write, kept and broken ones apart under
    ``out/kept=<true|false>``, read back."""
    rows = read_documents(spark, path, schema).withColumn("kept", F.col("broken").isNull())
    rows.write.mode("overwrite").partitionBy("kept").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)
