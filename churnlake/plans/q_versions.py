"""Registered queries: the versioned reference store (H1, H2), reports with their time (H9) and
quarantined documents (S5, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.columns import ts_lit
from churnlake.operators import drift as DR
from churnlake.plans.q_drift import _by_year, _drift_sql, _history, _side_exprs
from churnlake.plans.registry import query
from churnlake.session import shared_path
from churnlake.sources import versions as V
from churnlake.sources.adapters import DRIFT_SPLIT
from churnlake.sources.tables import load_table

#: Ship years published one after another, and how many the store keeps.
YEARS, KEEP = range(1994, 1999), 3


def _store(spark, sf_dir) -> str:
    """A store into which one reference per ship year was published, oldest first."""
    root = shared_path(spark, "reference_store")
    old = load_table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < ts_lit(DRIFT_SPLIT))
    for year in YEARS:
        rows = old.where(F.year("l_shipdate") == year)
        samples = rows.select(*_side_exprs())
        V.save_version({"features": samples.select(*DR.monitored_columns(samples)),
                        "predictions": rows.select((F.col("l_discount") * 10).alias("prediction"))},
                       root, f"ref_{year}0101_000000", f"{year}-01-01 00:00:00", "logistic", KEEP)
    return root


_YEARS_SQL = f"""
  SELECT 'ref_' || CAST(y AS VARCHAR) || '0101_000000' AS version, CAST(y AS VARCHAR) || '-01-01 00:00:00' AS timestamp,
         count(*) AS n_samples, 7 AS n_features, 'logistic' AS model_name, count(*) AS n_predictions, sum(l_quantity) AS sum_quantity,
         sum(l_discount * 10) AS sum_prediction, y = {max(YEARS)} AS is_latest
  FROM (SELECT *, year(l_shipdate) AS y FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00')
  WHERE y > {max(YEARS) - KEEP} GROUP BY y"""


@query("reference_store", _YEARS_SQL, dbl=["sum_quantity", "sum_prediction"], ints=["n_features"])
def q_reference_store(spark, sf_dir):
    """H1 + H2: what the store holds after five publications: the three newest versions with their
    metadata, and what their tables give when they are read."""
    root, out = _store(spark, sf_dir), None
    newest = V.latest_version(spark, root)["version"]
    for m in V.manifests(spark, root):
        f = V.read_version(spark, m, "features").agg(F.sum("l_quantity").alias("sum_quantity"))
        p = V.read_version(spark, m, "predictions").agg(F.sum("prediction").alias("sum_prediction"), F.count(F.lit(1)).alias("n_predictions"))
        one = f.join(p).select(*[F.lit(m[c]).alias(c) for c in ("version", "timestamp", "n_samples", "n_features", "model_name")],
                               "n_predictions", "sum_quantity", "sum_prediction", F.lit(m["version"] == newest).alias("is_latest"))
        out = one if out is None else out.unionByName(one)
    return out


@query("stored_reference_drift", _drift_sql("SELECT * EXCLUDE (b) FROM coldrift").replace(
    "l_shipdate < TIMESTAMP '1998-06-01 00:00:00'", f"l_shipdate < TIMESTAMP '1998-06-01 00:00:00' AND year(l_shipdate) = {max(YEARS)}"),
       dbl=["drift_score", "p_value", "psi"])
def q_stored_reference_drift(spark, sf_dir):
    """H2 + H7: the newest stored reference against the current rows."""
    root = _store(spark, sf_dir)
    ref = V.read_version(spark, V.latest_version(spark, root), "features")
    _, cur = _by_year(spark, sf_dir)
    return DR.column_drift(ref, cur.drop("b"), ref.columns)


REPORT = T.StructType([T.StructField("report", T.StringType()), T.StructField("timestamp", T.StringType()), T.StructField("status", T.StringType()),
                       T.StructField("drift_share", T.DoubleType()), T.StructField("n_drifted_features", T.LongType()),
                       T.StructField("n_features", T.LongType())])

_REPORT_SQL = _drift_sql("""SELECT 'drift_report_' || CAST(b AS VARCHAR) AS report, strftime(shipped, '%Y-%m-%d %H:%M:%S') AS timestamp, {cols}
  FROM report JOIN (SELECT year(l_shipdate) AS b, max(l_shipdate) AS shipped FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00' GROUP BY 1)
  USING (b)""", "CAST(year(l_shipdate) AS INTEGER)")


def _documents(spark, sf_dir):
    """Yearly drift reports written as indented JSON documents, those of odd years cut off."""
    li = load_table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= ts_lit(DRIFT_SPLIT))
    at = li.groupBy(F.year("l_shipdate").alias("b")).agg(F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    rep = _history(spark, sf_dir).join(at, "b").withColumn("report", F.concat(F.lit("drift_report_"), F.col("b").cast("string")))
    text = F.to_json(F.struct(*[f.name for f in REPORT.fields]), {"pretty": "true"})
    path = shared_path(spark, "report_documents")
    cut = F.when(F.col("b") % 2 == 1, F.expr("left(text, length(text) - 20)")).otherwise(F.col("text"))
    rep.withColumn("text", text).select("report", cut.alias("value")) \
        .repartition("report").write.partitionBy("report").text(path)
    return V.quarantine_documents(spark, f"{path}/*", REPORT, shared_path(spark, "report_quarantine"))


@query("drift_reports", _REPORT_SQL.replace("{cols}", "status, drift_share, n_drifted_features, n_features") + " WHERE b % 2 = 0",
       dbl=["drift_share"])
def q_drift_reports(spark, sf_dir):
    """H9: the newest ten readable reports with their time, from documents of several lines."""
    return _documents(spark, sf_dir).where("kept").select(*[f.name for f in REPORT.fields]).orderBy(F.col("report").desc()).limit(10)


@query("report_quarantine", _REPORT_SQL.replace("{cols}", "1 AS n_read, CAST(b % 2 = 0 AS INTEGER) AS n_kept, CAST(b % 2 = 1 AS INTEGER) AS n_broken")
       .replace("strftime(shipped, '%Y-%m-%d %H:%M:%S') AS timestamp, ", ""), ints=["n_read", "n_kept", "n_broken"])
def q_report_quarantine(spark, sf_dir):
    """Documents read, kept and broken by file; none is dropped."""
    rows = _documents(spark, sf_dir)
    name = F.regexp_extract("source_file", "report=([^/]+)/", 1)
    return rows.groupBy(name.alias("report")).agg(F.count(F.lit(1)).alias("n_read"), F.count_if("kept").alias("n_kept"),
                                                  F.count_if(~F.col("kept")).alias("n_broken"))
