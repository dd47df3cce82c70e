"""Registered queries: sources and sinks (S1-S8) round-tripping domain
tables through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.registry import query
from churnlake.session import shared_path
from churnlake.sources import io

RAW_USERS_SCHEMA = ("user_id bigint, signup_date string, age int, city string, dietary_preference string, "
                    "referral_source string, is_active boolean")


@query("load_raw", "SELECT * FROM raw_users")
def q_load_raw(spark, sf_dir):
    """S1 + S3: the raw users table written as CSV (row count read back from
    the write) and scanned back with a declared schema."""
    d = Domain(spark, sf_dir, P)
    path = shared_path(spark, "raw_users_csv")
    io.write_counted(d.raw_users, path, "csv")
    return io.load_csv(spark, path, RAW_USERS_SCHEMA)


def _raw_tables(spark, sf_dir):
    d = Domain(spark, sf_dir, P)
    return {"users": d.raw_users, "orders": d.raw_orders, "subscriptions": d.raw_subscriptions,
            "engagement": d.raw_engagement, "labels": d.labels.select("user_id", "churned")}


@query("load_raw_tables", """
  SELECT 'users' AS table_name, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, sum(user_id) AS sum_user_id FROM raw_users
  UNION ALL SELECT 'orders', count(*), count(DISTINCT user_id), sum(user_id) FROM raw_orders
  UNION ALL SELECT 'subscriptions', count(*), count(DISTINCT user_id), sum(user_id) FROM raw_subs
  UNION ALL SELECT 'engagement', count(*), count(DISTINCT user_id), sum(user_id) FROM raw_eng
  UNION ALL SELECT 'labels', count(*), count(DISTINCT user_id), sum(user_id) FROM labels""",
       ints=["n_rows", "n_users", "sum_user_id"])
def q_load_raw_tables(spark, sf_dir):
    """The five raw tables from CSV files with declared schemas."""
    tables, base = _raw_tables(spark, sf_dir), shared_path(spark, "raw")
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{base}/{name}.csv")
    schemas = {name: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) for name, df in tables.items()}
    out = None
    for name, df in io.load_tables(spark, base, schemas).items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
                     F.sum("user_id").alias("sum_user_id")).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("csv_sink_counts", """
  SELECT 'users' AS table_name, count(*) AS rows_written FROM raw_users
  UNION ALL SELECT 'orders', count(*) FROM raw_orders
  UNION ALL SELECT 'subscriptions', count(*) FROM raw_subs
  UNION ALL SELECT 'engagement', count(*) FROM raw_eng""")
def q_csv_sink_counts(spark, sf_dir):
    """S3: overwrite sinks per table with the written row counts."""
    d = Domain(spark, sf_dir, P)
    rows = []
    for name, df in [("users", d.raw_users), ("orders", d.raw_orders), ("subscriptions", d.raw_subscriptions),
                     ("engagement", d.raw_engagement)]:
        rows.append((name, io.write_counted(df, shared_path(spark, f"raw_{name}"), "csv")))
    return spark.createDataFrame(rows, "table_name string, rows_written bigint")


@query("read_by_suffix", "SELECT * FROM clean_eng", ts=["week_date"])
def q_read_by_suffix(spark, sf_dir):
    """S2 + S7 + S8: the cleaned engagement table stored as parquet and as
    CSV; the first existing candidate is read by its suffix (parquet here)."""
    e = Domain(spark, sf_dir, P).engagement
    base = shared_path(spark, "engagement")
    io.write_counted(e, f"{base}/engagement.parquet", "parquet")
    e.write.mode("overwrite").option("header", True).csv(f"{base}/engagement.csv")
    path = io.first_existing(spark, [f"{base}/missing.parquet", f"{base}/engagement.parquet",
                                     f"{base}/engagement.csv"])
    return io.read_by_suffix(spark, path).select(*e.columns)


@query("read_by_suffix_csv", "SELECT * FROM clean_eng", ts=["week_date"])
def q_read_by_suffix_csv(spark, sf_dir):
    """S7 + S8 where only the CSV copy exists: read with the declared schema."""
    e = Domain(spark, sf_dir, P).engagement
    base = shared_path(spark, "engagement_csv")
    e.write.mode("overwrite").option("header", True).csv(f"{base}/engagement.csv")
    path = io.first_existing(spark, [f"{base}/engagement.parquet", f"{base}/engagement.csv"])
    return io.read_by_suffix(spark, path, e.schema).select(*e.columns)
