"""Registered queries: alerting over the request log (K1-K6), batch form
of the same functions the streaming jobs use."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import quality as Q
from churnlake.operators import scoring as S
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.q_scoring import DEMO_COEFFICIENTS, DEMO_INTERCEPT, DEMO_THRESHOLD, _range_sql, \
    _BUSINESS_SQL, _scoring_sql
from churnlake.plans.registry import query
from churnlake.session import cut_lineage
from churnlake.sources.adapters import request_log
from churnlake.streaming import alerts as K

_LOG = "rlog AS (SELECT event_id AS request_id, CAST(ts AS TIMESTAMP) AS ts, event_type = 'error' AS failed, " \
       "value AS latency FROM events)"
_WIN = ("win AS (SELECT date_trunc('minute', ts) - to_minutes(CAST(k AS INTEGER)) AS window_start, failed, latency "
        "FROM rlog, range(0, 5) r(k))")


def _k1_sql(limit: float) -> str:
    return f"""
  WITH {_LOG}, {_WIN}
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n_requests,
         count_if(failed) AS n_errors, count_if(failed) / greatest(count(*), 300) AS error_rate,
         count_if(failed) / greatest(count(*), 300) > {limit} AS alert
  FROM win GROUP BY window_start"""


@query("window_error_rate", _k1_sql(0.05), dbl=["error_rate"], ts=["window_start", "window_end"])
def q_window_error_rate(spark, sf_dir):
    return K.window_error_rate(request_log(spark, sf_dir))


@query("window_p95_latency", f"""
  WITH {_LOG}, {_WIN}
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, quantile_cont(latency, 0.95) AS p95_latency,
         quantile_cont(latency, 0.95) > 1.0 AS alert
  FROM win GROUP BY window_start""", dbl=["p95_latency"], ts=["window_start", "window_end"])
def q_window_p95_latency(spark, sf_dir):
    return K.window_p95_latency(request_log(spark, sf_dir))


@query("liveness_gaps", f"""
  WITH {_LOG}
  SELECT gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 AS gap_seconds FROM (
    SELECT lag(ts) OVER (ORDER BY ts) AS gap_start, ts AS gap_end FROM (SELECT DISTINCT ts FROM rlog))
  WHERE gap_start IS NOT NULL AND (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 > 120""",
       dbl=["gap_seconds"], ts=["gap_start", "gap_end"])
def q_liveness_gaps(spark, sf_dir):
    return K.liveness_gaps(request_log(spark, sf_dir))


@query("sustained_alert", f"""
  WITH k1 AS ({_k1_sql(0.0)})
  SELECT min(window_start) AS run_start, max(window_start) AS run_end, count(*) AS n_windows FROM (
    SELECT window_start, CAST(epoch(window_start) / 60 AS BIGINT) - row_number() OVER (ORDER BY window_start) AS k
    FROM k1 WHERE alert) GROUP BY k HAVING count(*) >= 5""", ts=["run_start", "run_end"])
def q_sustained_alert(spark, sf_dir):
    """K4 with the alert condition 'any error in the window' (limit 0)."""
    return K.sustained_alert(K.window_error_rate(request_log(spark, sf_dir), limit=0.0))


@query("stream_score", _scoring_sql(
    "SELECT user_id, round_even(p, 4) AS churn_probability, risk AS risk_level FROM r WHERE user_id NOT IN ("
    f"SELECT user_id FROM ({_range_sql('matrix')} UNION ALL {_BUSINESS_SQL}))"), dbl=["churn_probability"])
def q_stream_score(spark, sf_dir):
    """K5 batch form: quarantine split, then scoring of the valid rows with
    the scaler fitted on the whole batch."""
    m = cut_lineage(Domain(spark, sf_dir, P).matrix)
    stats = S.scaler_stats(m)
    valid, _ = Q.quarantine_split(m)
    return S.batch_score(valid, stats, DEMO_COEFFICIENTS, DEMO_INTERCEPT, DEMO_THRESHOLD) \
        .select("user_id", "churn_probability", "risk_level")


@query("late_data", f"""
  WITH {_LOG}
  SELECT count(*) AS n_rows, count_if(coalesce(ts < seen - INTERVAL 600 SECOND, false)) AS n_late FROM (
    SELECT ts, max(ts) OVER (ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM rlog)""")
def q_late_data(spark, sf_dir):
    """K6 batch replay: arrival order = request id, watermark delay 10 min."""
    late = K.late_rows(request_log(spark, sf_dir), 600)
    return late.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_late"))


def _event_stream(spark, sf_dir):
    """The request log as a stream: the events table is written once into a
    folder under the shared checkpoint folder and read back with
    ``readStream`` (a file source; a message bus in production)."""
    from churnlake.session import shared_path
    from churnlake.sources.tables import load_table
    src = shared_path(spark, "events_stream")
    load_table(spark, sf_dir, "events").write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    return raw.select(F.col("event_id").alias("request_id"), "ts", (F.col("event_type") == "error").alias("failed"),
                      F.col("value").alias("latency"))


@query("stream_error_rate")
def q_stream_error_rate(spark, sf_dir):
    """K1 as a Structured Streaming job: 10-minute watermark, sliding
    windows in append mode (only windows the watermark has closed are
    emitted), memory sink, checkpointed in the shared folder."""
    from churnlake.session import shared_path
    name = "k1_" + shared_path(spark, "q").rsplit("-", 1)[-1]
    res, _ = K.run_stream(spark, _event_stream(spark, sf_dir),
                          lambda d: K.window_error_rate(d.withWatermark("ts", "10 minutes")),
                          name, shared_path(spark, "k1_checkpoint"), mode="append")
    return res


@query("stream_liveness")
def q_stream_liveness(spark, sf_dir):
    """K3 as a Structured Streaming job: activity sessions with a 2-minute
    gap (session windows); the space between sessions is a liveness gap."""
    from churnlake.session import shared_path
    name = "k3_" + shared_path(spark, "q").rsplit("-", 1)[-1]
    res, _ = K.run_stream(spark, _event_stream(spark, sf_dir), lambda d: K.stream_liveness(d), name,
                          shared_path(spark, "k3_checkpoint"), mode="append")
    return res
