"""Registered queries: the alert rules as stateful streams (K2-K6) and the one-pass
two-way sink (D5), replayed over arrivals. The oracle texts state what a stream must give:
results of closed windows, from the rows that did not come too late.

Arrivals: a row arrives by its request id, one in 37 with a delay of a twentieth of all
rows; three parts arrive one after another, and each stream is started again from its
checkpoint for each part."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import quality as Q
from churnlake.operators import scoring as S
from churnlake.plans.domain import Domain
from churnlake.plans.q_domain import P
from churnlake.plans.q_scoring import _BUSINESS_SQL, _range_sql, _scoring_sql, DEMO_COEFFICIENTS, DEMO_INTERCEPT, DEMO_THRESHOLD
from churnlake.plans.registry import query
from churnlake.session import shared_path
from churnlake.sources.adapters import request_log
from churnlake.streaming import alerts as K
from churnlake.streaming import state as ST

#: Parts that arrive one after another.
PARTS = 3

_LOG = f"""
  rlog AS (SELECT event_id AS request_id, CAST(ts AS TIMESTAMP) AS ts, event_type = 'error' AS failed, value AS latency,
                  least({PARTS - 1}, (event_id + CASE WHEN event_id % 37 = 5 THEN n // 20 ELSE 0 END) * {PARTS} // n) AS part
           FROM events, (SELECT max(event_id) + 1 AS n FROM events)),
  marks AS (SELECT p.part, max(r.ts) - INTERVAL 10 MINUTE AS mark FROM range({PARTS + 1}) p(part) JOIN rlog r ON r.part < p.part GROUP BY p.part),
  last AS (SELECT max(mark) AS closed FROM marks),
  marked AS (SELECT r.*, mark FROM rlog r LEFT JOIN marks USING (part)),
  win AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, failed, latency FROM (
            SELECT date_trunc('minute', ts) - to_minutes(CAST(k AS INTEGER)) AS window_start, failed, latency, mark FROM marked, range(0, 5) x(k)), last
          WHERE (mark IS NULL OR window_start + INTERVAL 5 MINUTE > mark) AND window_start + INTERVAL 5 MINUTE <= closed)"""


def arrivals(spark, sf_dir):
    """The request log in the parts in which it arrives."""
    log = request_log(spark, sf_dir)
    n = log.agg(F.max("request_id")).first()[0] or 0
    at = F.col("request_id") + F.when(F.col("request_id") % 37 == 5, (n + 1) // 20).otherwise(0)
    part = F.least(F.lit(PARTS - 1), F.floor(at * PARTS / (n + 1)))
    return [log.where(part == k) for k in range(PARTS)]


def _streamed(spark, sf_dir, name, build):
    """The output of a stateful stream over all arrivals."""
    base = shared_path(spark, name)
    with ST.stateful(spark):
        schema = ST.replay(arrivals(spark, sf_dir), f"{base}/source",
                           lambda log: ST.append_sink(build(log), f"{base}/out", f"{base}/checkpoint"))[1]
    return spark.read.schema(schema).parquet(f"{base}/out")


@query("stream_sustained_alert", f"""
  WITH {_LOG},
  k1 AS (SELECT window_start, count_if(failed) > 0 AS alert FROM win GROUP BY window_start)
  SELECT 'error_rate' AS rule, run_start, run_end, n_windows FROM (
    SELECT min(window_start) AS run_start, max(window_start) AS run_end, count(*) AS n_windows FROM (
      SELECT window_start, CAST(epoch(window_start) / 60 AS BIGINT) - row_number() OVER (ORDER BY window_start) AS k
      FROM k1 WHERE alert) GROUP BY k HAVING count(*) >= 5), last
  WHERE run_end + INTERVAL 6 MINUTE <= closed""", ts=["run_start", "run_end"])
def q_stream_sustained_alert(spark, sf_dir):
    """K4 as a stream, with the condition 'any error in the window': keyed runs with timers
    behind the windowed error rate."""
    return _streamed(spark, sf_dir, "k4_stream", lambda log: ST.sustained_runs(
        K.window_error_rate(log.withWatermark("ts", ST.WATERMARK), limit=0.0).withColumn("rule", F.lit("error_rate"))))


@query("stream_liveness_gaps", f"""
  WITH {_LOG},
  minutes AS (SELECT date_trunc('minute', ts) AS m, min(ts) AS first, max(ts) AS final FROM marked, last
              WHERE (mark IS NULL OR date_trunc('minute', ts) + INTERVAL 1 MINUTE > mark)
                AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= closed GROUP BY 1)
  SELECT 'api' AS service, gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 AS gap_seconds FROM (
    SELECT lag(final) OVER (ORDER BY m) AS gap_start, first AS gap_end FROM minutes)
  WHERE gap_start IS NOT NULL AND (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 > 120""", dbl=["gap_seconds"], ts=["gap_start", "gap_end"])
def q_stream_liveness_gaps(spark, sf_dir):
    """K3 as a stream: the last stamp per service in state; closed silences of over two minutes."""
    return _streamed(spark, sf_dir, "k3_gaps", ST.liveness_gap_stream).where("kind = 'gap'").drop("kind")


@query("stream_p95_latency", f"""
  WITH {_LOG},
  b AS (SELECT window_start, window_end, CAST(ceil(round(ln(greatest(latency, 1e-6)) / ln(CAST(1.02 AS DOUBLE)), 9)) AS INTEGER) AS b, count(*) AS n
        FROM win WHERE latency IS NOT NULL GROUP BY ALL),
  c AS (SELECT *, sum(n) OVER w AS seen, sum(n) OVER (PARTITION BY window_start) AS total FROM b WINDOW w AS (PARTITION BY window_start ORDER BY b))
  SELECT window_start, window_end, CAST(total AS BIGINT) AS n_requests, pow(CAST(1.02 AS DOUBLE), min(b)) * 2 / CAST(2.02 AS DOUBLE) AS p95_latency,
         pow(CAST(1.02 AS DOUBLE), min(b)) * 2 / CAST(2.02 AS DOUBLE) > 1 AS alert
  FROM c WHERE seen >= ceil(CAST(0.95 AS DOUBLE) * total) GROUP BY window_start, window_end, total""",
       dbl=["p95_latency"], ts=["window_start", "window_end"], ints=["n_requests"])
def q_stream_p95_latency(spark, sf_dir):
    """K2 as a stream: mergeable bucket counts per sliding window in state."""
    return _streamed(spark, sf_dir, "k2_stream", ST.p95_stream)


@query("stream_late_split", f"""
  WITH {_LOG}
  SELECT part AS epoch, count(*) AS n_read, count_if(NOT coalesce(ts <= mark, false)) AS n_kept, count_if(coalesce(ts <= mark, false)) AS n_late
  FROM marked GROUP BY part""", ints=["epoch"])
def q_stream_late_split(spark, sf_dir):
    """K6 as a stream: rows behind the watermark in a dead-letter folder, counted per micro-batch."""
    base = shared_path(spark, "k6_split")
    parts = arrivals(spark, sf_dir)
    ST.replay(parts, f"{base}/source", lambda log: (log.schema, ST.late_split(log, f"{base}/out", f"{base}/checkpoint")))
    rows = ST.read_split(spark, f"{base}/out", parts[0].schema, "late")
    return rows.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_read"), F.count_if(~F.col("late")).alias("n_kept"),
                                     F.count_if("late").alias("n_late"))


@query("stream_score_split", _scoring_sql(
    "SELECT r.user_id, v.user_id IS NULL AS valid, CASE WHEN v.user_id IS NULL THEN round_even(p, 4) END AS churn_probability, "
    "CASE WHEN v.user_id IS NULL THEN risk END AS risk_level, coalesce(v.rules, '') AS rules FROM r LEFT JOIN ("
    f"SELECT user_id, string_agg(rule, ',' ORDER BY rule) AS rules FROM ({_range_sql('matrix')} UNION ALL {_BUSINESS_SQL}) GROUP BY user_id) v "
    "ON r.user_id = v.user_id"), dbl=["churn_probability"])
def q_stream_score_split(spark, sf_dir):
    """K5 + D5 as a stream: feature rows arrive in parts; each micro-batch is checked, scored and
    written once, valid and quarantined rows side by side. The scaler is fitted before, on the
    stored matrix."""
    base = shared_path(spark, "k5_split")
    Domain(spark, sf_dir, P).matrix.write.parquet(f"{base}/matrix")
    matrix = spark.read.parquet(f"{base}/matrix")
    stats = S.one_row(S.scaler_stats(matrix))

    def prepare(batch):
        scored = S.linear_score(S.standardized(Q.all_violations(batch), stats), DEMO_COEFFICIENTS, DEMO_INTERCEPT)
        ok, p = F.size("violations") == 0, F.col("churn_probability_raw")
        return scored.select("user_id", F.when(ok, F.bround(p, 4)).alias("churn_probability"),
                             F.when(ok, S.risk_level(p, DEMO_THRESHOLD)).alias("risk_level"),
                             F.array_join(F.array_sort("violations"), ",").alias("rules"))

    parts = [matrix.where(F.pmod("user_id", F.lit(PARTS)) == k) for k in range(PARTS)]
    ST.replay(parts, f"{base}/source", lambda rows: (rows.schema, ST.split_sink(
        rows, lambda r, _: F.col("rules") == "", f"{base}/out", f"{base}/checkpoint", prepare)))
    return ST.read_split(spark, f"{base}/out", "user_id long, churn_probability double, risk_level string, rules string", "valid") \
        .select("user_id", "valid", "churn_probability", "risk_level", F.coalesce("rules", F.lit("")).alias("rules"))
