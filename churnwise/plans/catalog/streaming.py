"""Registered streaming queries (T1-T6): each runs its stream to completion
with the availableNow trigger in a fresh folder under the shared checkpoint
folder, then returns the sink as a DataFrame. The DuckDB twins are the batch
definitions of the same results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.core import fixed
from ...sources.members import member_snapshot
from ...streaming import decline, jobs, upsert
from ..oracle_sql import fx, with_members
from ..registry import register
from .core import scored_members
from .store import HIST_SQL, _HIST_COLS, _hist_out, score_history


def _events(sf_dir):
    return f"{sf_dir.rstrip('/')}/events.parquet"


@register("t1_stream_score", with_members(
    "SELECT customer_id, churn_probability, risk_tier, archetype, archetype <> 'sleeping_dog' AS proactive_allowed, "
    "logit FROM scored", scored=True))
def q_stream_score(spark, sf_dir):
    """Members land as 4 files; one file per micro-batch is scored."""
    out = jobs.run_dir(spark, "t1")
    member_snapshot(spark, sf_dir).repartition(4).write.parquet(f"{out}/landing")
    jobs.stream_score(spark, f"{out}/landing", out)
    return spark.read.parquet(f"{out}/sink")


@register("t2_stream_audit", """
SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT event_id) AS distinct_ids, COUNT(DISTINCT user_id) AS users
FROM events GROUP BY event_type""")
def q_stream_audit(spark, sf_dir):
    out = jobs.run_dir(spark, "t2")
    # at-least-once delivery: the log arrives twice
    once, again = (jobs.events_stream(spark, _events(sf_dir)) for _ in range(2))
    jobs.stream_audit(spark, once.unionByName(again), out)
    s = spark.read.parquet(f"{out}/sink")
    return s.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                       F.count_distinct("event_id").alias("distinct_ids"),
                                       F.count_distinct("user_id").alias("users"))


WEEKLY_SQL = f"""weekly AS (
  SELECT * FROM (
    SELECT user_id, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-05') AS week_start,
           time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-05') + INTERVAL '7 days' AS week_end,
           COUNT(*) AS n_events, {fx('SUM(value)', 6)} AS value_sum
    FROM events GROUP BY ALL)
  WHERE week_end <= (SELECT MAX(ts) FROM events) - INTERVAL '1 day')"""


def _weekly(spark, sf_dir):
    out = jobs.run_dir(spark, "t3")
    jobs.stream_weekly_engagement(spark, _events(sf_dir), out)
    return out, spark.read.parquet(f"{out}/sink")


@register("t3_weekly_engagement", f"SELECT * FROM (WITH {WEEKLY_SQL} SELECT * FROM weekly)")
def q_weekly(spark, sf_dir):
    _, w = _weekly(spark, sf_dir)
    return w.withColumn("value_sum", fixed("value_sum", 6))


DECLINE_SQL = f"""
SELECT * FROM (WITH {WEEKLY_SQL},
 span AS (SELECT user_id, MIN(week_start) AS a, MAX(week_start) AS b FROM weekly GROUP BY user_id),
 dense AS (SELECT s.user_id, g.week_start FROM span s,
           LATERAL (SELECT UNNEST(generate_series(s.a, s.b, INTERVAL '7 days')) AS week_start) g),
 filled AS (SELECT d.user_id, d.week_start, CAST(COALESCE(w.n_events, 0) AS BIGINT) AS n_events FROM dense d
            LEFT JOIN weekly w ON w.user_id = d.user_id AND w.week_start = d.week_start),
 lagged AS (SELECT *, n_events - LAG(n_events) OVER (PARTITION BY user_id ORDER BY week_start) AS delta FROM filled),
 grouped AS (SELECT *, COALESCE(delta < 0, FALSE) AS neg,
             SUM(CASE WHEN COALESCE(delta < 0, FALSE) THEN 0 ELSE 1 END)
               OVER (PARTITION BY user_id ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g
             FROM lagged)
SELECT user_id, week_start, n_events, delta,
       CAST(CASE WHEN neg THEN ROW_NUMBER() OVER (PARTITION BY user_id, g ORDER BY week_start) - 1 ELSE 0 END AS INTEGER)
         AS streak,
       CASE WHEN neg THEN ROW_NUMBER() OVER (PARTITION BY user_id, g ORDER BY week_start) - 1 ELSE 0 END >= 2 AS alert
FROM grouped)"""


def _out_of_order(spark, sf_dir, delay):
    """T3's closed weeks landing in two batches, the odd weeks first, then the end of the input."""
    _, weekly = _weekly(spark, sf_dir)
    out = jobs.run_dir(spark, "t4")
    weekly = weekly.withColumn("value_sum", F.col("value_sum").cast("double"))
    odd = F.floor(F.unix_millis(F.col("week_start").cast("timestamp")) / decline.WEEK_MS) % 2 == 1
    for part in (odd, ~odd):
        weekly.where(part).write.mode("append").parquet(f"{out}/weekly")
        decline.decline_alert(spark, f"{out}/weekly", out, delay)
    decline.decline_alert(spark, f"{out}/weekly", out, delay, close=True)
    return out


@register("t4_decline_alert", DECLINE_SQL)
def q_decline(spark, sf_dir):
    """Weeks out of order within the delay: the same rows as in order."""
    return decline.read_alerts(spark, _out_of_order(spark, sf_dir, "70 days"))


@register("t4_late_weeks", f"""
SELECT * FROM (WITH {WEEKLY_SQL}, t AS (SELECT *, (date_diff('day', TIMESTAMP '1970-01-01', week_start) // 7) % 2 = 1 AS odd FROM weekly)
SELECT e.user_id, e.week_start, e.n_events FROM t e WHERE NOT e.odd AND e.week_start < (
  SELECT max(o.week_start) FROM t o WHERE o.odd AND o.user_id = e.user_id))""")
def q_late_weeks(spark, sf_dir):
    """Without a delay, an even week that comes after a later odd one of its user was emitted is a late row."""
    return decline.late_weeks(spark, _out_of_order(spark, sf_dir, "0 days"))


@register("t4_decline_alert_batch", DECLINE_SQL)
def q_decline_batch(spark, sf_dir):
    """Batch twin of T4 (dense weeks, lag, running group id)."""
    _, w = _weekly(spark, sf_dir)
    return jobs.decline_alert_batch(w)


@register("t5_latest_score_upsert", with_members(f"SELECT * FROM (WITH {HIST_SQL} SELECT {_HIST_COLS} FROM latest)",
                                                 scored=True))
def q_upsert(spark, sf_dir):
    """Score history lands in four files a model version; each micro-batch is merged into the touched buckets of the
    latest-per-customer snapshot."""
    out = jobs.run_dir(spark, "t5")
    _, s = scored_members(spark, sf_dir)
    hist = score_history(s)
    for v in ("v1", "v2", "v3"):
        hist.filter(F.col("model_version") == v).repartition(4, "customer_id").write.mode("append").parquet(f"{out}/landing")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hist.schema.fields)
    upsert.latest_score_upsert(spark, f"{out}/landing", out, schema, files_per_trigger=4)
    return _hist_out(upsert.read_snapshot(spark, out, hist.schema))


@register("t6_late_data_report", None)
def q_late(spark, sf_dir):
    """T3 run twice on one checkpoint: the second run replays the first week
    of events as a late file; the rows behind the watermark are counted from
    the state operator progress."""
    out = jobs.run_dir(spark, "t6")
    ev = spark.read.parquet(_events(sf_dir))
    ev.write.parquet(f"{out}/landing")
    p1 = jobs.stream_weekly_engagement(spark, f"{out}/landing", out)
    first = ev.agg(F.min("ts")).first()[0]
    ev.filter(F.col("ts") < F.lit(first) + F.expr("INTERVAL 7 DAYS")).write.mode("append").parquet(f"{out}/landing")
    p2 = jobs.stream_weekly_engagement(spark, f"{out}/landing", out)
    rows = [(1,) + r for r in jobs.late_data_report(p1)] + [(2,) + r for r in jobs.late_data_report(p2)]
    return spark.createDataFrame(rows, "run int, batch_id int, input_rows long, dropped_by_watermark long, "
                                       "watermark string")
