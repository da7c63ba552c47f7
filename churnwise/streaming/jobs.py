"""Structured Streaming forms of the incremental operators (T1-T3, T6, the batch twin of T4; T4 is in ``decline``, T5 in
``upsert``).

Every job reads a file stream with a fixed schema, writes an append sink
with its own checkpoint in the shared checkpoint folder, and runs with the
``availableNow`` trigger, so a restart after a lost executor or driver
resumes from the committed offsets and the sinks stay exactly-once.
"""

from __future__ import annotations

import contextlib
import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import schema as S
from ..operators.scorecard import linear_scorecard
from ..session import scratch_path

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
WEEK = "7 days"
MONDAY_OFFSET = "4 days"  # 1970-01-01 was a Thursday


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run (sink + checkpoint) in the shared folder."""
    return scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:10]}")


class _Progress(StreamingQueryListener):
    """Keeps every progress report of one query (a query object keeps the last
    hundred only)."""

    def __init__(self):
        self.reports, self.ended = {}, threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        self.reports.setdefault(str(event.progress.runId), []).append(json.loads(event.progress.json))

    def onQueryTerminated(self, event):
        self.reports.setdefault(f"ended {event.runId}", [])
        self.ended.set()


def _run(spark: SparkSession, writer) -> list:
    """Start an availableNow query, wait for its end however long it takes (a
    failure raises), and return its progress reports, one per micro-batch."""
    log = _Progress()
    spark.streams.addListener(log)
    try:
        q = writer.start()
        q.awaitTermination()
        run = str(q.runId)
        while f"ended {run}" not in log.reports:  # reports arrive in order, the end last
            log.ended.wait(1.0)
            log.ended.clear()
        return log.reports.get(run, [])
    finally:
        spark.streams.removeListener(log)


@contextlib.contextmanager
def run_conf(spark: SparkSession, conf: dict[str, str]):
    """Within, the session has these settings (a query keeps those of its start)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _append(df: DataFrame, out: str):
    return (df.writeStream.format("parquet").option("path", f"{out}/sink")
            .option("checkpointLocation", f"{out}/_checkpoint").outputMode("append").trigger(availableNow=True))


def stream_score(spark: SparkSession, landing: str, out: str, files_per_trigger: int = 1,
                 schema=S.MEMBER_KEYED) -> list:
    """Members landing as files -> scorecard (H1) -> append sink."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    scored = linear_scorecard(src, keep=["customer_id"], with_drivers=False).select(
        "customer_id", "churn_probability", "risk_tier", "archetype", "proactive_allowed", "logit")
    return _run(spark, _append(scored, out))


def events_stream(spark: SparkSession, events_path: str, delay: str = "1 day") -> DataFrame:
    """Event stream with event time as TIMESTAMP (the tables hold
    timestamp_ntz, which watermarks reject) and a watermark."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if events_path.endswith(".parquet"):  # a single table file: stream its folder, filtered to the file
        folder, name = events_path.rsplit("/", 1)
        src = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        src = reader.parquet(events_path)
    return src.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)


def stream_audit(spark: SparkSession, events: DataFrame, out: str) -> list:
    """A stream of events with a watermark, delivered at least once,
    deduplicated on event_id within the watermark and appended once."""
    d = events.dropDuplicatesWithinWatermark(["event_id"])
    return _run(spark, _append(d.drop("event_time"), out))


def weekly_engagement(events: DataFrame) -> DataFrame:
    """T3 body: events per user per Monday-aligned week (tumbling window)."""
    g = events.groupBy("user_id", F.window("event_time", WEEK, WEEK, MONDAY_OFFSET).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("week_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("week_end"), "n_events", "value_sum")


def stream_weekly_engagement(spark: SparkSession, events_path: str, out: str, delay: str = "1 day") -> list:
    """Append mode, so a week is written once, when the watermark passes
    its end; state for older weeks is dropped."""
    w = weekly_engagement(events_stream(spark, events_path, delay))
    return _run(spark, _append(w, out))


def late_data_report(progress: list) -> list[tuple]:
    """Per micro-batch, input rows and rows dropped as later than the
    watermark (from the state operator metrics)."""
    rows = []
    for p in progress:
        ops = p.get("stateOperators") or []
        dropped = sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in ops)
        rows.append((int(p["batchId"]), int(p.get("numInputRows") or 0), dropped, (p.get("eventTime") or {}).get("watermark")))
    return rows


def decline_alert_batch(weekly: DataFrame) -> DataFrame:
    """T4 batch twin: dense weeks per user (sequence from first to last week),
    lag delta and the decline streak via a running group id. Windows are
    partitioned by user."""
    from pyspark.sql.window import Window
    span = weekly.groupBy("user_id").agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"))
    dense = span.select("user_id", F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    d = dense.join(weekly.select("user_id", "week_start", "n_events"), ["user_id", "week_start"], "left") \
        .withColumn("n_events", F.coalesce("n_events", F.lit(0)).cast("bigint"))
    w = Window.partitionBy("user_id").orderBy("week_start")
    d = d.withColumn("delta", F.col("n_events") - F.lag("n_events").over(w))
    neg = F.coalesce(F.col("delta") < 0, F.lit(False))
    d = d.withColumn("_g", F.sum(F.when(neg, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.when(neg, F.row_number().over(Window.partitionBy("user_id", "_g").orderBy("week_start")) - 1) \
        .otherwise(0)
    return d.withColumn("streak", streak.cast("int")).withColumn("alert", F.col("streak") >= 2).drop("_g")
