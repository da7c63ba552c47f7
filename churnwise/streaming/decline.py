"""T4: decline alerts over a stream of weekly counts whose weeks may come out of order.

Per user, weeks wait in keyed state until the watermark (newest week seen minus ``delay``) passes them; an event-time
timer at the first waiting week then emits all weeks that are due, in order, missing weeks as 0, with the difference to
the week before and the length of the run of declines. One value per user holds what was emitted last (three numbers) and
the waiting weeks, so a batch costs a user a read, a write and a timer, and the state of a user is bounded by the weeks of
the delay, however long the user's history is.

A week that comes after a later one of that user was emitted can no longer change what was said. It is not lost: it
becomes a row of its own with ``late`` = true and neither delta nor streak. A week that comes twice before it is due
counts once (the later delivery stands), so replays do no harm.

The end of the input is told by a control row in a second source folder (``close``): it moves the watermark past all
weeks, so what waits is emitted. Rows without a user or a week are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .jobs import _append, _run, run_conf

WEEKLY = "user_id bigint, week_start timestamp_ntz, week_end timestamp_ntz, n_events bigint, value_sum double"
OUT = "user_id bigint, week_ms bigint, n_events bigint, delta bigint, streak int, alert boolean, late boolean"
OUT_ROW = Row("user_id", "week_ms", "n_events", "delta", "streak", "alert", "late")
WEEK_MS = 7 * 24 * 3600 * 1000
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def dense_weeks(weeks: list[tuple[int, int]], last: tuple[int, int, int] | None) -> tuple[list[tuple], tuple[int, int, int]]:
    """Rows (week, n, delta, streak) for sorted ``weeks`` (week, n) that follow ``last`` (week, n, streak), with a 0 for
    every missing week, and the new ``last``."""
    rows = []
    for week, n in weeks:
        steps = [(week, n)]
        if last is not None:
            steps = [(w, 0) for w in range(last[0] + WEEK_MS, week, WEEK_MS)] + steps
        for w, count in steps:
            delta = None if last is None else count - last[1]
            streak = last[2] + 1 if delta is not None and delta < 0 else 0
            rows.append((w, count, delta, streak))
            last = (w, count, streak)
    return rows, last


class Decline(StatefulProcessor):
    def init(self, handle) -> None:
        self.handle = handle
        self.user = handle.getValueState("user", "week bigint, n bigint, streak int, weeks array<bigint>, counts array<bigint>")

    def read(self) -> tuple[tuple[int, int, int] | None, dict[int, int]]:
        """What was emitted last, if anything, and the waiting weeks with their counts."""
        state = self.user.get()
        if state is None:
            return None, {}
        week, n, streak, weeks, counts = state
        return None if week is None else (week, n, streak), dict(zip(weeks, counts))

    def write(self, last: tuple[int, int, int] | None, waiting: dict[int, int]) -> None:
        self.user.update((*(last or (None, None, None)), list(waiting), list(waiting.values())))

    def handleInputRows(self, key, rows, timerValues):
        (user,) = key
        if user is None:
            return  # the control row
        last, waiting = self.read()
        first = min(waiting, default=None)  # has a timer
        changed = False
        for r in rows:
            if last is not None and r.week_ms <= last[0]:
                yield OUT_ROW(user, r.week_ms, r.n_events, None, None, False, True)
            else:
                waiting[r.week_ms], changed = r.n_events, True
        if changed:
            self.write(last, waiting)
            if first is None or min(waiting) < first:
                self.handle.registerTimer(min(waiting))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        (user,) = key
        watermark = timerValues.getCurrentWatermarkInMs()
        last, waiting = self.read()
        due = sorted((w, n) for w, n in waiting.items() if w <= watermark)
        if not due:
            return  # another timer of this batch has emitted it
        rows, last = dense_weeks(due, last)
        left = {w: n for w, n in waiting.items() if w > watermark}
        self.write(last, left)
        if left:
            self.handle.registerTimer(min(left))
        for r in rows:
            yield OUT_ROW(user, *r, r[3] >= 2, False)

    def close(self) -> None:
        pass


def decline_alert(spark: SparkSession, weekly: str, out: str, delay: str = "14 days", close: bool = False,
                  files_per_trigger: int | None = None) -> list:
    """T4 over the weekly counts in the folder ``weekly``, as far as they have come; the sink is ``out``/sink. ``close``
    tells the job that nothing will follow. Runs again on the same ``out`` go on where the last one ended. Returns the
    progress reports."""
    control = f"{out}/control"
    if close:
        day = "timestamp_ntz'9999-01-01'"
        spark.range(1).selectExpr("CAST(NULL AS bigint) AS user_id", f"{day} AS week_start", f"{day} AS week_end", "0L AS n_events",
                                  "0.0D AS value_sum").write.mode("append").parquet(control)
    else:
        spark.createDataFrame([], WEEKLY).write.mode("append").parquet(control)
    reader = spark.readStream.schema(WEEKLY)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.parquet(weekly).unionByName(spark.readStream.schema(WEEKLY).parquet(control))
    src = (src.where("week_start IS NOT NULL").withColumn("event_time", F.col("week_start").cast("timestamp"))
           .withWatermark("event_time", delay))
    # The operator gets the week as a number: a row behind the watermark must reach it, to become a late row.
    rows = src.select("user_id", F.unix_millis("event_time").alias("week_ms"), F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"))
    with run_conf(spark, ROCKSDB):
        res = rows.groupBy("user_id").transformWithState(Decline(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
        return _run(spark, _append(res.withColumn("week_start", F.timestamp_millis("week_ms").cast("timestamp_ntz")).drop("week_ms"), out))


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """The emitted weeks, late ones left out."""
    return spark.read.parquet(f"{out}/sink").where("NOT late").select("user_id", "week_start", "n_events", "delta", "streak", "alert")


def late_weeks(spark: SparkSession, out: str) -> DataFrame:
    """The weeks that came too late, as they were delivered."""
    return spark.read.parquet(f"{out}/sink").where("late").select("user_id", "week_start", "n_events")
