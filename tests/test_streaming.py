"""T4 with weeks out of order and late, over several runs of one checkpoint; T5's buckets, versions and retries."""

import datetime as dt
import os

from churnwise.session import scratch_path
from churnwise.streaming import decline, jobs, upsert

MONDAY = dt.datetime(2024, 1, 1)


def weeks(spark, rows):
    """Rows of T3's table from (user, week number, events)."""
    return spark.createDataFrame([(u, None if w is None else MONDAY + dt.timedelta(weeks=w), None, n, 0.0) for u, w, n in rows], decline.WEEKLY)


def run(spark, batches, delay):
    out = jobs.run_dir(spark, "t4-test")
    for rows in batches:
        weeks(spark, rows).write.mode("append").parquet(f"{out}/weekly")
        decline.decline_alert(spark, f"{out}/weekly", out, delay)
    decline.decline_alert(spark, f"{out}/weekly", out, delay, close=True)
    return out


def rows_of(df, *more):
    return sorted(tuple(r) for r in df.collect())


USERS = [(1, 0, 9), (1, 1, 5), (1, 2, 3), (1, 5, 4), (2, 3, 1), (3, 0, 2), (3, 1, 2), (3, 2, 1), (3, 4, 8), (4, 0, 1), (4, 4, 1)]


def test_out_of_order_equals_batch(spark):
    """Any order within the delay gives the rows of the batch twin."""
    want = rows_of(jobs.decline_alert_batch(weeks(spark, USERS)).select("user_id", "week_start", "n_events", "delta", "streak", "alert"))
    late_first = [[r for r in USERS if r[1] % 2], [r for r in USERS if r[1] % 2 == 0]]
    out = run(spark, late_first, "70 days")
    assert rows_of(decline.read_alerts(spark, out)) == want
    assert decline.late_weeks(spark, out).count() == 0
    assert any(r[5] for r in want) and any(r[2] == 0 for r in want)


def test_later_weeks_are_counted(spark):
    """Without a delay, a week behind one that was emitted is a late row and changes nothing else; replays are late too."""
    out = run(spark, [[(1, 0, 5), (1, 2, 3)], [(2, 0, 7), (1, 1, 9), (1, 4, 1)], [(1, 3, 4), (1, 2, 3), (2, 1, 6), (None, 9, 1), (5, None, 1)]], "0 days")
    late = sorted((r.user_id, (r.week_start - MONDAY).days // 7, r.n_events) for r in decline.late_weeks(spark, out).collect())
    assert late == [(1, 1, 9), (1, 2, 3), (1, 3, 4)]
    kept = [(u, w, n) for u, w, n in [(1, 0, 5), (1, 2, 3), (1, 4, 1), (2, 0, 7), (2, 1, 6)]]
    want = rows_of(jobs.decline_alert_batch(weeks(spark, kept)).select("user_id", "week_start", "n_events", "delta", "streak", "alert"))
    assert rows_of(decline.read_alerts(spark, out)) == want


def test_weeks_twice_before_they_are_due_count_once(spark):
    out = run(spark, [[(1, 0, 5), (1, 1, 4)], [(1, 1, 4), (1, 0, 6)]], "70 days")
    assert [(r.n_events, r.delta) for r in decline.read_alerts(spark, out).orderBy("week_start").collect()] == [(6, None), (4, -2)]


def test_dense_weeks():
    w = decline.WEEK_MS
    rows, last = decline.dense_weeks([(0, 5), (3 * w, 1)], None)
    assert rows == [(0, 5, None, 0), (w, 0, -5, 1), (2 * w, 0, 0, 0), (3 * w, 1, 1, 0)] and last == (3 * w, 1, 0)
    assert decline.dense_weeks([(4 * w, 0)], last) == ([(4 * w, 0, -1, 1)], (4 * w, 0, 1))


SCORES = "id long, customer_id long, p double, created_at timestamp_ntz"


def scores(spark, rows):
    return spark.createDataFrame([(i, c, p, MONDAY + dt.timedelta(days=d)) for i, c, p, d in rows], SCORES)


def files(snap, named):
    return {(b, v, f) for b, v in named.items() for f in os.listdir(f"{snap.removeprefix('file:')}/data/v={v}/bucket={b}")}


def test_a_batch_rewrites_touched_buckets_only(spark):
    out = scratch_path(spark, "t5-test-a")
    snap = f"{out}/snapshot"
    first = [(i, i, 0.1, 0) for i in range(100)]
    upsert.merge(spark, snap, scores(spark, first), 0, buckets=8)
    before = upsert.read_manifest(spark, snap, 0)
    had = files(snap, before)
    touched = upsert.merge(spark, snap, scores(spark, [(200, 7, 0.9, 1), (201, 7, 0.8, 0), (202, 500, 0.5, 0)]), 1)
    after = upsert.read_manifest(spark, snap, 1)
    assert 0 < len(touched) <= 2 and {b for b in after if after[b] != before.get(b)} == touched
    assert files(snap, {b: v for b, v in after.items() if b not in touched}) <= had
    got = {r.customer_id: (r.id, r.p) for r in upsert.read_snapshot(spark, out, scores(spark, first).schema).select("id", "customer_id", "p").collect()}
    assert got == {i: (i, 0.1) for i in range(100)} | {7: (200, 0.9), 500: (202, 0.5)}


def test_retry_and_half_written_versions(spark):
    out = scratch_path(spark, "t5-test-b")
    snap = f"{out}/snapshot"
    schema = scores(spark, [(0, 0, 0.0, 0)]).schema
    assert upsert.read_snapshot(spark, out, schema).count() == 0
    upsert.merge(spark, snap, scores(spark, [(i, i, 0.1, 0) for i in range(20)]), 0, buckets=4)
    batch = scores(spark, [(30, 3, 0.7, 2), (31, 40, 0.6, 2)])
    upsert.merge(spark, snap, batch, 1)
    os.remove(f"{snap.removeprefix('file:')}/manifest/v=1/_SUCCESS")  # the job died before the version was committed
    assert {r.customer_id for r in upsert.read_snapshot(spark, out, schema).collect()} == set(range(20))
    upsert.merge(spark, snap, batch, 1)
    got = {r.customer_id: r.id for r in upsert.read_snapshot(spark, out, schema).collect()}
    assert got == {i: i for i in range(20)} | {3: 30, 40: 31}
    for version in range(2, 6):
        upsert.merge(spark, snap, scores(spark, [(100 + version, c, 0.2, version) for c in range(20)]), version)
    assert len(upsert._children(spark, f"{snap}/data", "v=")) <= 3
    upsert.merge(spark, snap, scores(spark, [(0, 0, 0.0, 0)]).limit(0), 6)
    assert {r.id for r in upsert.read_snapshot(spark, out, schema).where("customer_id < 20").collect()} == {105}


def test_stream_of_many_files(spark):
    out = scratch_path(spark, "t5-test-c")
    rows = [(i, i % 30, i / 100, i // 30) for i in range(90)]
    scores(spark, rows).repartition(9).write.parquet(f"{out}/landing")
    upsert.latest_score_upsert(spark, f"{out}/landing", out, SCORES, files_per_trigger=2, buckets=4)
    got = {r.customer_id: r.id for r in upsert.read_snapshot(spark, out, scores(spark, rows).schema).collect()}
    assert got == {c: 60 + c for c in range(30)}
