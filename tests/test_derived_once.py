"""What several jobs read is derived once, and rows are dealt over all tasks: the plans and state calls behind it."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnwise import schema as S
from churnwise.functions import text as T
from churnwise.operators import ml
from churnwise.plans import analysis
from churnwise.plans.catalog import ml as catalog_ml
from churnwise.plans.catalog import quality_io
from churnwise.sources.members import member_snapshot, read_untrusted_csv, spread_scan
from churnwise.streaming import decline
from churnwise.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def files(df):
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def test_one_row_group_is_dealt_over_the_tasks(spark):
    """A file of one row group has many splits, and one of them holds all rows."""
    path = scratch_path(spark, "one-row-group")
    spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("text")).coalesce(1).write.mode("overwrite").parquet(path)
    conf = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert df.rdd.getNumPartitions() >= cores
        per = [r["count"] for r in spread_scan(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert sum(per) == 200_000 and len(per) >= cores and max(per) < 3 * 200_000 / len(per)


def test_word_start_patterns_equal_the_plain_ones(spark):
    plain = [r"(?i)\bp\.?\s?ex\.?\b", r"(?i)\bex\.:", r"(?i)\betc\.?\b", r"(?i)\bvs\.?\b", r"(?i)\bn[ºo]\.?\s?(?=\d)", r"(?i)\bart\.\s?(?=\d)",
             r"\bDra\.\s", r"\bDr\.\s", r"\bSr\.\s", r"\bSra\.\s"]
    pairs = [(T._java(old), T._java(new), rep) for old, (new, rep) in zip(plain, T.ABBREVIATIONS, strict=True)]
    steps = dict(T.SPEECH_STEPS)
    www = next(p for p in steps if p.startswith("www"))
    mark = next(p for p in steps if p.startswith(r"(?d)(?="))
    pairs += [(T._java(r"\bwww\.[^\s)]+"), www, ""), (r"(?d)(\*\*|\*|__|_|~~)(.*?)\1", mark, steps[mark]),
              (r"\A\s++|(?<!\s)\s++\z", r"\s(?:(?<=\A\s)\s*+|(?<!\s\s)\s*+\z)", ""), ]
    rnd = random.Random(5)
    bits = ["p", "P", "ex", "Ex", ".", ":", " ", "\n", "etc", "ETC", "vs", "nº", "No", "n", "1", "art", "Dra", "Dr", "Sr", "Sra", "_", "é", "a", "www", "www.x", "*", "**",
            "~~", "__", "😀", " "]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(6000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for old, new, rep in pairs:
        bad = df.where(F.regexp_replace("t", old, rep) != F.regexp_replace("t", new, rep)).collect()
        assert not bad, (new, bad[:3])
    ends = df.where(F.regexp_replace("t", r"(?<=[^.!?…])\z", ".") != F.regexp_replace("t", r"([^.!?…])\z", "$1.")).collect()
    assert not ends


class _State:
    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, *_):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value


class _Week:
    def __init__(self, week, n):
        self.week_ms, self.n_events = week, n


def test_a_users_batch_costs_few_state_calls():
    """Whatever the number of weeks: a read, a write and a timer; and a read, a write and a timer when weeks are due."""
    w, handle, job = decline.WEEK_MS, _State(), decline.Decline()
    job.init(handle)
    assert list(job.handleInputRows((1,), iter([_Week(i * w, 50 - i) for i in range(1, 41)]), None)) == []
    assert handle.calls == 2 and handle.timers == [w]

    class Times:
        def getCurrentWatermarkInMs(self):
            return 30 * w

    rows = list(job.handleExpiredTimer((1,), Times(), None))
    assert [r.week_ms for r in rows] == [i * w for i in range(1, 31)] and handle.calls == 4 and handle.timers == [w, 31 * w]
    assert [(r.delta, r.streak, r.alert) for r in rows[:4]] == [(None, 0, False), (-1, 1, False), (-1, 2, True), (-1, 3, True)]
    late = list(job.handleInputRows((1,), iter([_Week(5 * w, 9)]), None))
    assert [(r.week_ms, r.n_events, r.late) for r in late] == [(5 * w, 9, True)] and handle.calls == 5


def test_a_line_is_split_once(spark):
    path = scratch_path(spark, "split-once")
    spark.createDataFrame([(",".join("1" for _ in S.MEMBER.fields),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    names = quality_io.read_untrusted_csv.__globals__
    old, names["_file_names"] = names["_file_names"], lambda *_: []
    try:
        good, bad = read_untrusted_csv(spark, path)
    finally:
        names["_file_names"] = old
    assert good.count() == 1 and bad.count() == 0
    assert plan(good).count("split(") == 1 and plan(bad).count("split(") == 1


def test_members_are_derived_once(spark):
    d = ml.prepare_members(member_snapshot(spark, SF_SMALL))
    f = ml.split_and_folds(member_snapshot(spark, SF_SMALL))
    m = catalog_ml.members(spark, SF_SMALL)
    for df in (d, f, m):
        assert "md5" not in plan(df) and len(files(df)) == 1 and not any(x.endswith(SF_SMALL) for x in files(df))
    assert catalog_ml.members(spark, SF_SMALL) is m and m.count() == d.count() == f.count()


def test_eda_models_read_stored_members(spark):
    for name, df in quality_io.eda_models(spark, SF_SMALL).items():
        assert not any("testdata" in x for x in files(df)), name


def test_analysis_outputs_read_stored_scores(spark):
    clean, _ = analysis.cleaned(member_snapshot(spark, SF_SMALL))
    res = analysis.REGISTRY["logistic_regression"](clean, {})
    for name in ("metrics", "segments", "predictions"):
        assert "UDF" not in plan(res[name]) and "md5" not in plan(res[name]), name
