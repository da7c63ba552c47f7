"""Uploads with reasons, fingerprints of files and tables, profiles that merge, and checks that fail."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from churnwise import schema as S
from churnwise.operators import profile, quality
from churnwise.sources import bundle, members, store

ROW = {f.name: "1.5" if f.dataType.simpleString() == "double" else "1" for f in S.MEMBER.fields}
HEADER = ",".join(f.name for f in S.MEMBER.fields)


def line(**over):
    return ",".join({**ROW, **over}.values())


def test_upload_of_many_files(spark):
    folder = tempfile.mkdtemp(prefix="upload-")
    parts = [HEADER + "\n" + line() + "\n" + line(Age="x", Lifetime="") + "\n\n", line(Age='" 7 "') + "\r\n" + HEADER + "\r\n1,2\r\n" + line(gender="9999999999"), ""]
    for i, text in enumerate(parts):
        with open(f"{folder}/part-{i}.csv", "w", newline="") as f:
            f.write(text)
    good, bad = members.read_untrusted_csv(spark, folder)
    rows = good.collect()
    assert [f.dataType for f in good.schema] == [f.dataType for f in S.MEMBER] and sorted(r.Age for r in rows) == [1, 7]
    told = {r.line: (r.file, r.reasons) for r in bad.collect()}
    assert told == {line(Age="x", Lifetime=""): ("part-0.csv", ["Age: not int: x"]), "1,2": ("part-1.csv", [f"{len(ROW)} fields expected, not 2"]),
                    line(gender="9999999999"): ("part-1.csv", ["gender: not int: 9999999999"])}
    with open(f"{folder}/other.txt", "w") as f:
        f.write(HEADER)
    with pytest.raises(ValueError, match="other.txt"):
        members.read_untrusted_csv(spark, folder)
    with pytest.raises(ValueError):
        members.read_untrusted_csv(spark, f"{folder}/other.txt")


def test_missing_fields_are_null(spark):
    path = tempfile.mkdtemp(prefix="upload-") + "/a.csv"
    with open(path, "w") as f:
        f.write(line(Age="", Churn="") + "\n")
    good, bad = members.read_untrusted_csv(spark, path, header=False)
    r = good.first()
    assert r.Age is None and r.Churn is None and r.gender == 1 and bad.count() == 0


def tree(data, size, fan):
    level = [hashlib.sha256(data[i:i + size]).hexdigest() for i in range(0, max(len(data), 1), size)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
    return level[0]


def test_file_digests_equal_a_direct_tree(spark, monkeypatch):
    monkeypatch.setattr(members, "FAN", 3)
    folder = tempfile.mkdtemp(prefix="digest-")
    data = {"a": b"", "b": os.urandom(10), "c": os.urandom(100), "d": os.urandom(1000), "e": os.urandom(90)}
    for name, x in data.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(x)
    got = {r.file: (r.sha256, r.length) for r in members.dataset_fingerprint(spark, folder, range_bytes=10).collect()}
    whole = got.pop("__dataset__")
    assert got == {n: (tree(x, 10, 3), len(x)) for n, x in data.items()}
    assert got["b"][0] == hashlib.sha256(data["b"]).hexdigest()
    assert whole == (hashlib.sha256("".join(sorted(d for d, _ in got.values())).encode()).hexdigest(), sum(map(len, data.values())))
    os.rename(f"{folder}/d", f"{folder}/z")
    again = {r.file: r.sha256 for r in members.dataset_fingerprint(spark, folder, range_bytes=10).collect()}
    assert again["__dataset__"] == whole[0] and again["z"] == got["d"][0]


def test_a_file_of_more_than_two_gigabytes(spark):
    path = tempfile.mkdtemp(prefix="digest-") + "/big"
    size = (2 << 30) + 5
    with open(path, "wb") as f:
        f.truncate(size)  # a hole, no data on disk
    got = {r.file: (r.sha256, r.length) for r in members.dataset_fingerprint(spark, path, range_bytes=64 << 20).collect()}
    block, rest = hashlib.sha256(bytes(64 << 20)).hexdigest(), hashlib.sha256(bytes(5)).hexdigest()
    assert got["big"] == (hashlib.sha256((block * 32 + rest).encode()).hexdigest(), size)


def test_table_digest_tells_rows_not_order(spark):
    rows = [(1, "a", 0.1), (2, None, -0.0), (3, "", 1e300), (3, "", 1e300)]
    digest = lambda r: members.table_fingerprint(spark.createDataFrame(r, "k long, s string, x double")).first()
    one = digest(rows)
    assert one == digest(rows[::-1]) and one.n_rows == 4
    assert digest(rows[:3]).digest != one.digest and digest([(1, "a", 0.1), (2, "", -0.0), *rows[2:]]).digest != one.digest
    parts = int(digest(rows[:2]).digest) + int(digest(rows[2:]).digest)
    assert parts == int(one.digest) and digest([]).digest == "0"


def test_profiles_merge(spark):
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 37).alias("m"), F.when(F.col("id") % 2 == 0, F.col("id") % 500).alias("h"),
                                   F.when(F.col("id") % 3 == 0, F.lit(-0.0)).otherwise(0.0).alias("z"), (F.col("id") % 5).alias("day"))
    exact = {r.column: (r.nulls, r.distinct_values) for r in profile.column_profile(df).collect()}
    assert exact == {"id": (0, 20000), "m": (0, 37), "h": (10000, 250), "z": (0, 1), "day": (0, 5)}
    plan = profile.column_profile(df)._jdf.queryExecution().toString()
    assert "Expand" not in plan
    kept = profile.profile_sketch(df, by=["day"])
    halves = [profile.merge_profiles(kept.where(c)) for c in ("day < 2", "day >= 2")]
    merged = {r.column: r for r in profile.read_profile(profile.merge_profiles(halves[0].unionByName(halves[1]))).collect()}
    for c in ("id", "m", "h", "z"):
        assert merged[c].n_rows == 20000 and merged[c].nulls == exact[c][0] and abs(merged[c].distinct_values - exact[c][1]) <= 0.03 * exact[c][1]
    empty = {r.column: (r.nulls, r.distinct_values) for r in profile.column_profile(df.limit(0)).collect()}
    assert empty == dict.fromkeys(exact, (0, 0))


def test_clean_report_counts(spark):
    rows = [(1, 1, 2), (1, 1, 2), (1, 9, 2), (2, None, 2), (2, None, None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, other int, b int")
    kept, report = quality.clean(df, ["a", "b"])
    assert report.first().asDict() == {"rows_original": 7, "rows_clean": 2, "duplicates_removed": 2, "null_values": 5}
    assert sorted(map(tuple, kept.collect())) == [(1, 2), (2, 2)]
    assert "Expand" not in report._jdf.queryExecution().toString()
    assert profile.duplicate_count(df).first().asDict() == {"n_rows": 7, "distinct_rows": 5, "duplicates": 2}
    assert profile.duplicate_count(df.limit(0)).first().asDict() == {"n_rows": 0, "distinct_rows": 0, "duplicates": 0}


def test_checks_fail_as_they_should(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(12)], f"a int, {S.TARGET} int")
    quality.check_columns(df, ["a"])
    with pytest.raises(quality.DataQualityError, match="b, c"):
        quality.check_columns(df, ["a", "b", "c"])
    assert quality.check_binary_target(df).first().n == 12
    for bad in (df.limit(0), df.withColumn(S.TARGET, F.lit(2)), df.withColumn(S.TARGET, F.lit(None).cast("int"))):
        with pytest.raises(quality.DataQualityError):
            quality.check_binary_target(bad)
    quality.guard_min_rows(df, 10, per_class=6)
    for n, per, rows in ((13, 0, df), (10, 7, df), (1, 1, df.where(f"{S.TARGET} = 0"))):
        with pytest.raises(quality.DataQualityError):
            quality.guard_min_rows(rows, n, per_class=per)
    with pytest.raises(quality.DataQualityError):
        quality.guard_min_rows(df, 13, target=None)


def test_score_rows_have_the_stated_time(spark):
    df = spark.createDataFrame([(1, 0.123456, "baixo", "sleeping_dog"), (2, 0.5, "medio", "x")], "customer_id long, churn_probability double, risk_tier string, archetype string")
    rows = store.score_rows(df, "m", F.lit("2020-02-03 04:05:06").cast("timestamp_ntz"), 0.25).orderBy("customer_id").collect()
    assert [str(r.churn_probability) for r in rows] == ["0.12346", "0.50000"] and [r.proactive_allowed for r in rows] == [False, True]
    assert {str(r.created_at) for r in rows} == {"2020-02-03 04:05:06"} and {str(r.threshold) for r in rows} == {"0.25000"}


def test_bundle_reads_back_what_was_written(spark):
    models = {f"m{i}": spark.range(i).withColumn("x", F.lit(f"v{i}")) for i in range(5)}
    back = bundle.write_eda_bundle(models, tempfile.mkdtemp(prefix="bundle-"))
    assert list(back) == list(models)
    for name, df in models.items():
        assert sorted(map(tuple, back[name].collect())) == sorted(map(tuple, df.collect())) and back[name].columns == df.columns


def test_discounts_behind_any_blank(spark):
    from churnwise.functions.text import cap_discount
    cases = {"50 % off": "20% off", "50 %": "20%", "20%": "20%", "21 %": "20%", "100%": "20%", "150%": "20%", "1500%": "120%", "5 %": "5 %", "30​%": "30​%"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", cap_discount("t").alias("c"))
    assert {r.t: r.c for r in df.collect()} == cases
