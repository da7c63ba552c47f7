"""Filter audit against running every order over every document."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from churnwise.llm import op12_audit as A

DOCS = "doc_id long, text string, source string"


def fails(rows):
    """The set of failed filters of each (doc_id, text, source)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        f = set()
        f |= {"A"} if len(w) < 50 else set()
        f |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and first[t] < i else set()
        out.append(f)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, bad = {}, fails(rows)
    for part in {s or "" for _, _, s in rows}:
        here = [(i, f) for (i, _, s), f in zip(rows, bad) if (s or "") == part]
        shapley, steps = Counter(), {}
        for order in map("".join, permutations("ABCDE")):
            left = list(here)
            for k, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                redundant = sum(x in f for _, f in here) - len(gone)
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(gone)
                steps[order, k] = (len(left), len(gone), redundant, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), sum(f == {x} for _, f in here))
        out |= {(part, o, k): v + (shapley[o[k - 1]],) for (o, k), v in steps.items()}
    return out


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit("clash")).withColumn("BITS", F.lit("x")).withColumn("digest", F.lit(3))
    facts = A.stored(A.facts(docs), "t")
    got = A.audit(A.coded(facts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)))).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.good_lost, r.toxic_lost, r.unique_fails, r.shapley) for r in got}
    assert len(out) == len(got)
    return out


def test_equals_every_order_run(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", "a", words, words + " ", "A" * 10, words.upper(), words + " #", "x " * 60, "x " * 60 + "#", "a b\x0b\x0cc\u00a0d", "é" * 95 + "ABCDE", "é" * 94 + "ABCDE",
             "Big " * 49, "Big " * 50, words + "\n" + "|" * 3, "x" * 3_000_000, "w " * 500_000]
    rows = [(i, texts[i % len(texts)], ["s1", None, "", "s2"][i % 4] if i % 3 else "hot") for i in range(len(texts) * 5)]
    rows += [(3, words, "s1")] * 4 + [(3, "other", "s2"), (None, words, "s1"), (None, None, None), (None, "alone", "s9"), (0, "alone", "s9")]
    rows += [(700, "same", "hot")] * 60 + [(None, "none", "hot")] * 60
    labels = [(i, [1, 0, None][i % 3], [0, 1, 1, None][i % 4]) for i in range(0, 95, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1), (700, 1, 1), (0, None, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == {}
    rows = [(1, "a # B", None)]
    assert run(spark, rows, []) == brute(rows, [])


def test_fields_never_overflow():
    total = sum(A.packed(c) * ((1 << 62) // A.CODES) for c in range(A.CODES))
    fields = A.unpacked(total)
    for (order, step), row in zip(A.STEPS, fields):
        want = [sum(A.outcome(c, order, step)[i] for c in range(A.CODES)) * ((1 << 62) // A.CODES) for i in range(len(A.COUNTERS))]
        assert row.tolist() == want
    assert len(A.STEPS) == 600


@pytest.mark.parametrize("part", ["hot"])
def test_hot_keys_of_the_join(spark, part):
    from churnwise.llm.common import stored
    from churnwise.llm.skew import hot_keys, left_join
    rows = stored(spark.createDataFrame([(1 if i % 2 else (None if i % 5 == 0 else i), i) for i in range(4000)], "k long, v long"), "t")
    side = spark.createDataFrame([(i, f"x{i}", part) for i in range(0, 4000, 3)] + [(1, "one", part)], "k long, s string, p string")
    assert hot_keys(rows, "k") == [1]
    want = sorted(map(str, rows.join(side, "k", "left").select("k", "v", "s", "p").collect()))
    assert sorted(map(str, left_join(rows, side, "k").select("k", "v", "s", "p").collect())) == want


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = A.op12_audit(spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({A.SQL})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) % 600 == 0
