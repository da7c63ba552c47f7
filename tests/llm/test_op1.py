"""Jaccard join against all pairs on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.llm import op1_jaccard as J
from churnwise.llm.common import components


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.setdefault(i, []).append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
    ids = [i for i in sets if i is not None]
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return sorted(((i, len(s), root(i) if i is not None else None) for i, ss in sets.items() for s in ss), key=str)


def table(seed):
    rnd = random.Random(seed)
    rows, word = [], lambda: f"w{rnd.randrange(5000)}"
    for base in range(30):
        text = [word() for _ in range(rnd.choice([1, 2, 3, 4, 9, 12, 20, 21, 30, 60, 150, 400]))]
        for _ in range(rnd.choice([1, 2, 6])):
            copy = list(text)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(copy).upper() if rnd.random() < .2 else "\n ".join(copy)))
    return rows + [(5000, None), (5001, ""), (5002, " \t\n"), (None, rows[0][1]), (5003, "One"), (5004, "one"), (rows[3][0], rows[3][1]), (5005, "a a a a a a"), (5006, "a a a")]


@pytest.mark.parametrize("seed,words,percent,block,odds", [(1, 3, 90, 4096, J.ODDS), (2, 5, 80, 4096, J.ODDS), (3, 3, 90, 3, J.ODDS), (4, 2, 70, 2, J.ODDS),
                                                            (1, 3, 90, 4096, None), (2, 5, 80, 4096, None)])
def test_equals_all_pairs(spark, monkeypatch, seed, words, percent, block, odds):
    monkeypatch.setattr(J, "BLOCK_ROWS", block)
    rows = table(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keys", F.lit(1)).withColumn("n", F.lit(None).cast("int"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar(df, "text", words, percent, odds).collect()), key=str)
    assert got == brute(rows, words, percent)
    kept = J.drop_similar(df, "text", words, percent, odds)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({i for i, _, c in got if i == c} | {None}, key=str)


def test_sketch_distance_never_exceeds_difference():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(2)]
    near = np.unique(np.append(sets[0][:-8], rnd.integers(0, 2**63, 8).astype(np.uint64)))
    assert J.linked([sets[0], near, sets[1]], np.zeros(3, int), 90) == [(0, 1)]
    assert J.linked([sets[0], near], np.zeros(2, int), 95) == []


def test_components_and_empty(spark):
    e = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (8, 12), (12, 5)], "a long, b long")
    assert {r.id: r.component for r in components(e, "t").collect()} == {i: 2 for i in (2, 3, 4, 5, 8, 9, 12)}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.similar(docs).count() == 0 and J.drop_similar(docs).count() == 0


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_copy_without_id_comes_first(spark, words, percent):
    text = [f"w{i}" for i in range(120)]
    near = " ".join([*text[:60], "other", *text[61:]])
    rows = [(None, " ".join(text)), (None, near), (7, " ".join(text)), (3, near), (9, "something else")]
    assert 100 * (120 - words + 1 - words) >= percent * (120 - words + 1 + words)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar(df, "text", words, percent).collect()), key=str)
    assert got == brute(rows, words, percent) and (7, 120 - words + 1, 3) in got
    assert sorted((r.doc_id for r in J.drop_similar(df, "text", words, percent).collect()), key=str) == [3, 9, None, None]


def test_rows_that_share_an_id_are_decided_by_their_own_text(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long), (2, long + " more"), (2, "quite another text, linked to nothing"), (2, "a third one of the same id"), (2, "a third one of the same id"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in J.drop_similar(df).collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)


def test_linked_long_sets_share_a_key():
    """Sets just within the similarity, of up to 40,000 shingles: with all parts always, with some of them in every
    case tried."""
    rnd = np.random.default_rng(7)
    for percent in (90, 80):
        bands = J.Bands(percent)
        for n in (11, 40, 200, 1500, 9000, 40_000):
            for _ in range(12 if n < 5000 else 3):
                a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
                d = len(a) * (100 - percent) // (100 + percent)  # replaced: 2d differ of n + d
                b = np.unique(np.append(a[rnd.permutation(len(a))[d:]], rnd.integers(0, 2**63, d).astype(np.uint64)))
                if 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)):
                    continue
                for most in (None, J.ODDS):
                    assert d == 0 or len(np.intersect1d(J.keys(a, bands, most), J.keys(b, bands, most))) > 0, (percent, n, most)
