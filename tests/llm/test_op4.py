"""Decontamination against brute force over words."""

import random

import pytest

from churnwise.llm import op4_suffix as S
from churnwise.llm.common import alnum_words


def brute(doc, items, depth=10):
    w = alnum_words((doc or "").encode())
    hit, found = set(), set()
    for i, t in items:
        x = alnum_words((t or "").encode())
        n = min(depth, len(x))
        for j in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[j:j + n]:
                    hit.update(range(p, p + n))
                    if i is not None:
                        found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("depth,block", [(10, 1 << 20), (10, 30), (3, 50)])
def test_equals_brute_force(spark, depth, block):
    rnd = random.Random(depth + block)
    word = lambda: rnd.choice("a b c dd E é 7".split())
    items = [(i, " ".join(word() for _ in range(rnd.choice([0, 1, 2, 9, 10, 11, 25])))) for i in range(12)]
    items += [(12, None), (3, items[4][1]), (None, "only here " * 8), (13, "unique")]
    docs = [(i, "; ".join(word() for _ in range(rnd.choice([0, 1, 5, 40])))) for i in range(60)]
    docs += [(i + 100, f"x y {items[i % 12][1]} z! {items[(i + 1) % 12][1]}") for i in range(24)]
    docs += [(200, None), (201, ""), (202, "only here " * 9), (202, "only here " * 9), (203, "A unique find"), (None, "unique")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as items", "2 as N_HIT")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in S.match(df, bench, depth=depth, block_bytes=block).collect()), key=str)
    assert got == sorted(((i, *brute(t, items, depth)) for i, t in docs), key=str)
    clean = S.decontaminate(df, bench, depth=depth)
    assert clean.columns == df.columns and clean.count() == sum(g[2] == 0 for g in got)


def test_longest_matches(spark):
    item = " ".join(f"w{i}" for i in range(40))
    doc = "q " + " ".join(f"w{i}" for i in range(5, 30)) + " q " + " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    (r,) = S.match(df, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((m.item_start, m.doc_start, m.length) for m in r.matches) == [(0, 27, 40), (5, 1, 25)]


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in S.match(docs, none).collect()] == [(2, 0)]
    assert S.match(docs.where("false"), none).count() == 0
