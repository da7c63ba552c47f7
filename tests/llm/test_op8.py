"""Language-model scores against direct counts; EM against the likelihood; odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.llm import op8_lm as L


def brute(rows):
    """Scores with the operator's own weights, from plain counters."""
    train, fold = [Counter(), Counter()], [Counter(), Counter()]
    docs = []
    for i, t in rows:
        w = ["<end>", *(t or "").encode().lower().split(), "<end>"]
        crc = zlib.crc32(str(i).encode()) % 10 if i is not None else 0
        docs.append((i, crc, w))
        for c in ([] if crc == 0 else [train, fold] if crc == L.FOLD else [train]):
            c[0].update(w[1:])
            c[1].update(zip(w, w[1:]))
    n, v = sum(train[0].values()), len(train[0])
    cells, n_rest = Counter(), n - sum(fold[0].values())
    for i, crc, w in docs:
        if crc == L.FOLD:
            for h, x in zip(w, w[1:]):
                ch = train[0][h] - fold[0][h]
                p2 = (train[1][h, x] - fold[1][h, x]) / max(ch, 1)
                p1 = (train[0][x] - fold[0][x]) / max(n_rest, 1)
                cells[int((L.level(np.array([ch]))[0] << 16) + (L.cell(np.array([p2]))[0] << 8) + L.cell(np.array([p1]))[0])] += 1
    mix = L.weights(sorted(cells.items()), v)
    out = []
    for i, crc, w in docs:
        base = sum(math.log10((train[0][x] + .1) / (n + .1 * (v + 1))) for x in w[1:])
        p = 0.0
        for h, x in zip(w, w[1:]):
            a, b, c = mix[L.level(np.array([train[0][h]]))[0]]
            p += math.log10(a * train[1][h, x] / max(1, train[0][h]) + b * train[0][x] / max(n, 1) + c / (v + 1))
        out.append((i, crc == 0, len(w) - 1, sum(train[0][x] > 0 for x in w[1:]), n, base, p))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


@pytest.mark.parametrize("tokens,keys", [(2_000_000, 2_000_000), (3000, 4000)])
def test_equals_counters(spark, monkeypatch, tokens, keys):
    monkeypatch.setattr(L, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(L, "RANGE_KEYS", keys)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(10**9, None), (10**9 + 1, ""), (None, "no id"), (7, "again Again"), (7, "again Again"), (10**9 + 3, "x " * 5000)]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))
    same(L.score(docs.withColumn("BLOCK", F.lit(1)).withColumn("fold", F.lit("f"))).collect(), brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_estimates_of_the_rest_add_up_to_one(spark):
    """What is left of the counts without the deleted fold, over what is left of the tokens: a distribution."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    blocks = L.pack_blocks(docs.withColumn("out", crc == 0).withColumn("fold", crc == L.FOLD), "text", "out", "fold").collect()
    total = Counter()
    for r in blocks:
        b = L.Block(r.asDict())
        rest = b.counts(None) - b.counts(2)
        total.update(dict(zip(b.words.tolist(), rest[:len(b.words)].tolist())))
    n_rest = sum(r.n_train - r.n_fold for r in blocks)
    assert n_rest > 0 and sum(total.values()) == n_rest and sum(r.n_fold for r in blocks) > 0


def test_no_row_without_keys(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_TOKENS", 50)
    docs = spark.createDataFrame([(i, f"w{i} x y{i % 3}") for i in range(400)], "doc_id long, text string").repartition(4)
    blocks = L.pack_blocks(docs.withColumn("out", F.lit(False)).withColumn("fold", F.lit(False)), "text", "out", "fold")
    keys = [len(r["keys"]) // 8 for r in L.asked(blocks, 10).select("keys").collect()]
    assert keys and min(keys) > 0


def test_no_training_documents(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(i, "a b") for i in held]
    got = L.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got) and len(got) == 4
    assert L.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_em_raises_the_likelihood():
    rnd = np.random.default_rng(2)
    cells = [(int((3 << 16) + (a << 8) + b), int(n)) for a, b, n in zip(rnd.integers(0, 30, 50), rnd.integers(20, 60, 50), rnd.integers(1, 9, 50))]
    p = np.array([[2 ** (-(c >> 8 & 255) / 4), 2 ** (-(c & 255) / 4), 1 / 1001] for c, _ in cells])
    n = np.array([x for _, x in cells])
    like = lambda w: (n * np.log(p @ w)).sum()
    best = L.weights(cells, 1000)[3]
    assert abs(best.sum() - 1) < 1e-9 and all(like(best) >= like(w) - 1e-3 for w in rnd.dirichlet([1, 1, 1], 200))


def test_beats_the_base_on_held_out(spark):
    got = L.op8_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
