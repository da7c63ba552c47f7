"""Epsilon grid order join against all pairs."""

import contextlib
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.llm import op6_ego as E
from churnwise.llm.common import new_path


def brute(rows, cosine):
    good = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, np.float32).astype(np.float64)
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    links = dict.fromkeys(range(len(rows)), 0)
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y))) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    p, q = root(a), root(b)
                    up[max(p, q)] = min(p, q)
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[root(k)] = min(i, first.get(root(k), i))
    return sorted(((i, links[k], first[root(k)] if i is not None else None, i is None or first[root(k)] == i) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block,leaf,dim", [(4096, 256, 16), (16, 4, 16), (10, 3, 2), (7, 64, 1)])
def test_equals_all_pairs(spark, monkeypatch, block, leaf, dim):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "LEAF", leaf)
    monkeypatch.setattr(E, "FAN", 3)
    rnd = np.random.default_rng(dim + block)
    centres = rnd.normal(size=(25, dim))
    rows = [(1000 - k, (centres[k % 25] * rnd.uniform(.1, 9) + rnd.normal(size=dim) * rnd.choice([.02, .15, .4])).astype(np.float32).tolist()) for k in range(150)]
    rows += [(2000 + k, rows[3][1]) for k in range(5)] + [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [None] + [1.0] * (dim - 1)), (3004, [float("nan")] * dim),
             (3005, [float("inf")] * dim), (None, rows[0][1]), (3006, [1.0] * (dim + 1)), (3007, [2.0] * (dim + 1)), (3008, [1e-30] * dim), (3009, [1e30] * dim)]
    rows += [(1000, rows[7][1]), (1000, rows[40][1]), (1000, rows[40][1]), (990, [-x for x in rows[3][1]])]  # ids that repeat with other vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit("x")).withColumn("label", F.lit(None).cast("int"))
    got = sorted((tuple(r) for r in E.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == brute(rows, 0.9)


def test_rows_that_share_an_id_have_their_own_links(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01]), (4, [0.0, 1.0, 0.02])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]


def test_distant_blocks_are_skipped(spark):
    boxes = spark.createDataFrame([(i, float(i), float(i) + .5) for i in range(200)], "block long, lo0 double, hi0 double")
    pairs = {(r.a, r.b) for r in E.near_pairs(boxes, 1, 0.6).collect()}
    assert pairs == {(i, j) for i in range(200) for j in (i, i + 1) if j < 200}


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_disk_grows_with_the_vectors_not_with_the_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 64)
    rnd = np.random.default_rng(3)
    rows = rnd.normal(size=(3000, 64)).astype(np.float32)  # far apart in all directions: no pair of blocks is skipped
    rows[1500:1510] = rows[:10]
    rows[1510:1520] = rows[:10] * 1.5 + 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    tops = [*spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString(), new_path(spark, "x").removeprefix("file:").rpartition("/")[0]]
    seen, ended = {}, threading.Event()

    def look():
        for p in (os.path.join(d, f) for top in tops for d, _, names in os.walk(top) for f in names):
            with contextlib.suppress(OSError):  # Spark removes some shuffles when a job is over
                seen[p] = max(os.path.getsize(p), seen.get(p, 0))

    def watch():
        while not ended.wait(0.05):
            look()

    look()
    before, watcher = set(seen), threading.Thread(target=watch)
    watcher.start()
    try:
        got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df).collect()}
    finally:
        ended.set()
        watcher.join()
    written = sum(n for p, n in seen.items() if p not in before)
    assert got == {i: (2, i % 1500 % 10) if i < 10 or 1500 <= i < 1520 else (0, i) for i in range(3000)}
    assert written < 8 * rows.nbytes, written


def test_vectors_that_vary_along_few_axes(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 64)) * np.array([1.0] * 28 + [0.02] * 36) + 0.3
    x[200:] = x[:200] + rnd.normal(size=(200, 64)) * 0.25
    spread = np.linalg.eigvalsh(np.cov((x / np.linalg.norm(x, axis=1, keepdims=True)).T))[::-1]
    assert 8 <= E.width(spread, np.sqrt(0.2)) < 48  # candidates come from fewer axes
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in E.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == brute(rows, 0.9) and any(r[1] for r in got)
