"""Quality classifier: held-out accuracy, pooled calibration, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.llm import op3_quality as Q

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    for v in np.unique(score):
        at = np.flatnonzero(score[order] == v)
        rank[order[at]] = at.mean() + 1
    good = y == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    got = Q.op3_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    y = got["quality"].to_numpy()
    assert auc(got["score"].to_numpy(), y) > 0.95
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    assert got.loc[got["quality"] == 1, "predicted"].mean() > 0.97


def test_all_rows_and_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.op3_quality(spark, SF)
    assert got.count() == docs.count() and got.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").count() == 0


def test_isotonic_equals_minimax_formula():
    rnd = np.random.default_rng(3)
    n, good = np.zeros(Q.BINS), np.zeros(Q.BINS)
    at = np.sort(rnd.choice(Q.BINS, 30, replace=False))
    n[at] = rnd.integers(1, 9, 30)
    good[at] = rnd.binomial(n[at].astype(int), np.linspace(0.2, 0.8, 30))
    _, values = Q.isotonic(n, good)
    assert (np.diff(values) > 0).all()
    brute = [max(min(good[at[i:j]].sum() / n[at[i:j]].sum() for j in range(k + 1, 31)) for i in range(k + 1)) for k in range(30)]
    assert np.allclose(np.unique(np.round(brute, 9)), np.round(values, 9))


@pytest.mark.parametrize("labels", [[], [(1, None)], [(99, 1)]])
def test_no_usable_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (3, ""), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("s")).withColumn("stats", F.lit(1))
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = Q.keep_good(docs, lab)
    assert kept.count() == 5 and kept.columns == docs.columns and kept.select("score", "stats").distinct().count() == 1


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.keep_good(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_statistics_of_odd_texts():
    for t in (b"", b" ", b"\n\n", b"x" * 1_000_000, bytes(range(256))):
        s = Q.statistics(t)
        assert len(s) == Q.N_STATS and np.isfinite(s).all()


def test_scores_equal_a_direct_computation(spark):
    """Standardising, random features, ridge and isotonic calibration in one process, on all labelled rows at once."""
    import zlib
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    x = np.array([Q.statistics((r.text or "").encode()) for r in docs])
    fold = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 for r in docs])
    label = np.array([y.get(r.doc_id, np.nan) for r in docs], float)
    learn, hold = (~np.isnan(label) & np.isin(fold, [1, 2, 3])), (~np.isnan(label) & (fold == 4))
    mean, scale = x[learn].mean(0), np.sqrt(np.maximum(x[learn].var(0), 1e-8)) + 1e-3
    rnd = np.random.default_rng(7)
    w, b = rnd.normal(0, 1 / Q.WIDTH, (Q.N_STATS, Q.D)), rnd.uniform(0, 2 * np.pi, Q.D)
    z = np.hstack([np.sqrt(2 / Q.D) * np.cos(np.clip((x - mean) / scale, -6, 6) @ w + b), np.ones((len(x), 1))])
    a = z[learn]
    beta = np.linalg.solve(a.T @ a + Q.RIDGE * learn.sum() / Q.D * np.eye(Q.D + 1), a.T @ label[learn])
    raw = z @ beta
    low, high = Q.RANGE
    bins = np.clip((raw[hold] - low) * Q.BINS / (high - low), 0, Q.BINS - 1).astype(int)
    used = np.unique(bins)
    n, good = np.array([(bins == k).sum() for k in used]), np.array([label[hold][bins == k].sum() for k in used])
    fit = np.array([max(min(good[i:j].sum() / n[i:j].sum() for j in range(k + 1, len(used) + 1)) for i in range(k + 1)) for k in range(len(used))])
    centre = low + (used + 0.5) * (high - low) / Q.BINS
    knots = np.array([[np.average(centre[fit == v], weights=n[fit == v]), v] for v in np.unique(fit)])
    want = np.clip(np.interp(raw, knots[:, 0], knots[:, 1]), 0, 1)
    got = {r.doc_id: r.score for r in Q.op3_quality(spark, SF).collect()}
    assert np.abs(np.array([got[r.doc_id] for r in docs]) - want).max() < 1e-6
