"""Splits and folds, calibration, the compiled model, k-means with many starts and successive halving, each against a
direct computation on small data."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnwise import schema as S
from churnwise.operators import attribution as at
from churnwise.operators import calibrate as cal
from churnwise.operators import clusters, ml, treesql, tuning
from churnwise.session import stored

from test_ml import synthetic  # noqa: F401 - a fixture


# M6, M7 ---------------------------------------------------------------------
def test_split_and_folds_equal_direct_quantiles(spark):
    rows = [(i, None if i % 50 == 7 else int(i % 4 == 0)) for i in range(4000)] + [(5000 + i, 9) for i in range(3)]
    df = spark.createDataFrame(rows, f"customer_id long, {S.TARGET} int")
    got = ml.split_and_folds(df).withColumn("u", ml.hash01("customer_id")).withColumn("v", ml.hash01("customer_id", salt=ml.FOLD_SALT)).toPandas()
    assert len(got) == len(rows)
    for label in (0, 1, 9, None):
        g = got[got[S.TARGET].isna()] if label is None else got[got[S.TARGET] == label]
        a, b = np.quantile(g.u, [0.7, 0.85])
        assert (g.split == np.where(g.u < a, "train", np.where(g.u < b, "val", "test"))).all()
        assert (g.fold == sum((g.v >= c).astype(int) for c in np.quantile(g.v, [0.2, 0.4, 0.6, 0.8]))).all()
    alone = ml.assign_folds(ml.stratified_split(df)).toPandas().sort_values("customer_id").reset_index(drop=True)
    both = got.sort_values("customer_id").reset_index(drop=True)
    assert (alone.split == both.split).all() and (alone.fold == both.fold).all()


# M13 ------------------------------------------------------------------------
def _isotonic_directly(x, y, w):
    """The largest of all smallest means: y_hat(i) = max over a <= i of min over b >= i of the mean of a..b."""
    n = len(y)
    mean = lambda a, b: (y[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum()
    return np.array([max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def test_pool_adjacent_violators():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = int(rng.integers(1, 25))
        y, w = rng.random(n).round(1), rng.integers(1, 9, n).astype(float)
        assert cal.pool_adjacent_violators(w, y) == pytest.approx(_isotonic_directly(np.arange(n), y, w))


def _oof(spark, n=6000, k=3):
    rng = np.random.default_rng(4)
    m = rng.normal(0, 1.2, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.7 * m - 0.6)))).astype(int)
    m[:3] = [-50.0, 50.0, 0.0]
    rows = [(int(i % k), int(b), float(a)) for i, (a, b) in enumerate(zip(m, y))]
    return m, y, spark.createDataFrame(rows, f"fold int, {S.TARGET} int, margin double")


def test_calibration_curves(spark):
    k = 3
    m, y, oof = _oof(spark, k=k)
    h = cal.histograms(oof, k)
    assert h.sum() == len(m)
    for f in range(k):
        b = np.clip(np.floor((m[f::k] + cal.RANGE) / cal.WIDTH), 0, cal.BINS - 1).astype(int)
        assert (h[f, 1] == np.bincount(b, y[f::k], minlength=cal.BINS)).all()
    sig, iso = cal.calibrators(oof, k)
    for f in range(k):  # the sigmoid is where the loss has no slope; its curve is near the true one
        a, b = sig.folds[f]
        n0, n1 = h[f].sum(1)
        want = h[f, 1] * (n1 + 1) / (n1 + 2) + h[f, 0] / (n0 + 2)
        slope = cal.CENTRES * (h[f].sum(0) / (1 + np.exp(-(a * cal.CENTRES + b))) - want)
        assert abs(slope.sum()) < 1e-6 * len(m) and a == pytest.approx(1.7, abs=0.3) and b == pytest.approx(-0.6, abs=0.2)
        assert (np.diff(iso.folds[f]) >= -1e-12).all() and 0 <= iso.folds[f].min() and iso.folds[f].max() <= 1
    pred = oof.select("margin", *[(F.col("margin") + i / 7).alias(cal.fold_margin(i)) for i in range(k)])
    for c in (sig, iso):
        rows = c.apply(pred).collect()
        for r in rows[::97] + rows[:3]:
            if c is sig:
                want = np.mean([1 / (1 + np.exp(-(a * (r.margin + i / 7) + b))) for i, (a, b) in enumerate(c.folds)])
            else:
                want = np.mean([np.interp(r.margin + i / 7, cal.CENTRES, v) for i, v in enumerate(c.folds)])
            assert r.p_cal == pytest.approx(want, abs=1e-9)
    truth = 1 / (1 + np.exp(-(1.7 * m - 0.6)))
    got = np.array([r.p_cal for r in iso.apply(oof.select("margin", *[F.col("margin").alias(cal.fold_margin(i)) for i in range(k)])).collect()])
    assert np.abs(got - truth)[3:].mean() < 0.05


# M23 ------------------------------------------------------------------------
def test_compiled_model_equals_spark_ml(spark, synthetic):  # noqa: F811
    from churnwise.functions.core import with_derived_features
    model, _ = ml.train_model(synthetic, params={"maxIter": 8, "maxDepth": 4}, k=3)
    assert len(model.fold_trees) == 3
    d = stored(with_derived_features(synthetic).withColumn("Age", F.when(F.col("customer_id") % 11 != 0, F.col("Age"))), "t")
    a = model.scored(model.prep.transform(d, ["customer_id"]), "p_a").select("customer_id", "p_a")
    b = treesql.score_compiled(d, model.prep, [at.extract_trees(t, spark) for t in model.fold_trees], model.calibrator, ["customer_id"], "p_b")
    r = ml.scoring_parity(a, b).first()
    assert r.n == 3000 and r.parity_ok and r.max_abs_diff < 1e-9
    plan = b._jdf.queryExecution().toString()
    assert "UDF" not in plan and "Python" not in plan
    off = ml.scoring_parity(a, b.withColumn("p_b", F.when(F.col("customer_id") == 5, F.col("p_b") + 0.01).otherwise(F.col("p_b")))).first()
    assert not off.parity_ok


# M20 ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(c, 0.3, (80, 2)) for c in [(0, 0), (4, 0), (0, 4), (4, 4.5), (9, 9)]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "customer_id long, a double, b double")
    return pts, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_all_starts_together(spark, blobs):
    pts, x = blobs
    c = clusters.fit_kmeans(x, k=5, starts=10)
    assert len(c.all_inertias) == 10 and c.inertia == min(c.all_inertias)
    d = ((pts[:, None] - c.centres[None]) ** 2).sum(2)
    assert c.inertia == pytest.approx(d.min(1).sum(), rel=1e-6)
    near = d.argmin(1)  # a fixed point of Lloyd's step, and the assignment that Spark makes
    assert all(c.centres[i] == pytest.approx(pts[near == i].mean(0), abs=1e-5) for i in range(5))
    got = {r.customer_id: r.cluster for r in c.assign(x).select("customer_id", "cluster").collect()}
    assert [got[i] for i in range(len(pts))] == near.tolist()
    assert sorted(np.bincount(near)) == [80] * 5
    one = clusters.fit_kmeans(x, k=5, starts=1)
    assert c.inertia <= one.inertia + 1e-9
    assert c.passes <= 5 + 51  # passes over the data do not grow with the starts


def test_kmeans_is_the_same_however_rows_lie(spark, blobs):
    _, x = blobs
    a, b = clusters.fit_kmeans(x.repartition(2), k=3, starts=4), clusters.fit_kmeans(x.repartition(5, "a"), k=3, starts=4)
    assert a.inertia == pytest.approx(b.inertia, rel=1e-9)
    few = clusters.fit_kmeans(x.limit(3), k=6, starts=2)
    assert few.inertia == pytest.approx(0, abs=1e-12)
    with pytest.raises(ValueError):
        clusters.fit_kmeans(x.limit(0), k=3)


# M12 ------------------------------------------------------------------------
def test_rungs():
    assert tuning.rungs(8, 5) == [(8, 0.25, 1), (4, 0.5, 2), (2, 1.0, 5)]
    assert tuning.rungs(1, 5)[-1] == (1, 1.0, 5)
    assert set(tuning.SPACE) == {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight", "gamma", "scale_pos_weight"}


def test_halving_against_random_search(synthetic):  # noqa: F811
    """Halving gets at least the AUC of a random search over as many full trials as its budget pays for."""
    d = ml.prepare_members(synthetic)
    train = ml.fit_prep(d.filter(F.col("split") == "train")).transform(d.filter(F.col("split") == "train"), ["customer_id", S.TARGET])
    train = stored(train.select("customer_id", S.TARGET, "features"), "t")
    space = tuning.SPACE | {"n_estimators": ("int", 6, 12), "max_depth": ("int", 2, 4)}
    half = tuning.tune(train, n_trials=4, k=2, space=space, parallel=4)
    full = tuning.tune(train, n_trials=2, k=2, space=space, parallel=4, halving=False)
    assert half["best_auc"] >= full["best_auc"] - 0.01
    assert half["best_auc"] == max(t["mean_auc"] for t in half["trials"] if t["folds"] == 2 and t["trees"] == t["n_estimators"])
    assert [t["rung"] for t in half["trials"]] == [0] * 4 + [1] * 2
    first = sorted((t for t in half["trials"] if t["rung"] == 0), key=lambda t: -t["mean_auc"])
    assert {t["trial"] for t in half["trials"] if t["rung"] == 1} == {t["trial"] for t in first[:2]}


def test_weights_come_from_the_training_rows(spark):
    rows = spark.createDataFrame([(i, int(i < 30)) for i in range(100)], f"customer_id long, {S.TARGET} int")
    w = {r[S.TARGET]: r.weight for r in ml.class_weights(rows).collect()}
    assert w == {1: pytest.approx(100 / 60), 0: pytest.approx(100 / 140)}
