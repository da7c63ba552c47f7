"""Additive attribution of the boosted trees.

Spark ML has no per-row tree explainer, so this is the one place work runs in
Python: the published path-dependent TreeSHAP algorithm (Lundberg et al.,
"Consistent individualized feature attribution for tree ensembles"),
vectorised over the rows of an Arrow batch with numpy inside
``mapInPandas``. The tree arrays (bounded by model size, not data size) are
read from the saved model and broadcast; the member rows never leave their
partitions. For each leaf path the EXTEND / UNWIND weights are computed for
every row at once, so the cost per batch is O(leaves x depth^2) numpy calls.

Spark's GBT margin is F(x) = sum_t w_t tree_t(x) and P = 1 / (1 + e^(-2F)),
so values are reported on the log-odds scale 2F: base + sum(values) = 2F(x).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.core import direction, fixed
from ..session import scratch_path


def extract_trees(model, spark, name: str = "gbt_trees") -> tuple[list[dict], list[float]]:
    """Node arrays per tree (left, right, feature, threshold, value, cover)
    from the saved model; continuous splits go left when x <= threshold."""
    import uuid
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.col("nodeData.impurityStats")[0].alias("cover"),
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold")).collect()
    weights = [float(w) for w in model.treeWeights]
    trees = []
    for t in range(len(weights)):
        nodes = sorted((r for r in rows if r.treeID == t), key=lambda r: r.id)
        n = len(nodes)
        tr = {k: np.zeros(n) for k in ("value", "cover", "threshold")}
        tr.update({k: np.full(n, -1, dtype=np.int64) for k in ("left", "right", "feature")})
        for r in nodes:
            tr["value"][r.id] = r.prediction
            tr["cover"][r.id] = r.cover
            tr["left"][r.id] = r.leftChild
            tr["right"][r.id] = r.rightChild
            tr["feature"][r.id] = r.featureIndex if r.leftChild >= 0 else -1
            tr["threshold"][r.id] = r.threshold if r.threshold is not None else 0.0
        trees.append(tr)
    return trees, weights


def leaf_paths(tree: dict) -> list[tuple[float, list[tuple[int, float, int, float]]]]:
    """(leaf value, [(feature, threshold, went_left, zero_fraction), ...]) per leaf."""
    out = []

    def walk(node, path):
        if tree["left"][node] < 0:
            out.append((float(tree["value"][node]), path))
            return
        f, thr, cov = int(tree["feature"][node]), float(tree["threshold"][node]), tree["cover"][node]
        for child, left in ((tree["left"][node], 1), (tree["right"][node], 0)):
            z = tree["cover"][child] / cov if cov > 0 else 0.0
            walk(int(child), path + [(f, thr, left, float(z))])

    walk(0, [])
    return out


def expected_value(tree: dict) -> float:
    """Cover-weighted mean leaf value."""
    paths = leaf_paths(tree)
    tot = 0.0
    for v, path in paths:
        w = 1.0
        for _, _, _, z in path:
            w *= z
        tot += w * v
    return tot


def _extend(pw, pz, po, l, z, o):
    """EXTEND with vector one-fractions: pw (n, L), l = current length."""
    pw[:, l] = 1.0 if l == 0 else 0.0
    for i in range(l - 1, -1, -1):
        pw[:, i + 1] += o * pw[:, i] * (i + 1) / (l + 1)
        pw[:, i] = z * pw[:, i] * (l - i) / (l + 1)
    pz[l] = z
    po[:, l] = o


def _unwound_sum(pw, pz, po, l, i):
    """Sum of the path weights after UNWIND of element i (length l + 1)."""
    o, z = po[:, i], pz[i]
    n_ = pw[:, l].copy()
    total = np.zeros(pw.shape[0])
    nz = o != 0
    for j in range(l - 1, -1, -1):
        with np.errstate(divide="ignore", invalid="ignore"):
            t_on = n_ * (l + 1) / ((j + 1) * np.where(nz, o, 1.0))
            n_new = pw[:, j] - t_on * z * (l - j) / (l + 1)
            t_off = (pw[:, j] * (l + 1)) / (z * (l - j)) if z != 0 else np.zeros_like(n_)
        total += np.where(nz, t_on, t_off)
        n_ = np.where(nz, n_new, n_)
    return total


def _unwind(pw, pz, po, l, i):
    """UNWIND element i in place (vectorised), returns new length l."""
    o, z = po[:, i].copy(), pz[i]
    n_ = pw[:, l].copy()
    nz = o != 0
    for j in range(l - 1, -1, -1):
        with np.errstate(divide="ignore", invalid="ignore"):
            t = pw[:, j].copy()
            on = n_ * (l + 1) / ((j + 1) * np.where(nz, o, 1.0))
            off = (pw[:, j] * (l + 1)) / (z * (l - j)) if z != 0 else np.zeros_like(n_)
        pw[:, j] = np.where(nz, on, off)
        n_ = np.where(nz, t - pw[:, j] * z * (l - j) / (l + 1), n_)
    pz[i:l] = pz[i + 1:l + 1]
    po[:, i:l] = po[:, i + 1:l + 1]
    return l - 1


def tree_shap(X: np.ndarray, tree: dict | None, paths=None) -> np.ndarray:
    """Path-dependent TreeSHAP for one tree over all rows of X (n, p)."""
    n, p = X.shape
    phi = np.zeros((n, p))
    paths = paths if paths is not None else leaf_paths(tree)
    depth = max((len(pt) for _, pt in paths), default=0)
    for value, path in paths:
        L = depth + 2
        pw, pz, po = np.zeros((n, L)), np.zeros(L), np.zeros((n, L))
        feats = [-1]
        _extend(pw, pz, po, 0, 1.0, np.ones(n))
        l = 1
        for f, thr, went_left, z in path:
            x = X[:, f]
            o = ((x <= thr) if went_left else ~(x <= thr)).astype(float)
            if f in feats:  # repeated feature: merge with its earlier element
                k = feats.index(f)
                z, o = z * pz[k], o * po[:, k]
                l = _unwind(pw, pz, po, l - 1, k) + 1
                feats.pop(k)
            _extend(pw, pz, po, l, z, o)
            feats.append(f)
            l += 1
        for i in range(1, l):
            w = _unwound_sum(pw, pz, po, l - 1, i)
            phi[:, feats[i]] += w * (po[:, i] - pz[i]) * value
    return phi


def ensemble_shap(X: np.ndarray, trees: list[dict], weights: list[float]) -> tuple[np.ndarray, float]:
    """(values (n, p), base) on the log-odds scale 2F."""
    return ensemble_shap_paths(X, [leaf_paths(tr) for tr in trees], [expected_value(tr) for tr in trees], weights)


def ensemble_shap_paths(X: np.ndarray, paths: list, bases: list[float], weights: list[float]) -> tuple[np.ndarray, float]:
    """As :func:`ensemble_shap`, from the trees' leaf paths and expected values."""
    phi = np.zeros(X.shape)
    for pt, w in zip(paths, weights):
        phi += w * tree_shap(X, None, pt)
    return 2.0 * phi, 2.0 * sum(w * b for w, b in zip(weights, bases))


def tree_attribution(x: DataFrame, trees: list[dict], weights: list[float], feature_order: list[str],
                     key: str = "customer_id") -> DataFrame:
    """Per member base value and one value per model feature, computed on
    the executors (mapInPandas over Arrow batches). The trees' leaf paths and
    expected values are found once and broadcast; their size is the model's."""
    sc = x.sparkSession.sparkContext
    bc = sc.broadcast(([leaf_paths(t) for t in trees], [expected_value(t) for t in trees], weights))
    cols = [f"x_{f}" for f in feature_order]
    p = len(cols)

    def run(batches):
        paths, bases, wt = bc.value
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=float)
            phi, base = ensemble_shap_paths(X, paths, bases, wt)
            out = pd.DataFrame({key: pdf[key].to_numpy()})
            out["base_value"] = base
            for j in range(p):
                out[f"phi_{feature_order[j]}"] = phi[:, j]
            yield out

    schema = f"{key} bigint, base_value double, " + ", ".join(f"phi_{f} double" for f in feature_order)
    return x.select(key, *cols).mapInPandas(run, schema)


def driver_array(attr: DataFrame, raw: DataFrame, feature_order: list[str], key: str = "customer_id") -> DataFrame:
    """One struct per feature (value rounded to 5, raw value to 4,
    actionable flag, risk direction), sorted by |value| descending."""
    j = attr.join(raw, key, "inner")
    structs = [F.struct(F.lit(f).alias("feature"), fixed(F.col(f"phi_{f}"), 5).alias("shap_value"),
                        fixed(F.col(f).cast("double"), 4).alias("value"),
                        F.lit(bool(S.ACTIONABLE.get(f, False))).alias("actionable"),
                        direction(F.col(f"phi_{f}"), "risk").alias("direction")) for f in feature_order]
    arr = F.array_sort(F.array(*structs), lambda a, b: F.when(F.abs(a.shap_value) > F.abs(b.shap_value), -1)
                       .when(F.abs(a.shap_value) < F.abs(b.shap_value), 1).otherwise(0))
    return j.select(key, fixed("base_value", 5).alias("base_value"), arr.alias("contributions"),
                    F.transform(F.slice(arr, 1, 5), lambda d: d.feature).alias("top_drivers"))


def global_importance(drivers: DataFrame) -> DataFrame:
    """Mean |value| per feature over all members, descending."""
    e = drivers.select(F.explode("contributions").alias("d"))
    return (e.groupBy(F.col("d.feature").alias("feature"))
            .agg(fixed(F.avg(F.abs("d.shap_value")), 5).alias("mean_abs_shap"))
            .orderBy(F.col("mean_abs_shap").desc(), "feature"))


def example_member(drivers: DataFrame, raw: DataFrame, sample: DataFrame, by: str = "Avg_class_frequency_current_month",
                   key: str = "customer_id") -> DataFrame:
    """E5: the waterfall of one member: of the ``sample`` (S15) the one with the lowest ``by`` (the smaller key in a
    tie). Rows customer_id, base_value, step, feature, value, shap_value, running (the log-odds so far)."""
    j = sample.select(key).join(raw.select(key, by), key).join(drivers.select(key, "base_value", "contributions"), key)
    one = j.agg(F.min_by(F.struct(key, "base_value", "contributions"), F.struct(by, key)).alias("m")).where("m IS NOT NULL").select("m.*")
    steps = one.select(key, "base_value", "contributions", F.posexplode("contributions").alias("i", "d"))
    running = F.aggregate(F.slice("contributions", 1, F.col("i") + 1), F.col("base_value"), lambda acc, d: acc + d.shap_value)
    return steps.select(key, "base_value", (F.col("i") + 1).alias("step"), F.col("d.feature").alias("feature"), F.col("d.value").alias("value"),
                        F.col("d.shap_value").alias("shap_value"), fixed(running, 5).alias("running"))
