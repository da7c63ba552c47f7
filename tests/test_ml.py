"""Model pipeline on a seeded generator whose label follows a logistic of the
features (the driver fixture's label is unrelated to its features), and the
tree attribution against exhaustive Shapley enumeration."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise import schema as S
from churnwise.operators import attribution as at
from churnwise.operators import ml


@pytest.fixture(scope="module")
def synthetic(spark):
    u = lambda s: F.rand(seed=s)
    df = spark.range(3000).repartition(4, "id").select(
        F.col("id").alias("customer_id"),
        (u(1) < 0.5).cast("int").alias("gender"), (u(2) < 0.8).cast("int").alias("Near_Location"),
        (u(3) < 0.5).cast("int").alias("Partner"), (u(4) < 0.3).cast("int").alias("Promo_friends"),
        (u(5) < 0.9).cast("int").alias("Phone"),
        F.when(u(6) < 0.5, 1).when(u(6) < 0.75, 6).otherwise(12).alias("Contract_period"),
        (u(7) < 0.4).cast("int").alias("Group_visits"), (18 + F.floor(u(8) * 24)).cast("int").alias("Age"),
        (u(9) * 300).alias("Avg_additional_charges_total"), (1 + F.floor(u(10) * 12)).alias("Month_to_end_contract"),
        F.floor(u(11) * 12).cast("int").alias("Lifetime"), (u(12) * 4).alias("Avg_class_frequency_total"),
        (u(13) * 4).alias("Avg_class_frequency_current_month"), u(14).alias("_u"))
    z = (1.0 - 1.2 * F.col("Avg_class_frequency_current_month") + 0.9 * F.col("Avg_class_frequency_total")
         - 0.25 * F.col("Lifetime") - 0.08 * F.col("Contract_period") + 0.6)
    return df.withColumn("Churn", (F.col("_u") < 1 / (1 + F.exp(-z))).cast("int")).drop("_u").cache()


def test_train_quality_and_threshold(synthetic):
    model, scored = ml.train_model(synthetic, params={"maxIter": 30, "maxDepth": 3})
    m = {r.split: r for r in ml.split_metrics(scored, model.threshold).collect()}
    assert m["test"].roc_auc > 0.75 and m["val"].roc_auc > 0.75
    assert 0.05 <= model.threshold <= 0.95
    assert model.calibrator.method in ("sigmoid", "isotonic")


def test_prep_fit_on_train_only(synthetic):
    d = ml.prepare_members(synthetic)
    p_train = ml.fit_prep(d.filter(F.col("split") == "train"))
    p_all = ml.fit_prep(d)
    assert p_train.params["Avg_additional_charges_total"]["mean"] != p_all.params["Avg_additional_charges_total"]["mean"]
    hi = p_train.params["Avg_class_frequency_total"]["upper"]
    tr = d.filter(F.col("split") == "train").select(F.col("Avg_class_frequency_total").cast("double").alias("x")).toPandas()
    assert hi == pytest.approx(np.percentile(tr.x, 99))


def test_attribution_additivity(spark, synthetic):
    model, _ = ml.train_model(synthetic, params={"maxIter": 10, "maxDepth": 3})
    trees, weights = at.extract_trees(model.trees, spark)
    from churnwise.functions.core import with_derived_features
    x = model.prep.transform(with_derived_features(synthetic), ["customer_id"])
    a = at.tree_attribution(x, trees, weights, model.prep.output_order)
    marg = ml.margin_col(model.trees.transform(x)).select("customer_id", "margin")
    s = sum((F.col(f"phi_{f}") for f in model.prep.output_order), F.col("base_value"))
    err = a.join(marg, "customer_id").agg(F.max(F.abs(s - 2 * F.col("margin")))).first()[0]
    assert err < 1e-9


def _brute_shap(x, tree, p):
    def v(S_):
        def rec(n):
            if tree["left"][n] < 0:
                return tree["value"][n]
            f = tree["feature"][n]
            l, r = tree["left"][n], tree["right"][n]
            if f in S_:
                return rec(l if x[f] <= tree["threshold"][n] else r)
            c = tree["cover"][n]
            return (tree["cover"][l] * rec(l) + tree["cover"][r] * rec(r)) / c
        return rec(0)
    phi = np.zeros(p)
    for i in range(p):
        others = [j for j in range(p) if j != i]
        for k in range(p):
            for S_ in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                phi[i] += w * (v(set(S_) | {i}) - v(set(S_)))
    return phi


def test_tree_shap_matches_enumeration():
    rng = np.random.default_rng(3)
    # a depth-3 tree that splits on feature 0 twice (repeated-feature path)
    left = np.array([1, 3, 5, -1, -1, 7, -1, -1, -1, -1, -1])
    right = np.array([2, 4, 6, -1, -1, 8, -1, -1, -1, -1, -1])
    feature = np.array([0, 1, 0, -1, -1, 2, -1, -1, -1, -1, -1])
    threshold = np.array([0.5, 0.3, 0.8, 0, 0, 0.6, 0, 0, 0, 0, 0], dtype=float)
    value = np.array([0, 0, 0, 1.0, -2.0, 0, 3.0, 0.5, -1.5, 0, 0])
    cover = np.array([100, 40, 60, 25, 15, 35, 25, 20, 15, 0, 0], dtype=float)
    tree = {"left": left, "right": right, "feature": feature, "threshold": threshold, "value": value, "cover": cover}
    X = rng.random((25, 3))
    phi = at.tree_shap(X, tree)
    for r in range(len(X)):
        assert phi[r] == pytest.approx(_brute_shap(X[r], tree, 3), abs=1e-12)
