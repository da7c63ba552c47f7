"""The search over the boosted trees' space by successive halving.

Trials are drawn with a seed: trees, depth, rate, row and column share, minimum weight of a leaf, gain a split must bring
and the positive class's weight. (Penalties on leaf values have no counterpart in Spark's trees.) All start with few trees on one of the
prepared folds; after each rung the better half goes on with twice the trees and more folds, and the last rung is a full
cross-validation with the trial's own number of trees. The folds, their split of the training rows and the class weights
are made once and stored; the trials of a rung run as parallel Spark jobs on them.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import stored
from . import ml

#: name -> (kind, low, high); ``scale_pos_weight`` is times the ratio of the classes.
SPACE = {"n_estimators": ("int", 100, 600), "max_depth": ("int", 2, 6), "learning_rate": ("log", 0.01, 0.3), "subsample": ("float", 0.6, 1.0),
         "colsample_bytree": ("float", 0.6, 1.0), "min_child_weight": ("int", 1, 10), "gamma": ("float", 0.0, 5.0),
         "scale_pos_weight": ("float", 0.5, 1.5)}


def draw(rnd: random.Random, space: dict = SPACE) -> dict:
    pick = {"int": lambda a, b: rnd.randint(a, b), "float": rnd.uniform, "log": lambda a, b: math.exp(rnd.uniform(math.log(a), math.log(b)))}
    return {name: pick[kind](low, high) for name, (kind, low, high) in space.items()}


def estimator(trial: dict, trees: int, n_train: int, seed: int = S.SEED) -> GBTClassifier:
    """A trial's parameters for Spark's boosted trees with ``trees`` rounds."""
    return GBTClassifier(featuresCol="features", labelCol=S.TARGET, weightCol="weight", seed=seed, maxIter=trees, maxDepth=trial["max_depth"],
                         stepSize=trial["learning_rate"], subsamplingRate=trial["subsample"], featureSubsetStrategy=repr(round(trial["colsample_bytree"], 4)),
                         minInfoGain=trial["gamma"] / n_train, minWeightFractionPerNode=min(0.49, trial["min_child_weight"] / n_train))


def weighted(train: DataFrame, factor: float) -> DataFrame:
    """``weight``: ``factor`` times the classes' ratio for label 1, and 1 for label 0. ``train`` has ``ratio``."""
    return train.withColumn("weight", F.when(F.col(S.TARGET) == 1, F.col("ratio") * F.lit(factor)).otherwise(F.lit(1.0)))


def prepared_folds(train: DataFrame, k: int) -> DataFrame:
    """The training rows with ``fold`` and the ratio of the classes, stored for all trials."""
    counts = train.agg(F.count_if(F.col(S.TARGET) == 0).alias("n0"), F.count_if(F.col(S.TARGET) == 1).alias("n1")).first()
    rows = ml.assign_folds(train, k).withColumn("ratio", F.lit(counts.n0 / max(counts.n1, 1)))
    return stored(rows.select("customer_id", S.TARGET, "features", "fold", "ratio"), "tune-folds")


def rungs(n_trials: int, k: int, least: int = 5) -> list[tuple[int, float, int]]:
    """(trials, share of their trees, folds) of each rung; the last is the full cross-validation."""
    out, n = [], n_trials
    levels = max(1, math.ceil(math.log2(max(n_trials, 2))) - 1)
    for i in range(levels + 1):
        share = 2.0 ** (i - levels)
        out.append((n, share, k if i == levels else max(1, round(k * share))))
        n = max(1, math.ceil(n / 2))
    return out


def tune(train: DataFrame, n_trials: int = 8, k: int = S.KFOLDS, seed: int = S.SEED, parallel: int = 2, space: dict = SPACE,
         halving: bool = True) -> dict:
    """``best_params``, ``best_auc`` and ``trials`` (each with its rung, trees, folds and mean AUC). ``train``:
    customer_id, the label, features. Without ``halving`` every trial gets the full cross-validation."""
    rnd = random.Random(seed)
    folded = prepared_folds(train, k)
    n_train = folded.count()
    trials = [dict(draw(rnd, space), trial=i) for i in range(n_trials)]
    log, spent = [], 0

    def score(job) -> float:
        trial, trees, folds = job
        rows = weighted(folded, trial["scale_pos_weight"])
        aucs = []
        for f in range(folds):
            model = estimator(trial, trees, n_train, seed).fit(rows.where(F.col("fold") != f))
            aucs.append(ml.auc_of(ml.prob_col(model.transform(rows.where(F.col("fold") == f))), "p_model"))
        return sum(aucs) / len(aucs)

    alive = trials
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for rung, (n, share, folds) in enumerate(rungs(n_trials, k) if halving else [(n_trials, 1.0, k)]):
            alive = alive[:n]
            jobs = [(t, max(1, round(t["n_estimators"] * share)), folds) for t in alive]
            scores = list(pool.map(score, jobs))
            spent += sum(trees * f for _, trees, f in jobs)
            ranked = sorted(zip(scores, jobs), key=lambda x: (-x[0], x[1][0]["trial"]))
            log += [dict(t, rung=rung, trees=trees, folds=f, mean_auc=s) for s, (t, trees, f) in ranked]
            alive = [t for _, (t, _, _) in ranked]
            best = ranked[0]
    params = {k_: v for k_, v in best[1][0].items() if k_ != "trial"}
    return {"best_params": params, "best_auc": best[0], "trials": log, "trees_grown": spent}
