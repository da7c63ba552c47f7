"""Calibration by k fold models (the average of k models, each calibrated on the fold that it has not seen).

Every training row's margin comes from the model of the other folds. One aggregation turns the margins into a histogram
per fold, ``BINS`` bins over [-RANGE, RANGE] (a margin outside lies in the last bin); what follows works on these k x
BINS counts, whatever the number of rows. Per fold a sigmoid (Platt's targets, Newton steps) and an isotonic curve (pool
adjacent violators) are fitted. The curve is kept as its values at the bins, one array, so applying it is one position
and one interpolation, with no search. A member's probability is the mean over the folds' models.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

BINS, RANGE = 4096, 8.0
WIDTH = 2 * RANGE / BINS
CENTRES = -RANGE + (np.arange(BINS) + 0.5) * WIDTH


def fold_margin(f: int) -> str:
    return f"margin_{f}"


def add_margin(pred: DataFrame, model, out: str) -> DataFrame:
    """``pred`` with the raw margin of the boosted trees ``model`` as ``out``."""
    return model.transform(pred).withColumn(out, vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def bin_of(margin: Column | str) -> Column:
    m = F.col(margin) if isinstance(margin, str) else margin
    return F.least(F.greatest(F.floor((m + RANGE) / WIDTH), F.lit(0)), F.lit(BINS - 1)).cast("int")


def histograms(oof: DataFrame, k: int, label: str = S.TARGET) -> np.ndarray:
    """k x 2 x BINS counts of the rows (fold, margin, label): label 0 and 1 per bin."""
    out = np.zeros((k, 2, BINS))
    rows = oof.groupBy("fold", bin_of("margin").alias("bin")).agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    for r in rows.collect():  # k x BINS at most
        out[r.fold, 0, r.bin], out[r.fold, 1, r.bin] = r.n0, r.n1
    return out


def pool_adjacent_violators(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence next to ``mean`` in weighted least squares."""
    pools: list[list[float]] = []  # weight, weighted sum, length
    for w, m in zip(weight, mean):
        pools.append([w, w * m, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            a, b = pools.pop(), pools.pop()
            pools.append([x + y for x, y in zip(a, b)])
    return np.concatenate([np.full(int(n), s / w) for w, s, n in pools]) if pools else np.zeros(0)


def isotonic(hist: np.ndarray) -> np.ndarray:
    """Values at all bins' centres: pooled where there are rows, linear between, constant beyond."""
    n = hist.sum(0)
    at = np.flatnonzero(n)
    if not len(at):
        return np.full(BINS, 0.5)
    return np.interp(CENTRES, CENTRES[at], pool_adjacent_violators(n[at], hist[1, at] / n[at]))


def sigmoid(hist: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a x + b))): Newton on the counts with Platt's targets, damped by halving."""
    n0, n1 = hist.sum(1)
    t1, t0 = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    n = hist.sum(0)
    want = hist[1] * t1 + hist[0] * t0
    x = np.vstack([CENTRES, np.ones(BINS)])
    ab = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])

    def loss(v):
        z = v @ x
        return float((n * np.logaddexp(0, z) - want * z).sum())

    for _ in range(steps):
        p = 1 / (1 + np.exp(-(ab @ x)))
        gradient, curve = x @ (n * p - want), (x * (n * p * (1 - p))) @ x.T + 1e-12 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        size, now = 1.0, loss(ab)
        while loss(ab - size * step) > now and size > 1e-10:
            size /= 2
        ab = ab - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return float(ab[0]), float(ab[1])


@dataclass
class Calibrator:
    """``folds``: per fold model (a, b) of a sigmoid, or an isotonic curve's values at the bins."""
    method: str
    folds: list

    def curve(self, f: int, margin: Column) -> Column:
        if self.method == "sigmoid":
            a, b = self.folds[f]
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * margin + F.lit(b))))
        values = F.split(F.lit(",".join(repr(float(v)) for v in self.folds[f])), ",").cast("array<double>")  # folded to a constant
        at = F.least(F.greatest((margin + RANGE) / WIDTH - 0.5, F.lit(0.0)), F.lit(BINS - 1.0))
        i = F.least(F.floor(at), F.lit(BINS - 2)).cast("int")
        low, high = F.element_at(values, i + 1), F.element_at(values, i + 2)
        return low + (high - low) * (at - i)

    def apply(self, pred: DataFrame, out: str = "p_cal") -> DataFrame:
        """The mean of the folds' calibrated probabilities, from the columns ``margin_0`` ... of ``pred``."""
        curves = [self.curve(f, F.col(fold_margin(f))) for f in range(len(self.folds))]
        return pred.withColumn(out, sum(curves[1:], curves[0]) / F.lit(float(len(curves))))


def calibrators(oof: DataFrame, k: int) -> list[Calibrator]:
    """Both methods, fitted on rows (fold, margin, label) of margins that each fold's model has not seen."""
    h = histograms(oof, k)
    return [Calibrator("sigmoid", [sigmoid(x) for x in h]), Calibrator("isotonic", [isotonic(x) for x in h])]
