"""The trained model as one SQL expression over the raw features, without Spark ML: preprocessing from the parameter
table (M5), every tree as nested CASE expressions, and the calibration curves. It scores where Spark ML is not at hand
(a view, another SQL engine for the margins) and is the second of the two paths that ``scoring_parity`` compares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calibrate import Calibrator, fold_margin


def number(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def prepared_sql(feature: str, p: dict | None) -> str:
    """A model input from its raw column: clipped, median for null, standardised; flags (no parameters) as they are."""
    x = f"CAST({feature} AS DOUBLE)"
    if p is None:
        return x
    if p.get("lower") is not None:
        x = f"LEAST(GREATEST({x}, {number(p['lower'])}), {number(p['upper'])})"
    return f"((COALESCE({x}, {number(p['median'])}) - {number(p['mean'])}) / {number(p['scale'])})"


def tree_sql(tree: dict, inputs: list[str], node: int = 0) -> str:
    if tree["left"][node] < 0:
        return number(tree["value"][node])
    left, right = (tree_sql(tree, inputs, int(tree[side][node])) for side in ("left", "right"))
    return f"(CASE WHEN {inputs[int(tree['feature'][node])]} <= {number(tree['threshold'][node])} THEN {left} ELSE {right} END)"


def margin_sql(trees: list[dict], weights: list[float], inputs: list[str]) -> str:
    """F(x), the weighted sum of the trees. Null inputs go right, as no comparison holds."""
    return " + ".join(f"{number(w)} * {tree_sql(t, inputs)}" for t, w in zip(trees, weights))


def score_compiled(members: DataFrame, prep, ensembles: list[tuple[list[dict], list[float]]], calibrator: Calibrator,
                   keep: list[str], out: str = "p_compiled") -> DataFrame:
    """Calibrated probability of members that have the model's raw and derived columns; ``ensembles``: trees and weights
    of each fold model."""
    names = [f"x_{f}" for f in prep.output_order]
    x = members.select(*keep, *[F.expr(prepared_sql(f, prep.params.get(f))).alias(n) for f, n in zip(prep.output_order, names)])
    margins = [F.expr(margin_sql(trees, weights, names)).alias(fold_margin(f)) for f, (trees, weights) in enumerate(ensembles)]
    return calibrator.apply(x.select(*keep, *margins), out).select(*keep, out)
