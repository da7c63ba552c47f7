"""Model bundle and artefact sinks (S5, S6, S14) and the Winsorizer stage.

The bundle is a directory: the Spark ML tree model, the preprocessing
parameter table, the calibrator and a one-row metadata table. Everything
is written by Spark (parquet / JSON), so it lives in the shared folder and
loads on any executor layout.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.calibrate import Calibrator
from ..operators.ml import ChurnModel, PrepModel


def save_bundle(model: ChurnModel, path: str, spark: SparkSession) -> None:
    """Write the bundle (overwrite = idempotent reload)."""
    model.trees.write().overwrite().save(f"{path}/trees")
    for f, trees in enumerate(model.fold_trees):
        trees.write().overwrite().save(f"{path}/fold_trees/{f}")
    model.prep.param_table(spark).write.mode("overwrite").parquet(f"{path}/prep")
    curves = [(f, [float(v) for v in values]) for f, values in enumerate(model.calibrator.folds)]
    spark.createDataFrame(curves, "fold int, curve array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/calibrator")
    meta = {"version": model.version, "threshold": model.threshold, "calibration": model.calibrator.method,
            "numeric": model.prep.numeric, "binary": model.prep.binary}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{path}/meta")


def load_bundle(path: str, spark: SparkSession) -> ChurnModel:
    """Load once; the parameter, calibration and metadata tables are a few rows."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    rows = spark.read.parquet(f"{path}/prep").collect()  # one row per feature
    params = {r.feature: {"lower": r.lower, "upper": r.upper, "median": r.median, "mean": r.mean,
                          "scale": r.scale} for r in rows}
    prep = PrepModel(meta["numeric"], meta["binary"], params)
    folds = spark.read.parquet(f"{path}/calibrator").orderBy("fold").collect()  # one row per fold
    cal = Calibrator(meta["calibration"], [tuple(r.curve) if meta["calibration"] == "sigmoid" else np.array(r.curve) for r in folds])
    load = GBTClassificationModel.load
    return ChurnModel(prep, load(f"{path}/trees"), [load(f"{path}/fold_trees/{r.fold}") for r in folds], cal, meta["threshold"], meta["version"])


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Small metrics / feature-meta tables as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def feature_meta(spark: SparkSession, prep: PrepModel, threshold: float) -> DataFrame:
    """Feature order, actionable flag, tiers, threshold and costs."""
    rows = [(i, f, bool(S.ACTIONABLE.get(f, False))) for i, f in enumerate(prep.output_order)]
    t = spark.createDataFrame(rows, "position int, feature string, actionable boolean")
    return t.withColumns({"threshold": F.lit(threshold), "cost_fn": F.lit(S.COST_FN), "cost_fp": F.lit(S.COST_FP),
                          "cost_tp": F.lit(S.COST_TP), "min_recall": F.lit(S.MIN_RECALL),
                          "tiers": F.lit("baixo<0.30<=medio<0.60<=alto")})


def write_eda_bundle(models: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Every EDA read model under one folder (a parquet folder each); returns them as read back. The models are
    independent, so their jobs run beside each other."""
    def write(item) -> tuple[str, DataFrame]:
        name, df = item
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return name, df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(pool.map(write, models.items()))


# ---------------------------------------------------------------------------
# Winsorizer as a Spark ML Estimator / Model (fit on train, clip on apply).
# ---------------------------------------------------------------------------
class _WinsorParams(HasInputCols):
    percentile = Param(Params._dummy(), "percentile", "upper percentile (lower = 100 - p)",
                       typeConverter=TypeConverters.toFloat)
    bounds = Param(Params._dummy(), "bounds", "fitted bounds as JSON {col: [lower, upper]}",
                   typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(percentile=float(S.WINSORIZE_PERCENTILE), bounds="{}")


class Winsorizer(Estimator, _WinsorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the p / 100 - p percentiles (linear interpolation) of each input
    column in one aggregation; the model clips with least/greatest."""

    @keyword_only
    def __init__(self, *, inputCols=None, percentile=float(S.WINSORIZE_PERCENTILE)):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "WinsorizerModel":
        p = self.getOrDefault(self.percentile)
        cols = self.getInputCols()
        from ..operators.quantiles import quantile_map
        lo, hi = (100 - p) / 100.0, p / 100.0
        qm = quantile_map(df, cols, [lo, hi])
        m = WinsorizerModel()
        m._set(inputCols=cols, percentile=p, bounds=json.dumps({c: [qm[(c, lo)], qm[(c, hi)]] for c in cols}))
        return m


class WinsorizerModel(Model, _WinsorParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        b = json.loads(self.getOrDefault(self.bounds))
        return df.withColumns({c: F.least(F.greatest(F.col(c).cast("double"), F.lit(lo)), F.lit(hi))
                               for c, (lo, hi) in b.items()})
