"""Projections, validation and cleaning.

Checks run as one aggregation each (never a collect of rows); failures raise
with the offending names or counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .profile import clean_report


class DataQualityError(ValueError):
    pass


def model_features(df: DataFrame) -> DataFrame:
    """Raw minus leaky, then derived numeric, then derived binary."""
    return df.select(*S.model_feature_list())


def check_columns(df: DataFrame, required: list[str]) -> None:
    """Error naming the missing columns (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataQualityError(f"missing columns: {', '.join(missing)}")


def check_binary_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Non-empty and target within {0, 1}; returns the one-row counts."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.count_if(~F.col(target).isin(0, 1) | F.col(target).isNull()).alias("bad"))
    row = r.first()
    if row.n == 0:
        raise DataQualityError("empty dataset")
    if row.bad:
        raise DataQualityError(f"{row.bad} target values outside {{0, 1}}")
    return r


def clean(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Project, drop rows with nulls, drop exact duplicates; and the report
    (``profile.clean_report``): duplicates are counted on all columns and
    removed on the selected ones, as the reference does."""
    return df.select(*cols).dropna().dropDuplicates(), clean_report(df, cols)


def guard_min_rows(df: DataFrame, n: int = 10, target: str | None = S.TARGET, per_class: int = 0) -> None:
    """P5: at least ``n`` rows and, if asked, ``per_class`` rows of each class."""
    if target is None:
        if df.limit(n).count() < n:
            raise DataQualityError(f"fewer than {n} rows")
        return
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 0).alias("c0"),
               F.count_if(F.col(target) == 1).alias("c1")).first()
    if r.n < n:
        raise DataQualityError(f"fewer than {n} rows ({r.n})")
    if per_class and (r.c0 < per_class or r.c1 < per_class):
        raise DataQualityError(f"each class needs {per_class} rows (0: {r.c0}, 1: {r.c1})")


def fill_defaults(df: DataFrame, defaults: dict[str, float], features: list[str] = S.LEGACY_FEATURES,
                  min_informed: int = 2) -> DataFrame:
    """P10: batch of partial records. ``informed`` counts the non-null
    features; rows with fewer than ``min_informed`` are rejected (no values
    filled), the others get every missing feature from ``defaults``."""
    informed = sum((F.col(f).isNotNull().cast("int") for f in features), F.lit(0))
    d = df.withColumn("informed", informed).withColumn("accepted", F.col("informed") >= min_informed)
    return d.withColumns({f: F.when(F.col("accepted"), F.coalesce(F.col(f).cast("double"), F.lit(float(defaults[f]))))
                          .otherwise(F.col(f).cast("double")) for f in features})


def apply_overrides(df: DataFrame, overrides: dict[str, Column | float]) -> DataFrame:
    """Replace named features, the base row otherwise unchanged."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in overrides.items()})
