"""Column profiles (A2, A4, P4): distinct counts without an Expand, and profiles that can be kept and merged.

The exact profile counts (column, value) pairs: every row gives a pair per column, which tasks add up before the shuffle,
so a column with few values costs a row per value and task, and no column is counted in the way of another. A kept
profile has a row per column with counts and a HyperLogLog sketch; profiles of days (or of any parts) are merged without
the rows, at a relative error of about 1.04 / sqrt(2^``LOG2_BUCKETS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG2_BUCKETS = 14


def _text(c: str, kind: str) -> Column:
    """A value as text, equal for equal values (-0.0 is 0.0)."""
    x = F.col(f"`{c}`")
    return (x + F.lit(0.0)).cast("string") if kind in ("double", "float") else x.cast("string")


def _pairs(df: DataFrame, by: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    cols = [c for c in df.columns if c not in by]
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _text(c, kinds[c]).alias("value")) for c in cols])).alias("_p")
    return df.select(*by, pair).select(*by, "_p.*")


def column_profile(df: DataFrame) -> DataFrame:
    """A2: column, dtype, nulls, distinct_values (nulls are no value); columns of an empty table have zeros."""
    counted = _pairs(df, []).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per = counted.groupBy("column").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
                                        F.count("value").alias("distinct_values"))
    names = df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")  # the table's columns
    return names.join(per, "column", "left").select("column", "dtype", F.coalesce("nulls", F.lit(0)).cast("bigint").alias("nulls"),
                                                    F.coalesce("distinct_values", F.lit(0)).cast("bigint").alias("distinct_values"))


def profile_sketch(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A profile to be kept: per column (and per group of ``by``, a day for instance) rows, nulls and the sketch of the
    distinct values. One pass; a row per column and group."""
    by = by or []
    return _pairs(df, by).groupBy(*by, "column").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("nulls"),
                                                     F.hll_sketch_agg("value", F.lit(LOG2_BUCKETS)).alias("sketch"))


def merge_profiles(kept: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Kept profiles merged per column (and group of ``by``), still a kept profile."""
    return kept.groupBy(*(by or []), "column").agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"),
                                                   F.hll_union_agg("sketch").alias("sketch"))


def read_profile(kept: DataFrame) -> DataFrame:
    """column, n_rows, nulls and the estimated distinct values of kept profiles."""
    return kept.withColumn("distinct_values", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0))).drop("sketch")


def duplicate_count(df: DataFrame) -> DataFrame:
    """A4: rows, distinct rows over all columns, and what is left: rows are grouped and added up, once."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return g.agg(F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("distinct_rows")).select(
        "n_rows", "distinct_rows", (F.col("n_rows") - F.col("distinct_rows")).alias("duplicates"))


def clean_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """P4's report: rows_original; rows_clean (distinct and complete in ``cols``); duplicates_removed (over ALL columns of
    ``df``, as the reference counts them); null_values in ``cols``. Rows are grouped by all columns, the groups by
    ``cols``: two shuffles of distinct rows."""
    nulls, complete = F.lit(0), F.lit(True)
    for c in cols:
        nulls, complete = nulls + F.col(f"`{c}`").isNull().cast("bigint"), complete & F.col(f"`{c}`").isNotNull()
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    g = copies.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_distinct"))
    zero = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    return g.agg(zero(F.col("_rows"), "rows_original"), F.count_if(complete).alias("rows_clean"),
                 zero(F.col("_rows") - F.col("_distinct"), "duplicates_removed"), zero(F.col("_rows") * nulls, "null_values"))
