"""Left join of rows to a table with one row per key, when a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is hot if it holds more than this share of all rows, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 1000


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys that hold more than ``share`` of all rows, null left out: at most 1 / share of them, whatever the rows."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.where((F.col("n") > total * share) & F.col(key).isNotNull()).select(key).collect()]


def left_join(rows: DataFrame, side: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """``rows`` left-joined to ``side``, which has one row per ``key``. ``rows`` should be a stored table: it is read for
    the counts and for each branch. Rows with a hot key meet the few rows of ``side`` that have one, which are broadcast
    (1 / share rows at most); rows without a key meet nothing and are not moved; the others are joined by a shuffle in
    which no key has more than ``share`` of the rows."""
    added = [f for f in side.schema if f.name != key]
    hot = hot_keys(rows, key, share)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    out = rows.where(F.col(key).isNotNull() & ~is_hot).join(side, key, "left")
    if hot:
        out = out.unionByName(rows.where(is_hot).join(F.broadcast(side.where(is_hot)), key, "left"))
    alone = rows.where(F.col(key).isNull())
    return out.unionByName(alone.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added)))
