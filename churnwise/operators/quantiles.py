"""Exact quantiles by radix selection, with bounded memory whatever the number of rows.

A double is mapped to 64 bits whose order is that of the values (``order_bits``, plain expressions). The bits are decided
``DIGIT`` at a time from the top: a pass counts, per group, the rows whose bits so far are those of a wanted order
statistic, by their next digit (at most 2^DIGIT counters for each, partially aggregated in every task), and a running
count over the counters tells the next digit. After 64 / DIGIT passes all bits are known, and the smallest value
counted under them is the order statistic; two of them are interpolated. There is one way for groups of any size, no job
runs while the plan is built, and a hot group sends no more counters than another.

What a pass wants to know is one row per group. ``groups`` states how many groups there can be; where it is given and
small, that row is broadcast to the rows, else Spark chooses the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT = 16
#: Group tables of at most so many rows are broadcast.
BROADCAST_GROUPS = 10_000
_MIN_NORMAL = 2.2250738585072014e-308  # 2^-1022


def order_bits(x: Column) -> Column:
    """A long with the order of the double ``x``: sign, exponent and fraction of the IEEE format, complemented for
    negative values. Infinities and NaN (the largest) have theirs; -0.0 is 0.0."""
    a = F.abs(x)
    guess = F.floor(F.log2(a))  # may be off by one next to a power of two
    e = guess + F.when(F.pow(F.lit(2.0), guess + 1) <= a, 1).when(F.pow(F.lit(2.0), guess) > a, -1).otherwise(0)
    power = F.pow(F.lit(2.0), e)
    normal = (e + 1023) * F.lit(1 << 52) + ((a / power - 1.0) * F.lit(float(1 << 52))).cast("long")
    small = (a / F.lit(_MIN_NORMAL) * F.lit(float(1 << 52))).cast("long")
    bits = (F.when(F.isnan(x), F.lit(0x7FF8 << 48)).when(a == float("inf"), F.lit(0x7FF0 << 48))
            .when(a < F.lit(_MIN_NORMAL), small).otherwise(normal))
    return F.when((x < 0) & ~F.isnan(x), -bits - 1).otherwise(bits)


def _pick(rank: Column, q_idx: int, side: int) -> Column:
    return F.struct(F.lit(q_idx).alias("q_idx"), F.lit(side).alias("side"), rank.cast("long").alias("rank"),
                    F.lit(None).cast("long").alias("bits"), F.lit(None).cast("double").alias("value"))


def _found(pick: Column, bins: Column) -> Column:
    """``pick`` with one more digit, from the sorted counters ``bins`` (bits, n, low) of all picks of the group."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("bits"), F.lit(None).cast("double").alias("value"),
                     pick["rank"].alias("rank"))

    def step(acc, b):
        mine = F.coalesce(F.shiftright(b["bits"], DIGIT) == pick["bits"], pick["bits"].isNull())
        here = mine & acc["bits"].isNull() & (pick["rank"] < acc["before"] + b["n"])
        return F.struct(F.when(mine, acc["before"] + b["n"]).otherwise(acc["before"]).alias("before"),
                        F.when(here, b["bits"]).otherwise(acc["bits"]).alias("bits"), F.when(here, b["low"]).otherwise(acc["value"]).alias("value"),
                        F.when(here, pick["rank"] - acc["before"]).otherwise(acc["rank"]).alias("rank"))

    end = F.aggregate(bins, start, step)
    return F.struct(pick["q_idx"].alias("q_idx"), pick["side"].alias("side"), end["rank"].alias("rank"), end["bits"].alias("bits"),
                    end["value"].alias("value"))


def radix_select(d: DataFrame, by: list[str], probs: list[float], bits: int = 64, groups: int | None = None) -> DataFrame:
    """Per group of ``by``: ``n`` and ``picks``, an array of (q_idx, side, value) with the order statistics at ranks
    floor and ceil of (n - 1) p. ``d``: ``by``, ``_k`` (a long of ``bits`` bits, in order), ``_x`` (the value)."""
    wanted = None
    for shift in range(bits - DIGIT, -1, -DIGIT):
        rows = d.withColumn("_bits", F.shiftright("_k", shift))
        if wanted is None:
            counted = rows.groupBy(*by, "_bits").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"))
            state = [F.sum("_n").alias("_total")]
        else:
            side = wanted.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(by)], "_total", "_picks")
            same = F.lit(True)
            for i, c in enumerate(by):
                same = same & F.col(c).eqNullSafe(F.col(f"_h{i}"))
            if groups is not None and groups <= BROADCAST_GROUPS:
                side = F.broadcast(side)
            hit = rows.join(side, same).where(F.exists("_picks", lambda p: p["bits"] == F.shiftright("_bits", DIGIT)))
            counted = hit.groupBy(*by, "_bits").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"),
                                                    F.any_value("_total").alias("_total"), F.any_value("_picks").alias("_picks"))
            state = [F.any_value("_total").alias("_total"), F.any_value("_picks").alias("_picks")]
        one = counted.groupBy(*by).agg(*state, F.array_sort(F.collect_list(F.struct(
            F.col("_bits").alias("bits"), F.col("_n").alias("n"), F.col("_low").alias("low")))).alias("_bins"))
        if wanted is None:
            at = [(F.col("_total") - 1).cast("double") * F.lit(float(p)) for p in probs]
            one = one.withColumn("_picks", F.array(*[_pick(f(a), i, s) for i, a in enumerate(at) for s, f in ((0, F.floor), (1, F.ceil))]))
        wanted = one.select(*by, "_total", F.transform("_picks", lambda p: _found(p, F.col("_bins"))).alias("_picks"))
    return wanted.select(*by, F.col("_total").alias("n"), F.col("_picks").alias("picks"))


def interpolated(selected: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """Rows (by..., q_idx, p, quantile) from :func:`radix_select`."""
    rows = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1).cast("double") * F.lit(float(p))
        lo, hi, frac = F.col("picks")[2 * i]["value"], F.col("picks")[2 * i + 1]["value"], pos - F.floor(pos)
        rows.append(F.struct(F.lit(i).alias("q_idx"), F.lit(float(p)).alias("p"), F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).alias("quantile")))
    return selected.select(*by, F.explode(F.array(*rows)).alias("_q")).select(*by, "_q.*")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
                    groups: int | None = None) -> DataFrame:
    """Rows (by..., q_idx, p, quantile): linear interpolation between the order statistics, as numpy / pandas / DuckDB
    ``quantile_cont``. Null values are left out; a group without values has no rows."""
    by = by or []
    names = [f"_g{i}" for i in range(len(by))] or ["_g0"]
    keys = [F.col(c).alias(n) for c, n in zip(by, names)] or [F.lit(0).alias("_g0")]
    d = df.select(*keys, F.col(value).cast("double").alias("_x")).where("_x IS NOT NULL").withColumn("_k", order_bits(F.col("_x")))
    q = interpolated(radix_select(d, names, probs, groups=groups if by else 1), names, probs)
    return q.select(*[F.col(n).alias(c) for c, n in zip(by, names)], "q_idx", "p", "quantile")


def quantiles_long(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                   by_groups: int | None = None) -> DataFrame:
    """Exact quantiles of several columns in one set of passes: the columns
    are stacked into (feature, value) pairs and the feature is one more
    group key. Rows (by..., feature, q_idx, p, quantile). ``by_groups``: how
    many groups ``by`` has at most, if that is known."""
    by = by or []
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
                                for c in cols]))
    long = df.select(*by, pairs.alias("_pv")).select(*by, "_pv.feature", "_pv.v")
    known = 1 if not by else by_groups
    return exact_quantiles(long, "v", probs, by=[*by, "feature"], groups=known and known * len(cols))


def quantile_map(df: DataFrame, cols: list[str], probs: list[float]) -> dict[tuple[str, float], float]:
    """{(column, p): quantile} for a few columns (a bounded result read back)."""
    return {(r.feature, r.p): r.quantile for r in quantiles_long(df, cols, probs).collect()}
