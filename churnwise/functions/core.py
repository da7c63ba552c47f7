"""Scalar column expressions (F1-F11). All JVM-side, no Python UDF.

Each helper returns a ``Column`` so it composes inside ``select``/``withColumn``
and stays within whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: ColLike) -> Column:
    """Explicit double cast: keeps integer / decimal arithmetic identical to DuckDB."""
    return col(c).cast("double")


def safe_divide(num: ColLike, den: ColLike) -> Column:
    """F1: num / den, 0.0 where the denominator is 0 or null (or the result is NaN)."""
    q = F.try_divide(dbl(num), dbl(den))
    return F.when(F.isnan(q), F.lit(0.0)).otherwise(F.coalesce(q, F.lit(0.0)))


def fixed(x: ColLike, d: int) -> Column:
    """round half up to ``d`` decimals as floor(x*10^d + 0.5) / 10^d.

    Gives the same double in Spark and DuckDB (``round`` does not, see SURVEY
    §2.16) and matches toFixed on values that are not exact binary ties.
    """
    scale = float(10 ** d)
    return F.floor(dbl(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def sigmoid(x: ColLike) -> Column:
    """1 / (1 + e^-x)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-dbl(x)))


def clamp01(p: ColLike) -> Column:
    """F8: NaN or null to 0, then clip into [0, 1]."""
    p = dbl(p)
    return F.when(p.isNull() | F.isnan(p), F.lit(0.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


# Derived engagement features.
def ratio_freq(cur: ColLike = "Avg_class_frequency_current_month",
               tot: ColLike = "Avg_class_frequency_total") -> Column:
    return safe_divide(cur, tot)


def delta_freq(cur: ColLike = "Avg_class_frequency_current_month",
               tot: ColLike = "Avg_class_frequency_total") -> Column:
    return dbl(cur) - dbl(tot)


def flag_early_user(lifetime: ColLike = "Lifetime") -> Column:
    return (col(lifetime) <= 1).cast("int")


def flag_sleeping_dog(lifetime: ColLike = "Lifetime",
                      cur: ColLike = "Avg_class_frequency_current_month") -> Column:
    return ((col(lifetime) > 6) & (col(cur) < 0.5)).cast("int")


def contract_x_lifetime(contract: ColLike = "Contract_period", lifetime: ColLike = "Lifetime") -> Column:
    return dbl(contract) * dbl(lifetime)


# Tier cut schemes (lower bounds, highest first).
TIER_SCHEMES = {
    "model": [(0.60, "alto"), (0.30, "medio"), (0.00, "baixo")],
    "scorecard": [(0.75, "critico"), (0.55, "alto"), (0.35, "medio")],
    "legacy": [(0.7, "high"), (0.4, "medium")],
}
LEGACY_BAND_LABELS = {"high": "Alto Risco", "medium": "Risco Médio", "low": "Baixo Risco"}


def risk_tier(p: ColLike, scheme: str = "scorecard") -> Column:
    """probability to tier under one of the reference's cut schemes.

    * ``model``: [0, .30) baixo, [.30, .60) medio, else alto (never critico).
    * ``scorecard``: >= .75 critico, >= .55 alto, >= .35 medio, else baixo.
    * ``legacy``: >= .7 high, >= .4 medium, else low.
    * ``legacy_bands``: right-closed bands (-0.01, .4], (.4, .7], (.7, 1.01];
      labels Baixo/Risco Médio/Alto Risco, null outside.
    """
    p = dbl(p)
    if scheme == "model":
        return (F.when((p >= 0.0) & (p < 0.30), "baixo")
                .when((p >= 0.30) & (p < 0.60), "medio")
                .otherwise("alto"))
    if scheme == "scorecard":
        return F.when(p >= 0.75, "critico").when(p >= 0.55, "alto").when(p >= 0.35, "medio").otherwise("baixo")
    if scheme == "legacy":
        return F.when(p >= 0.7, "high").when(p >= 0.4, "medium").otherwise("low")
    if scheme == "legacy_bands":
        return (F.when((p > -0.01) & (p <= 0.4), "Baixo Risco")
                .when((p > 0.4) & (p <= 0.7), "Risco Médio")
                .when((p > 0.7) & (p <= 1.01), "Alto Risco"))
    raise ValueError(f"unknown tier scheme {scheme!r}")


def tier_rank(tier: ColLike) -> Column:
    """Position of a scorecard tier in baixo < medio < alto < critico (0-based)."""
    t = col(tier)
    return F.when(t == "baixo", 0).when(t == "medio", 1).when(t == "alto", 2).when(t == "critico", 3)


def direction(v: ColLike, style: str = "updown") -> Column:
    """sign of a contribution.

    ``updown``: up when >= 0 else down. ``risk``: aumenta_risco / reduz_risco /
    neutro (exact zero).
    """
    v = dbl(v)
    if style == "updown":
        return F.when(v >= 0, "up").otherwise("down")
    return F.when(v > 0, "aumenta_risco").when(v < 0, "reduz_risco").otherwise("neutro")


def with_derived_features(df, ratio_decimals: int | None = None):
    """Add the five derived features (pipeline form; ``ratio_decimals`` = 3 gives
    the scorecard form, which also rounds delta to 3 decimals)."""
    ratio = ratio_freq()
    delta = delta_freq()
    if ratio_decimals is not None:
        ratio = fixed(ratio, ratio_decimals)
        delta = fixed(delta, ratio_decimals)
    return df.withColumns({
        "ratio_freq_atual_vs_lifetime": ratio,
        "delta_freq": delta,
        "flag_early_user": flag_early_user(),
        "flag_sleeping_dog": flag_sleeping_dog(),
        "contract_x_lifetime": contract_x_lifetime(),
    })
