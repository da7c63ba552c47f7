"""Scorecards (H1-H3, H5) and their explanations.

H1 is the transparent weighted logit used as fallback score and as the
what-if engine. It is additive, so every contribution is one column
expression; the driver array is built with array/struct functions, never a
Python UDF, and no operator here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.core import col, dbl, direction, fixed, flag_early_user, flag_sleeping_dog, ratio_freq, risk_tier, \
    sigmoid

# Scorecard weights (feature, weight, actionable), in evaluation
# order, the ratio term last, then the intercept and the reference member.
SCORECARD_WEIGHTS = [
    ("Avg_class_frequency_current_month", -1.35, True),
    ("Contract_period", -0.11, True),
    ("Month_to_end_contract", -0.16, True),
    ("Lifetime", -0.08, False),
    ("Group_visits", -0.55, True),
    ("Avg_additional_charges_total", -0.0035, False),
    ("Promo_friends", -0.35, False),
    ("Partner", -0.30, False),
]
RATIO_WEIGHT = -0.9
INTERCEPT = 1.05
REFERENCE_MEMBER = {
    "gender": 1,
    "Near_Location": 1,
    "Partner": 1,
    "Promo_friends": 1,
    "Phone": 1,
    "Contract_period": 6,
    "Group_visits": 1,
    "Age": 29,
    "Avg_additional_charges_total": 150,
    "Month_to_end_contract": 5,
    "Lifetime": 5,
    "Avg_class_frequency_total": 2.0,
    "Avg_class_frequency_current_month": 1.9,
    "ratio_freq_atual_vs_lifetime": 0.95,
    "delta_freq": -0.1,
    "flag_early_user": 0,
    "flag_sleeping_dog": 0,
}
SCORECARD_FEATURES = [f for f, _, _ in SCORECARD_WEIGHTS] + ["ratio_freq_atual_vs_lifetime"]
SHORT = {
    "Avg_class_frequency_current_month": "freq_cur",
    "Contract_period": "contract",
    "Month_to_end_contract": "months_end",
    "Lifetime": "lifetime",
    "Group_visits": "group",
    "Avg_additional_charges_total": "charges",
    "Promo_friends": "promo",
    "Partner": "partner",
    "ratio_freq_atual_vs_lifetime": "ratio",
}


def scorecard_ratio(cur: Column | str = "Avg_class_frequency_current_month",
                    tot: Column | str = "Avg_class_frequency_total") -> Column:
    """Scorecard form of the ratio: rounded to 3 decimals."""
    return fixed(ratio_freq(cur, tot), 3)


def contribution_terms(values: dict[str, Column], rounded: bool = True) -> dict[str, Column]:
    """W * (x - ref) per scorecard feature; ``values`` maps feature to the
    column holding its (possibly overridden) value."""
    out = {}
    for f, w, _ in SCORECARD_WEIGHTS:
        t = F.lit(w) * (dbl(values[f]) - F.lit(float(REFERENCE_MEMBER[f])))
        out[f] = fixed(t, 4) if rounded else t
    r = F.lit(RATIO_WEIGHT) * (dbl(values["ratio_freq_atual_vs_lifetime"]) - F.lit(0.95))
    out["ratio_freq_atual_vs_lifetime"] = fixed(r, 4) if rounded else r
    return out


def scorecard_logit(terms: dict[str, Column]) -> Column:
    """Intercept + left-to-right sum of the terms (fixed order = same double
    in every engine)."""
    s = F.lit(0.0)
    for f in SCORECARD_FEATURES:
        s = s + terms[f]
    return F.lit(INTERCEPT) + s


def archetype_scorecard(sleeping: Column, early: Column, prob: Column, ratio: Column, contract: Column,
                        charges: Column) -> Column:
    """Ordered rules of the scorecard archetype."""
    return (F.when(sleeping == 1, "sleeping_dog")
            .when((early == 1) & (prob >= 0.4), "early_dropper")
            .when(F.coalesce(ratio, F.lit(1.0)) < 0.6, "desengajado_conteudo")
            .when((contract <= 1) & (dbl(charges) < 120), "preco_sensivel")
            .otherwise("concorrente_driven"))


def scorecard_prob_expr(values: dict[str, Column]) -> Column:
    """Unrounded scorecard probability for a dict of feature columns (what-if)."""
    return sigmoid(scorecard_logit(contribution_terms(values)))


def linear_scorecard(df: DataFrame, keep: list[str] | None = None, with_drivers: bool = True,
                     top_k: int = 6) -> DataFrame:
    """H1: score every member with the transparent scorecard.

    Output: key columns, ``p_raw`` (unrounded, drives tier/archetype),
    ``churn_probability`` (5 decimals), ``risk_tier`` (scheme scorecard),
    ``archetype`` (D2), ``proactive_allowed``, ``logit``, ``base_value`` and,
    if asked, ``contributions`` / ``top_drivers`` arrays (E1, E3, W7).
    """
    keep = keep if keep is not None else [c for c in ("customer_id",) if c in df.columns]
    ratio = scorecard_ratio()
    vals = {f: F.col(f) for f, _, _ in SCORECARD_WEIGHTS}
    vals["ratio_freq_atual_vs_lifetime"] = F.col("_ratio3")
    base = df.withColumns({
        "_ratio3": ratio,
        "_early": flag_early_user(),
        "_dog": flag_sleeping_dog(),
    })
    terms = contribution_terms(vals)
    raw_terms = contribution_terms(vals, rounded=False)
    with_terms = base.withColumns({f"c_{SHORT[f]}": terms[f] for f in SCORECARD_FEATURES})
    cterms = {f: F.col(f"c_{SHORT[f]}") for f in SCORECARD_FEATURES}
    scored = with_terms.withColumn("logit", scorecard_logit(cterms)).withColumn("p_raw", sigmoid("logit"))
    arche = archetype_scorecard(F.col("_dog"), F.col("_early"), F.col("p_raw"), F.col("_ratio3"),
                                F.col("Contract_period"), F.col("Avg_additional_charges_total"))
    out_cols = [F.col(c) for c in keep] + [
        F.col("p_raw"),
        F.floor(F.col("p_raw") * F.lit(100000.0) + F.lit(0.5)).alias("p5"),
        fixed("p_raw", 5).alias("churn_probability"),
        risk_tier("p_raw", "scorecard").alias("risk_tier"),
        arche.alias("archetype"),
        F.col("logit"),
        fixed(sigmoid(F.lit(INTERCEPT)), 5).alias("base_value"),
        F.col("_ratio3").alias("ratio_freq_atual_vs_lifetime"),
        F.col("_early").alias("flag_early_user"),
        F.col("_dog").alias("flag_sleeping_dog"),
    ] + [F.col(f"c_{SHORT[f]}") for f in SCORECARD_FEATURES]
    if with_drivers:
        structs = []
        for f, _, act in SCORECARD_WEIGHTS + [("ratio_freq_atual_vs_lifetime", RATIO_WEIGHT, True)]:
            v = F.col("_ratio3") if f == "ratio_freq_atual_vs_lifetime" else fixed(f, 2)
            structs.append(F.struct(
                F.lit(f).alias("feature"),
                F.col(f"c_{SHORT[f]}").alias("shap_value"),
                v.alias("value"),
                F.lit(act).alias("actionable"),
                direction(raw_terms[f] if f != "ratio_freq_atual_vs_lifetime" else raw_terms[f]).alias("direction"),
            ))
        out_cols.append(F.array(*structs).alias("contributions"))
    res = scored.select(*out_cols).withColumn("proactive_allowed", F.col("archetype") != "sleeping_dog")
    if with_drivers:
        res = res.withColumn("top_drivers", top_drivers("contributions", top_k))
    return res


def top_drivers(arr: Column | str, k: int) -> Column:
    """The k entries with the largest |shap_value|; ties keep input order
    (stable sort, like Array.prototype.sort). No shuffle: per-row array ops."""
    a = col(arr)
    indexed = F.transform(a, lambda x, i: F.struct(x.alias("d"), i.alias("i")))
    ordered = F.array_sort(indexed, lambda l, r: F.when(F.abs(l.d.shap_value) > F.abs(r.d.shap_value), -1)
                           .when(F.abs(l.d.shap_value) < F.abs(r.d.shap_value), 1)
                           .when(l.i < r.i, -1).when(l.i > r.i, 1).otherwise(0))
    return F.transform(F.slice(ordered, 1, k), lambda x: x.d)


def predicted_churn(p: Column | str, threshold: float = S.DEFAULT_THRESHOLD) -> Column:
    """H5: probability >= threshold."""
    return (dbl(p) >= F.lit(threshold)).cast("int")


def rule_scorecard(df: DataFrame) -> DataFrame:
    """H2: integer risk points and band (legacy business-rule baseline).

    A missing column takes the reference default; a null value compares false
    (as NaN does), so it adds no points.
    """
    def get(name, default):
        return F.col(name) if name in df.columns else F.lit(default)

    contract = get("Contract_period", 6)
    life = get("Lifetime", 4)
    cur = dbl(get("Avg_class_frequency_current_month", 2.0))
    tot = dbl(get("Avg_class_frequency_total", 2.0))
    months = dbl(get("Month_to_end_contract", 4.0))
    pts = (F.when(contract == 1, 3).when(contract == 6, 1).otherwise(0)
           + F.when(life <= 1, 3).when(life <= 3, 2).when(life <= 6, 1).otherwise(0)
           + F.when(cur == 0, 2).when((tot > 0) & (cur / F.when(tot > 0, tot) < 0.5), 2).otherwise(0)
           + F.when(months <= 1, 1).otherwise(0)
           - F.when(get("Group_visits", 0) == 1, 1).otherwise(0)
           - F.when(get("Promo_friends", 0) == 1, 1).otherwise(0)
           - F.when(get("Partner", 0) == 1, 1).otherwise(0)
           - F.when(get("Near_Location", 1) == 1, 1).otherwise(0))
    return df.withColumn("risk_points", pts.cast("int")).withColumn(
        "risk_label",
        F.when(F.col("risk_points") >= 5, "Alto Risco").when(F.col("risk_points") >= 3, "Risco Médio")
        .otherwise("Baixo Risco"))


def waterfall_rows(scored: DataFrame, key: str = "customer_id", arr: str = "contributions") -> DataFrame:
    """Long form of a member's drivers sorted by |value| descending, with
    step order, running total from the base logit and bar share of the largest
    |value|. Per-member window only (partitioned by key, bounded by 9 rows)."""
    from pyspark.sql.window import Window
    ordered = scored.select(key, "logit", top_drivers(arr, len(SCORECARD_FEATURES)).alias("_d"))
    long = ordered.select(key, "logit", F.posexplode("_d").alias("pos", "d")).select(
        key, (F.col("pos") + 1).alias("step"), F.col("d.feature").alias("feature"),
        F.col("d.shap_value").alias("contribution"), F.col("logit"))
    w = Window.partitionBy(key).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(key)
    return long.select(
        key, "step", "feature", "contribution",
        (F.lit(INTERCEPT) + F.sum("contribution").over(w)).alias("running_logit"),
        safe_share(F.abs("contribution"), F.max(F.abs("contribution")).over(wall)).alias("bar_share"),
    )


def safe_share(a: Column, b: Column) -> Column:
    from ..functions.core import safe_divide
    return safe_divide(a, b)
