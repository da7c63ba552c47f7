"""Exploratory aggregates (A1-A30, W1, O2) over a member DataFrame.

Design rules (SURVEY §4): many statistics in one pass (conditional aggregates
then ``stack``), ``GROUPING SETS`` for per-flag rates, aggregate first and
window only over the small aggregated result, never over raw rows.
Every global aggregate is partial on the executors, final on one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schema as S
from ..functions.core import dbl, fixed

# ---------------------------------------------------------------------------
# Labels and bins used by the reference read models.
# ---------------------------------------------------------------------------
CONTRACT_LABELS = {1: "Mensal", 6: "Semestral", 12: "Anual"}
# (lo, hi] bins with labels; app scheme and legacy scheme (first bin closed).
COHORTS_APP = [(-1, 2, "0-2m"), (2, 5, "3-5m"), (5, 8, "6-8m"), (8, 12, "9-12m"), (12, 1e9, "12m+")]
COHORTS_LEGACY = [(-1, 1, "0-1 mês"), (1, 3, "2-3 meses"), (3, 6, "4-6 meses"), (6, 12, "7-12 meses"),
                  (12, float("inf"), "13+ meses")]
COHORTS_NOTEBOOK = [(-0.1, 1, "0-1"), (1, 3, "2-3"), (3, 6, "4-6"), (6, 12, "7-12"), (12, float("inf"), "12+")]
FREQ_BUCKETS = [(-1, 0.0001, "0"), (0.0001, 1, "0-1"), (1, 2, "1-2"), (2, 3, "2-3"), (3, 1e9, "3+")]
CORR_COLUMNS = [("Lifetime", "Lifetime"), ("Avg_class_frequency_current_month", "Freq_atual"),
                ("Contract_period", "Contrato"), ("Avg_additional_charges_total", "Adicionais"),
                ("Age", "Idade"), ("Churn", "Churn")]
BINARY_FLAGS = ["Group_visits", "Promo_friends", "Partner", "Near_Location"]
COMPARE_FEATURES = ["Lifetime", "Avg_class_frequency_current_month", "Age", "Contract_period",
                    "Month_to_end_contract", "Avg_class_frequency_total", "Avg_additional_charges_total"]
COMPARE_LABELS = {
    "Age": "Idade média",
    "Lifetime": "Tempo médio como cliente",
    "Avg_class_frequency_current_month": "Freq. média no mês",
    "Avg_class_frequency_total": "Freq. média histórica",
    "Avg_additional_charges_total": "Gastos extras médios",
}
BOX_FEATURES = ["Lifetime", "Avg_class_frequency_current_month", "Contract_period", "Avg_additional_charges_total"]
TARGET_CORR_FEATURES = S.LEGACY_FEATURES + ["ratio_freq_atual_vs_lifetime", "flag_early_user", "flag_sleeping_dog"]
DIAGNOSTIC_SEGMENTS = [
    ("early_droppers", "Early droppers", "% do churn total", "Onboarding intensivo nos primeiros 30 dias."),
    ("sleeping_dogs", "Sleeping dogs", "% da base total", "Reativação cuidadosa para evitar contato excessivo."),
    ("annual_zero_usage", "Anuais com uso zero", "% da base total", "Monitorar vencimento e criar oferta de retomada."),
]
ACTION_SEGMENTS = ["Usuários novos", "Sleeping dogs", "Contrato curto", "Baixa frequência atual",
                   "Sem visitas em grupo"]
SEGMENT_REVENUE_PER_MONTH = 150
RETENTION_MONTHS = 13


def _n() -> Column:
    return F.count(F.lit(1))


def r(c: Column, d: int = 6) -> Column:
    """Output rounding (F10) for order-dependent double aggregates."""
    return fixed(c, d)


# A1 -------------------------------------------------------------------------
def validation_report(df: DataFrame, target: str = S.TARGET, fingerprint: str | None = None) -> DataFrame:
    """A1: rows, columns, nulls and churn rate, and the fingerprint (S3) of the data that the report is about."""
    nulls = sum((F.sum(F.col(c).isNull().cast("bigint")) for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(_n().alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  nulls.alias("total_nulls"),
                  (F.sum(dbl(target)) / _n()).alias("churn_rate"), F.lit(fingerprint).cast("string").alias("fingerprint"))


# A3 -------------------------------------------------------------------------
def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max.
    Moments in one aggregation; quartiles of all columns in one set of exact
    quantile passes (bounded memory per task, see operators.quantiles)."""
    from .quantiles import quantiles_long
    cols = cols or [c for c, t in df.dtypes if t in ("int", "bigint", "double")]
    aggs = []
    for c in cols:
        x = dbl(c)
        aggs += [F.count(x).alias(f"{c}__count"), r(F.avg(x)).alias(f"{c}__mean"),
                 r(F.stddev_samp(x)).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    moments = wide.selectExpr(f"stack({len(cols)}, {parts}) AS (feature, count, mean, std, min, max)")
    q = quantiles_long(df, cols, [0.25, 0.5, 0.75]).groupBy("feature").agg(
        *[r(F.max(F.when(F.col("q_idx") == i, F.col("quantile")))).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    return moments.join(q, "feature", "left").select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


# A5 -------------------------------------------------------------------------
def kpi_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        _n().alias("customers"),
        fixed(F.sum(dbl("Churn")) / _n(), 4).alias("churn_rate"),
        fixed(F.avg(dbl("Age")), 1).alias("avg_age"),
        fixed(F.avg(dbl("Lifetime")), 1).alias("avg_lifetime"),
        fixed(F.avg("Avg_class_frequency_current_month"), 2).alias("avg_frequency_month"),
        fixed(F.avg("Avg_additional_charges_total"), 2).alias("avg_extra_charges"),
    )


# A6 -------------------------------------------------------------------------
def value_distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """count and share per value of several columns in one shuffle: each row
    emits one (column, value) pair per column; the share divides by the
    per-column total over the small result."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label"))
                                for c in cols]))
    counted = df.select(pairs.alias("p")).groupBy("p.column", "p.label").agg(_n().alias("count"))
    w = Window.partitionBy("column")
    return counted.select("column", "label", "count",
                          fixed(F.col("count") / F.sum("count").over(w), 4).alias("percentage"))


# A7 -------------------------------------------------------------------------
def churn_by_contract(df: DataFrame) -> DataFrame:
    lab = F.create_map(*[x for k, v in CONTRACT_LABELS.items() for x in (F.lit(k), F.lit(v))])
    g = df.groupBy("Contract_period").agg(_n().alias("total"), F.sum("Churn").cast("bigint").alias("churn"))
    return g.select(F.col("Contract_period").alias("contract"),
                    F.coalesce(lab[F.col("Contract_period")],
                               F.concat(F.col("Contract_period").cast("string"), F.lit("m"))).alias("label"),
                    "total", "churn", fixed(F.col("churn") / F.col("total"), 3).alias("churn_rate"))


# J6 + A8 --------------------------------------------------------------------
def assign_bins(x: Column, bins, closed_first: bool = False) -> Column:
    """Value to the label of its half-open (lo, hi] bin (a CASE chain; the
    bin table is tiny and fixed). ``closed_first`` includes the lowest edge."""
    e = None
    for i, (lo, hi, lab) in enumerate(bins):
        lo_ok = (x >= lo) if (closed_first and i == 0) else (x > lo)
        cond = lo_ok & (x <= hi) if hi != float("inf") else lo_ok
        e = F.when(cond, lab) if e is None else e.when(cond, lab)
    return e


#: scheme -> (bins, first bin closed, empty cohorts kept, decimals of the rate)
COHORT_SCHEMES = {"app": (COHORTS_APP, False, False, 3), "legacy": (COHORTS_LEGACY, True, True, 4), "notebook": (COHORTS_NOTEBOOK, False, False, 6)}


def churn_by_cohort(df: DataFrame, scheme: str = "app", bins=None) -> DataFrame:
    """Members, churned and churn rate per cohort of lifetimes, with bin order ``ord``; a row each. ``app`` and
    ``notebook``: empty cohorts dropped; ``legacy``: first bin closed, every cohort kept (rate 0, count 0 when empty).
    ``bins``: other (lo, hi] bins with labels instead of the scheme's."""
    own, closed, keep_empty, decimals = COHORT_SCHEMES[scheme]
    bins = bins or own
    x = dbl("Lifetime")
    g = (df.select(assign_bins(x, bins, closed_first=closed).alias("cohort"), "Churn")
         .groupBy("cohort").agg(_n().alias("total"), F.sum("Churn").cast("bigint").alias("churn")))
    labels = df.sparkSession.createDataFrame([(i, lab) for i, (_, _, lab) in enumerate(bins)], "ord int, cohort string")
    if not keep_empty:
        return labels.join(g, "cohort", "inner").select(
            "ord", "cohort", "total", "churn", fixed(F.col("churn") / F.col("total"), decimals).alias("churn_rate"))
    return labels.join(F.broadcast(g), "cohort", "left").select(
        "ord", "cohort", F.coalesce("total", F.lit(0)).cast("bigint").alias("count"),
        F.coalesce(fixed(F.col("churn") / F.col("total"), decimals), F.lit(0.0)).alias("churn_rate"))


# A9 -------------------------------------------------------------------------
def frequency_distribution(df: DataFrame) -> DataFrame:
    """Current-frequency buckets by churned / retained, all buckets kept.
    One pass of conditional sums, then stack."""
    x = dbl("Avg_class_frequency_current_month")
    aggs = []
    for i, (lo, hi, _) in enumerate(FREQ_BUCKETS):
        inb = (x > lo) & (x <= hi)
        aggs += [F.count_if(inb & (F.col("Churn") == 1)).alias(f"c{i}"),
                 F.count_if(inb & (F.col("Churn") == 0)).alias(f"r{i}")]
    parts = ", ".join(f"{i}, '{lab}', c{i}, r{i}" for i, (_, _, lab) in enumerate(FREQ_BUCKETS))
    return df.agg(*aggs).selectExpr(f"stack({len(FREQ_BUCKETS)}, {parts}) AS (ord, bucket, churn, retained)")


# A10 ------------------------------------------------------------------------
def churn_by_binary(df: DataFrame, flags: list[str] = BINARY_FLAGS) -> DataFrame:
    """Churn rate per value of each flag in ONE aggregation (GROUPING SETS)."""
    sets = ", ".join(f"({f})" for f in flags)
    gid = "CASE " + " ".join(
        f"WHEN grouping({f}) = 0 THEN '{f}'" for f in flags) + " END"
    val = "COALESCE(" + ", ".join(f"CASE WHEN grouping({f}) = 0 THEN {f} END" for f in flags) + ")"
    return df.sparkSession.sql(
        f"SELECT {gid} AS feature, {val} AS value, COUNT(*) AS n, CAST(SUM(Churn) AS BIGINT) AS churned, "
        f"SUM(CAST(Churn AS DOUBLE)) / COUNT(*) AS churn_rate "
        f"FROM {{members}} GROUP BY GROUPING SETS ({sets})", members=df)


def churn_by_binary_df(df: DataFrame, flags: list[str] = BINARY_FLAGS) -> DataFrame:
    """Same as :func:`churn_by_binary` expressed with the DataFrame API: one
    exploded (feature, value) pair per flag, one shuffle."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in flags]))
    return (df.select(pairs.alias("p"), "Churn").groupBy("p.feature", "p.value")
            .agg(_n().alias("n"), F.sum("Churn").cast("bigint").alias("churned"),
                 (F.sum(dbl("Churn")) / _n()).alias("churn_rate")))


# A11 ------------------------------------------------------------------------
def compare_by_churn(df: DataFrame, features: list[str] = COMPARE_FEATURES) -> DataFrame:
    """Mean per class side by side (stayed = Churn 0, churned = Churn 1)."""
    aggs = []
    for f in features:
        aggs += [r(F.avg(F.when(F.col("Churn") == 0, dbl(f))), 2).alias(f"s_{f}"),
                 r(F.avg(F.when(F.col("Churn") == 1, dbl(f))), 2).alias(f"c_{f}")]
    parts = ", ".join(f"'{f}', '{COMPARE_LABELS.get(f, f)}', `s_{f}`, `c_{f}`" for f in features)
    return df.agg(*aggs).selectExpr(f"stack({len(features)}, {parts}) AS (feature, label, stayed, churned)")


# A12 ------------------------------------------------------------------------
def derived_means_by_churn(df: DataFrame) -> DataFrame:
    """Mean of the derived features per class (input already has them)."""
    return df.groupBy("Churn").agg(
        r(F.avg("ratio_freq_atual_vs_lifetime"), 3).alias("ratio_freq_atual_vs_lifetime"),
        r(F.avg(dbl("flag_early_user")), 3).alias("flag_early_user"),
        r(F.avg(dbl("flag_sleeping_dog")), 3).alias("flag_sleeping_dog"))


# A13 ------------------------------------------------------------------------
def box_stats_by_churn(df: DataFrame, features: list[str] = BOX_FEATURES) -> DataFrame:
    """min, q1, median, q3, max per class and feature: pairs exploded once;
    min / max in one grouped aggregation, quartiles by exact quantile passes
    keyed by (class, feature)."""
    from .quantiles import quantiles_long
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), dbl(f).alias("v")) for f in features]))
    mm = (df.select("Churn", pairs.alias("p")).groupBy("Churn", "p.feature")
          .agg(F.min("p.v").alias("min"), F.max("p.v").alias("max")))
    q = quantiles_long(df, features, [0.25, 0.5, 0.75], by=["Churn"], by_groups=2).groupBy("Churn", "feature").agg(
        *[r(F.max(F.when(F.col("q_idx") == i, F.col("quantile")))).alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    return mm.join(q, ["Churn", "feature"], "left").select("Churn", "feature", "min", "q1", "median", "q3", "max")


# A14 ------------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols=CORR_COLUMNS, decimals: int = 2) -> DataFrame:
    """Pearson matrix in long form (x, y, value): every pair a<b in ONE
    aggregation, the diagonal is 1, the lower half mirrors the upper."""
    names = [c for c, _ in cols]
    aggs = [F.corr(dbl(a), dbl(b)).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    wide = df.agg(*aggs)
    rows = []
    for i, (_, yl) in enumerate(cols):
        for j, (_, xl) in enumerate(cols):
            v = "1.0D" if i == j else f"`{min(i, j)}_{max(i, j)}`"
            rows.append(f"'{xl}', '{yl}', {v}")
    out = wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (x, y, value)")
    return out.select("x", "y", fixed("value", decimals).alias("value"))


# A15 / O2 -------------------------------------------------------------------
def target_correlation(df: DataFrame, features: list[str] = TARGET_CORR_FEATURES, target: str = S.TARGET,
                       top: int | None = None) -> DataFrame:
    """Each feature against the target, ordered by |r| (ties by name), with
    percent strength and direction text. ``top`` keeps the head (O2). The
    window runs over one row per feature, never over member rows."""
    wide = df.agg(*[F.corr(dbl(f), dbl(target)).alias(f) for f in features])
    parts = ", ".join(f"'{f}', `{f}`" for f in features)
    long = wide.selectExpr(f"stack({len(features)}, {parts}) AS (feature, correlation)")
    w = Window.orderBy(F.abs("correlation").desc(), "feature")
    out = long.select(
        F.row_number().over(w).alias("rank"), "feature",
        fixed("correlation", 4).alias("correlation"),
        fixed(F.abs("correlation"), 4).alias("strength"),
        fixed(F.abs("correlation") * 100, 1).alias("strength_pct"),
        F.when(F.col("correlation") >= 0, "associado a mais churn").otherwise("associado a menos churn")
        .alias("direction"))
    return out.filter(F.col("rank") <= top) if top else out


# A16 ------------------------------------------------------------------------
def diagnostic_segments(df: DataFrame) -> DataFrame:
    life, cur = F.col("Lifetime"), dbl("Avg_class_frequency_current_month")
    a = df.agg(
        F.count_if((life <= 1) & (F.col("Churn") == 1)).alias("early"),
        F.count_if((life > 6) & (cur < 0.5)).alias("dogs"),
        F.count_if((F.col("Contract_period") == 12) & (cur == 0)).alias("annual"),
        F.greatest(F.count_if(F.col("Churn") == 1), F.lit(1)).alias("tot_churn"),
        F.greatest(_n(), F.lit(1)).alias("tot_base"))
    (k1, l1, ref1, act1), (k2, l2, ref2, act2), (k3, l3, ref3, act3) = DIAGNOSTIC_SEGMENTS
    est = SEGMENT_REVENUE_PER_MONTH * 12
    return a.selectExpr(
        f"stack(3, '{k1}', '{l1}', early, early / tot_churn, '{ref1}', '{act1}', CAST(NULL AS BIGINT), "
        f"'{k2}', '{l2}', dogs, dogs / tot_base, '{ref2}', '{act2}', CAST(NULL AS BIGINT), "
        f"'{k3}', '{l3}', annual, annual / tot_base, '{ref3}', '{act3}', annual * {est}) "
        "AS (key, label, count, share, reference, action, estimated_pipeline)"
    ).select("key", "label", "count", fixed("share", 4).alias("percentage"), "reference", "action",
             "estimated_pipeline")


# A17 ------------------------------------------------------------------------
def action_segments(df: DataFrame, dog_lifetime_min: int = 6, dog_freq_max: float = 1.0,
                    dog_inclusive: bool = True) -> DataFrame:
    """n and churn rate per overlapping segment, one pass of conditional
    aggregates. The sleeping-dog cut is a parameter (this read model uses
    lifetime >= 6 and frequency < 1 by default)."""
    life, cur = F.col("Lifetime"), dbl("Avg_class_frequency_current_month")
    dog = ((life >= dog_lifetime_min) if dog_inclusive else (life > dog_lifetime_min)) & (cur < dog_freq_max)
    conds = [life <= 1, dog, F.col("Contract_period") <= 1, cur < 1, F.col("Group_visits") == 0]
    aggs = []
    for i, c in enumerate(conds):
        aggs += [F.count_if(c).alias(f"n{i}"), F.sum(F.when(c, F.col("Churn"))).cast("bigint").alias(f"c{i}")]
    parts = ", ".join(f"'{s}', n{i}, c{i}" for i, s in enumerate(ACTION_SEGMENTS))
    long = df.agg(*aggs).selectExpr(f"stack({len(conds)}, {parts}) AS (segment, members, churned)")
    return long.select("segment", "members",
                       F.coalesce(fixed(F.col("churned") / F.col("members"), 3), F.lit(0.0)).alias("churn_rate"))


def early_and_idle_segments(df: DataFrame) -> DataFrame:
    """A17's other three rules: early droppers, sleeping dogs (both by their flags) and annual contracts (12 months or
    more) with a current frequency below 0.1; members and churn rate (4 decimals), no rate where nobody is."""
    life, cur = F.col("Lifetime"), dbl("Avg_class_frequency_current_month")
    conds = {"early_droppers": life <= 1, "sleeping_dogs": (life > 6) & (cur < 0.5), "anuais_uso_zero": (F.col("Contract_period") >= 12) & (cur < 0.1)}
    aggs = []
    for i, c in enumerate(conds.values()):
        aggs += [F.count_if(c).alias(f"n{i}"), F.sum(F.when(c, F.col("Churn"))).cast("bigint").alias(f"c{i}")]
    parts = ", ".join(f"'{s}', n{i}, c{i}" for i, s in enumerate(conds))
    long = df.agg(*aggs).selectExpr(f"stack({len(conds)}, {parts}) AS (segment, members, churned)")
    return long.select("segment", "members", F.when(F.col("members") > 0, fixed(F.col("churned") / F.col("members"), 4)).alias("churn_rate"))


# A18 + J8 -------------------------------------------------------------------
def retention_by_lifetime(df: DataFrame, months: int = RETENTION_MONTHS) -> DataFrame:
    """Share retained among members with lifetime = m for m in 0..12; null
    where nobody has that lifetime (densified with a range left join)."""
    g = df.filter((F.col("Lifetime") >= 0) & (F.col("Lifetime") < months)).groupBy("Lifetime").agg(_n().alias("n"), F.count_if(F.col("Churn") == 0).alias("kept"))
    grid = df.sparkSession.range(months).select(F.col("id").cast("int").alias("_m"))
    return grid.join(g, grid._m == g.Lifetime, "left").select(
        F.col("_m").alias("lifetime"), fixed(F.col("kept") / F.col("n"), 3).alias("retention"))


# A19 ------------------------------------------------------------------------
def category_split(scored: DataFrame, column: str, categories: list[str], out: str) -> DataFrame:
    """Counts per category, zero categories kept (J8 on a literal table)."""
    g = scored.groupBy(F.col(column).alias("_k")).agg(_n().alias("count"))
    cats = scored.sparkSession.createDataFrame([(i, c) for i, c in enumerate(categories)], f"ord int, {out} string")
    return cats.join(g, cats[out] == g["_k"], "left").select(
        "ord", out, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


# A20 / A30 ------------------------------------------------------------------
def score_facts(scored: DataFrame) -> DataFrame:
    """Mean 5-decimal score and observed base rate over labelled members."""
    lab = F.col("Churn").isin(0, 1)
    return scored.agg(
        _n().alias("n"),
        fixed(F.sum("p5").cast("double") / _n() / F.lit(100000.0), 4).alias("avg_score"),
        F.count_if(lab).alias("n_labeled"),
        F.coalesce(F.sum(F.when(lab, dbl("Churn"))) / F.count_if(lab), F.lit(0.0)).alias("base_rate"))


# A21 ------------------------------------------------------------------------
def future_variable_check(df: DataFrame) -> DataFrame:
    """Per contract: mean / max months-to-end, n, churn rate; plus one
    whole-table row (contract null) with the correlations of months-to-end
    with contract and lifetime."""
    mte = dbl("Month_to_end_contract")
    per = df.groupBy("Contract_period").agg(r(F.avg(mte), 3).alias("mte_mean"), F.max(mte).alias("mte_max"),
                                            _n().alias("n"), fixed(F.sum(dbl("Churn")) / _n(), 3).alias("churn"))
    glob = df.agg(_n().alias("n"), fixed(F.corr(mte, dbl("Contract_period")), 4).alias("corr_mte_contract"),
                  fixed(F.corr(mte, dbl("Lifetime")), 4).alias("corr_mte_lifetime"))
    return per.unionByName(glob, allowMissingColumns=True)


# A24 ------------------------------------------------------------------------
def risk_band_rollup(scored: DataFrame, p: str = "p_raw") -> DataFrame:
    """Legacy right-closed bands: count, churn rate, mean probability; empty
    bands are absent (they have no group)."""
    from ..functions.core import risk_tier
    return (scored.withColumn("band", risk_tier(p, "legacy_bands")).filter(F.col("band").isNotNull())
            .groupBy("band").agg(_n().alias("count"), fixed(F.sum(dbl("Churn")) / _n(), 4).alias("churn_rate"),
                                 r(F.avg(p), 4).alias("avg_probability")))


# A26 ------------------------------------------------------------------------
def feature_defaults(df: DataFrame, numeric: list[str] | None = None, flags: list[str] | None = None) -> DataFrame:
    """Median per numeric feature (exact, bounded memory), smallest mode per
    flag (a two-value count map), long form."""
    from .quantiles import quantiles_long
    numeric = numeric or S.LEGACY_NUMERIC
    flags = flags or S.LEGACY_BINARY
    med = quantiles_long(df, numeric, [0.5]).select("feature", F.lit("median").alias("stat"),
                                                    r(F.col("quantile")).alias("value"))
    parts = ", ".join(f"'{c}', 'mode', `{c}`" for c in flags)
    modes = df.agg(*[F.mode(dbl(c), True).alias(c) for c in flags]).selectExpr(
        f"stack({len(flags)}, {parts}) AS (feature, stat, value)")
    return med.unionByName(modes.select("feature", "stat", r(F.col("value")).alias("value")))


# A27 / A28 ------------------------------------------------------------------
def eligibility_funnel(scored: DataFrame) -> DataFrame:
    """base, at risk (alto + critico), sleeping dogs among them removed, target."""
    at_risk = F.col("risk_tier").isin("alto", "critico")
    dog = F.col("archetype") == "sleeping_dog"
    a = scored.agg(_n().alias("base"), F.count_if(at_risk).alias("at_risk"),
                   F.count_if(at_risk & dog).alias("dogs_at_risk"), F.count_if(dog).alias("sleeping_dogs"))
    return a.select("base", "at_risk", "sleeping_dogs", "dogs_at_risk",
                    (F.col("at_risk") - F.col("dogs_at_risk")).alias("target"))


# W1 -------------------------------------------------------------------------
def kaplan_meier(df: DataFrame) -> DataFrame:
    """Per distinct lifetime t: at_risk = members with lifetime >= t, events,
    hazard and survival = running product of (1 - hazard).

    Aggregates to one row per distinct lifetime first (distributed), then
    windows over that small table only. The product is exp(sum(ln(1-h))),
    switched to 0 from the first t with hazard 1 (ln(0) would be skipped).
    """
    g = df.groupBy("Lifetime").agg(_n().alias("n"), F.count_if(F.col("Churn") == 1).alias("events"))
    desc = Window.orderBy(F.col("Lifetime").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asc = Window.orderBy("Lifetime").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = g.select("Lifetime", "events", F.sum("n").over(desc).alias("at_risk"))
    t = t.withColumn("hazard", F.col("events") / F.col("at_risk"))
    t = t.withColumn("_zero", F.max((F.col("hazard") >= 1).cast("int")).over(asc)).withColumn(
        "_lsum", F.sum(F.when(F.col("hazard") < 1, F.log(F.lit(1.0) - F.col("hazard"))).otherwise(0.0)).over(asc))
    return t.select(F.col("Lifetime").alias("lifetime"),
                    F.when(F.col("_zero") == 1, F.lit(0.0)).otherwise(fixed(F.exp("_lsum"), 4))
                    .alias("survival_probability"), "at_risk", "events")
