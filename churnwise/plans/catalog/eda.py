"""Registered EDA queries (A1-A30, W1, O2) with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schema as S
from ...functions.core import with_derived_features
from ...operators import eda, profile
from ...sources.members import member_snapshot, read_table, table_fingerprint
from ..oracle_sql import fx, sdiv, with_members
from ..registry import register
from .core import scored_members

M_COLS = ["customer_id"] + S.RAW_FEATURES + [S.TARGET]
_TYPES = {"customer_id": "bigint", **{f.name: f.dataType.simpleString() for f in S.MEMBER.fields}}
DERIVED_SQL = (f"SELECT m.*, {sdiv('Avg_class_frequency_current_month', 'Avg_class_frequency_total')} "
               "AS ratio_freq_atual_vs_lifetime, CAST(Lifetime <= 1 AS INTEGER) AS flag_early_user, "
               "CAST(Lifetime > 6 AND Avg_class_frequency_current_month < 0.5 AS INTEGER) AS flag_sleeping_dog "
               "FROM members m")


def _members(spark, sf_dir):
    return member_snapshot(spark, sf_dir)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# A1
#: Columns of the members that are whole numbers: their text is the same in every engine.
_WHOLE = [c for c in M_COLS if _TYPES[c] != "double"]
_ROW_SQL = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in _WHOLE)


@register("a1_validation_report", with_members(
    "SELECT COUNT(*) AS n_rows, 15 AS n_columns, CAST(("
    + " + ".join(f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in M_COLS)
    + ") AS BIGINT) AS total_nulls, SUM(CAST(Churn AS DOUBLE)) / COUNT(*) AS churn_rate, "
    f"CAST(SUM(CAST(('0x' || SUBSTRING(md5({_ROW_SQL}), 1, 15)) AS BIGINT)) AS VARCHAR) AS fingerprint FROM members"))
def q_validation_report(spark, sf_dir):
    """The report carries the order-insensitive digest of the members' whole-number columns."""
    m = _members(spark, sf_dir)
    digest = table_fingerprint(m.select(*_WHOLE)).first().digest  # one row
    return eda.validation_report(m, fingerprint=digest)


# A2
@register("a2_column_profile", with_members(_union([
    f"SELECT '{c}' AS column, '{_TYPES[c]}' AS dtype, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS nulls, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values FROM members" for c in M_COLS])))
def q_column_profile(spark, sf_dir):
    return profile.column_profile(_members(spark, sf_dir))


# A3
_DESC = S.RAW_FEATURES + [S.TARGET]


@register("a3_describe", with_members(_union([
    f"SELECT '{c}' AS feature, COUNT({c}) AS count, {fx(f'AVG(CAST({c} AS DOUBLE))', 6)} AS mean, "
    f"{fx(f'STDDEV_SAMP(CAST({c} AS DOUBLE))', 6)} AS std, MIN(CAST({c} AS DOUBLE)) AS min, "
    f"{fx(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25)', 6)} AS q25, "
    f"{fx(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5)', 6)} AS q50, "
    f"{fx(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75)', 6)} AS q75, MAX(CAST({c} AS DOUBLE)) AS max FROM members"
    for c in _DESC])))
def q_describe(spark, sf_dir):
    return eda.describe(_members(spark, sf_dir), _DESC)


# A4
_LEG = ", ".join(S.LEGACY_FEATURES + [S.TARGET])


@register("a4_duplicate_count", with_members(
    f"SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT {_LEG} FROM members) d) AS distinct_rows, "
    f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {_LEG} FROM members) d) AS duplicates FROM members"))
def q_duplicate_count(spark, sf_dir):
    return profile.duplicate_count(_members(spark, sf_dir).select(*S.LEGACY_FEATURES, S.TARGET))


# A5
@register("a5_kpi_summary", with_members(
    f"SELECT COUNT(*) AS customers, {fx('SUM(CAST(Churn AS DOUBLE)) / COUNT(*)', 4)} AS churn_rate, "
    f"{fx('AVG(CAST(Age AS DOUBLE))', 1)} AS avg_age, {fx('AVG(CAST(Lifetime AS DOUBLE))', 1)} AS avg_lifetime, "
    f"{fx('AVG(Avg_class_frequency_current_month)', 2)} AS avg_frequency_month, "
    f"{fx('AVG(Avg_additional_charges_total)', 2)} AS avg_extra_charges FROM members"))
def q_kpi_summary(spark, sf_dir):
    return eda.kpi_summary(_members(spark, sf_dir))


# A6
_DIST = ["Churn", "Contract_period", "Group_visits"]


@register("a6_value_distribution", with_members(_union([
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS label, COUNT(*) AS count, "
    f"{fx(f'COUNT(*) / (SELECT COUNT(*) FROM members)', 4)} AS percentage FROM members GROUP BY {c}"
    for c in _DIST])))
def q_value_distribution(spark, sf_dir):
    return eda.value_distribution(_members(spark, sf_dir), _DIST)


# A7
@register("a7_churn_by_contract", with_members(
    "SELECT Contract_period AS contract, CASE Contract_period WHEN 1 THEN 'Mensal' WHEN 6 THEN 'Semestral' "
    "WHEN 12 THEN 'Anual' ELSE CAST(Contract_period AS VARCHAR) || 'm' END AS label, COUNT(*) AS total, "
    f"CAST(SUM(Churn) AS BIGINT) AS churn, {fx('SUM(Churn) / COUNT(*)', 3)} AS churn_rate "
    "FROM members GROUP BY Contract_period"))
def q_churn_by_contract(spark, sf_dir):
    return eda.churn_by_contract(_members(spark, sf_dir))


# A8
@register("a8_churn_by_cohort_app", with_members(
    "SELECT ord, cohort, COUNT(*) AS total, CAST(SUM(Churn) AS BIGINT) AS churn, "
    f"{fx('SUM(Churn) / COUNT(*)', 3)} AS churn_rate FROM ("
    "SELECT CASE WHEN Lifetime > -1 AND Lifetime <= 2 THEN 0 WHEN Lifetime > 2 AND Lifetime <= 5 THEN 1 "
    "WHEN Lifetime > 5 AND Lifetime <= 8 THEN 2 WHEN Lifetime > 8 AND Lifetime <= 12 THEN 3 "
    "WHEN Lifetime > 12 AND Lifetime <= 1e9 THEN 4 END AS ord, "
    "CASE WHEN Lifetime > -1 AND Lifetime <= 2 THEN '0-2m' WHEN Lifetime > 2 AND Lifetime <= 5 THEN '3-5m' "
    "WHEN Lifetime > 5 AND Lifetime <= 8 THEN '6-8m' WHEN Lifetime > 8 AND Lifetime <= 12 THEN '9-12m' "
    "WHEN Lifetime > 12 AND Lifetime <= 1e9 THEN '12m+' END AS cohort, Churn FROM members) "
    "WHERE cohort IS NOT NULL GROUP BY ord, cohort"))
def q_churn_by_cohort_app(spark, sf_dir):
    return eda.churn_by_cohort(_members(spark, sf_dir), "app")


@register("a8_churn_by_cohort_legacy", with_members(
    "SELECT b.ord, b.cohort, COUNT(m.Churn) AS count, "
    f"COALESCE({fx('SUM(m.Churn) / COUNT(m.Churn)', 4)}, 0.0) AS churn_rate "
    "FROM (VALUES (0, '0-1 mês', -1, 1), (1, '2-3 meses', 1, 3), (2, '4-6 meses', 3, 6), (3, '7-12 meses', 6, 12), "
    "(4, '13+ meses', 12, NULL)) b(ord, cohort, lo, hi) "
    "LEFT JOIN members m ON (m.Lifetime > b.lo OR (b.ord = 0 AND m.Lifetime >= b.lo)) "
    "AND (b.hi IS NULL OR m.Lifetime <= b.hi) GROUP BY b.ord, b.cohort"))
def q_churn_by_cohort_legacy(spark, sf_dir):
    return eda.churn_by_cohort(_members(spark, sf_dir), "legacy")


@register("a8_churn_by_cohort_notebook", with_members(
    "SELECT b.ord, b.cohort, COUNT(*) AS total, CAST(SUM(m.Churn) AS BIGINT) AS churn, "
    f"{fx('SUM(m.Churn) / COUNT(*)', 6)} AS churn_rate "
    "FROM (VALUES (0, '0-1', -0.1, 1.0), (1, '2-3', 1.0, 3.0), (2, '4-6', 3.0, 6.0), (3, '7-12', 6.0, 12.0), (4, '12+', 12.0, 1e300)) b(ord, cohort, lo, hi) "
    "JOIN members m ON m.Lifetime > b.lo AND m.Lifetime <= b.hi GROUP BY b.ord, b.cohort"))
def q_churn_by_cohort_notebook(spark, sf_dir):
    return eda.churn_by_cohort(_members(spark, sf_dir), "notebook")


# A9
@register("a9_frequency_distribution", with_members(
    "SELECT b.ord, b.bucket, COUNT(*) FILTER (WHERE m.Churn = 1) AS churn, "
    "COUNT(*) FILTER (WHERE m.Churn = 0) AS retained "
    "FROM (VALUES (0, '0', -1.0, 0.0001), (1, '0-1', 0.0001, 1.0), (2, '1-2', 1.0, 2.0), (3, '2-3', 2.0, 3.0), "
    "(4, '3+', 3.0, 1e9)) b(ord, bucket, lo, hi) LEFT JOIN members m "
    "ON m.Avg_class_frequency_current_month > b.lo AND m.Avg_class_frequency_current_month <= b.hi "
    "GROUP BY b.ord, b.bucket"))
def q_frequency_distribution(spark, sf_dir):
    return eda.frequency_distribution(_members(spark, sf_dir))


# A10
@register("a10_churn_by_binary", with_members(_union([
    f"SELECT '{f}' AS feature, {f} AS value, COUNT(*) AS n, CAST(SUM(Churn) AS BIGINT) AS churned, "
    f"SUM(CAST(Churn AS DOUBLE)) / COUNT(*) AS churn_rate FROM members GROUP BY {f}" for f in eda.BINARY_FLAGS])))
def q_churn_by_binary(spark, sf_dir):
    return eda.churn_by_binary(_members(spark, sf_dir))


# A11
@register("a11_compare_by_churn", with_members(_union([
    f"SELECT '{f}' AS feature, '{eda.COMPARE_LABELS.get(f, f)}' AS label, "
    f"{fx(f'AVG(CASE WHEN Churn = 0 THEN CAST({f} AS DOUBLE) END)', 2)} AS stayed, "
    f"{fx(f'AVG(CASE WHEN Churn = 1 THEN CAST({f} AS DOUBLE) END)', 2)} AS churned FROM members"
    for f in eda.COMPARE_FEATURES])))
def q_compare_by_churn(spark, sf_dir):
    return eda.compare_by_churn(_members(spark, sf_dir))


# A12
@register("a12_derived_means_by_churn", with_members(
    f"SELECT Churn, {fx('AVG(ratio_freq_atual_vs_lifetime)', 3)} AS ratio_freq_atual_vs_lifetime, "
    f"{fx('AVG(CAST(flag_early_user AS DOUBLE))', 3)} AS flag_early_user, "
    f"{fx('AVG(CAST(flag_sleeping_dog AS DOUBLE))', 3)} AS flag_sleeping_dog FROM ({DERIVED_SQL}) GROUP BY Churn"))
def q_derived_means(spark, sf_dir):
    return eda.derived_means_by_churn(with_derived_features(_members(spark, sf_dir)))


# A13
@register("a13_box_stats_by_churn", with_members(_union([
    f"SELECT Churn, '{f}' AS feature, MIN(CAST({f} AS DOUBLE)) AS min, "
    f"{fx(f'QUANTILE_CONT(CAST({f} AS DOUBLE), 0.25)', 6)} AS q1, "
    f"{fx(f'QUANTILE_CONT(CAST({f} AS DOUBLE), 0.5)', 6)} AS median, "
    f"{fx(f'QUANTILE_CONT(CAST({f} AS DOUBLE), 0.75)', 6)} AS q3, MAX(CAST({f} AS DOUBLE)) AS max "
    f"FROM members GROUP BY Churn" for f in eda.BOX_FEATURES])))
def q_box_stats(spark, sf_dir):
    return eda.box_stats_by_churn(_members(spark, sf_dir))


# A14
def _corr_sql():
    cols = eda.CORR_COLUMNS
    parts = []
    for yc, yl in cols:
        for xc, xl in cols:
            if xc == yc:
                parts.append(f"SELECT '{xl}' AS x, '{yl}' AS y, 1.0 AS value")
            else:
                v = f"CORR(CAST({xc} AS DOUBLE), CAST({yc} AS DOUBLE))"
                parts.append(f"SELECT '{xl}' AS x, '{yl}' AS y, {fx(v, 2)} AS value FROM members")
    return _union(parts)


@register("a14_correlation_matrix", with_members(_corr_sql()))
def q_correlation_matrix(spark, sf_dir):
    return eda.correlation_matrix(_members(spark, sf_dir))


# A15 / O2
def _target_corr_sql(top=None):
    inner = _union([f"SELECT '{f}' AS feature, CORR(CAST({f} AS DOUBLE), CAST(Churn AS DOUBLE)) AS c "
                    f"FROM ({DERIVED_SQL})" for f in eda.TARGET_CORR_FEATURES])
    body = (f"SELECT ROW_NUMBER() OVER (ORDER BY ABS(c) DESC, feature) AS rank, feature, {fx('c', 4)} AS correlation, "
            f"{fx('ABS(c)', 4)} AS strength, {fx('ABS(c) * 100', 1)} AS strength_pct, "
            "CASE WHEN c >= 0 THEN 'associado a mais churn' ELSE 'associado a menos churn' END AS direction "
            f"FROM ({inner})")
    if top:
        body = f"SELECT * FROM ({body}) WHERE rank <= {top}"
    return with_members(body)


@register("a15_target_correlation", _target_corr_sql())
def q_target_correlation(spark, sf_dir):
    return eda.target_correlation(with_derived_features(_members(spark, sf_dir)))


@register("o2_top_correlations", _target_corr_sql(8))
def q_top_correlations(spark, sf_dir):
    return eda.target_correlation(with_derived_features(_members(spark, sf_dir)), top=8)


# A16
@register("a16_diagnostic_segments", with_members(f"""
SELECT key, label, count, {fx('count / denom', 4)} AS percentage, reference, action, estimated_pipeline FROM (
 SELECT 'early_droppers' AS key, 'Early droppers' AS label, COUNT(*) FILTER (WHERE Lifetime <= 1 AND Churn = 1) AS count,
        GREATEST(COUNT(*) FILTER (WHERE Churn = 1), 1) AS denom, '% do churn total' AS reference,
        'Onboarding intensivo nos primeiros 30 dias.' AS action, CAST(NULL AS BIGINT) AS estimated_pipeline FROM members
 UNION ALL
 SELECT 'sleeping_dogs', 'Sleeping dogs', COUNT(*) FILTER (WHERE Lifetime > 6 AND Avg_class_frequency_current_month < 0.5),
        GREATEST(COUNT(*), 1), '% da base total', 'Reativação cuidadosa para evitar contato excessivo.', NULL FROM members
 UNION ALL
 SELECT 'annual_zero_usage', 'Anuais com uso zero',
        COUNT(*) FILTER (WHERE Contract_period = 12 AND Avg_class_frequency_current_month = 0),
        GREATEST(COUNT(*), 1), '% da base total', 'Monitorar vencimento e criar oferta de retomada.',
        COUNT(*) FILTER (WHERE Contract_period = 12 AND Avg_class_frequency_current_month = 0) * 1800 FROM members)"""))
def q_diagnostic_segments(spark, sf_dir):
    return eda.diagnostic_segments(_members(spark, sf_dir))


# A17
_SEG_SQL = [
    ("Usuários novos", "Lifetime <= 1"),
    ("Sleeping dogs", "Lifetime >= 6 AND Avg_class_frequency_current_month < 1"),
    ("Contrato curto", "Contract_period <= 1"),
    ("Baixa frequência atual", "Avg_class_frequency_current_month < 1"),
    ("Sem visitas em grupo", "Group_visits = 0"),
]


@register("a17_action_segments", with_members(_union([
    f"SELECT '{s}' AS segment, COUNT(*) FILTER (WHERE {c}) AS members, "
    f"COALESCE({fx(f'SUM(Churn) FILTER (WHERE {c}) / COUNT(*) FILTER (WHERE {c})', 3)}, 0.0) AS churn_rate "
    "FROM members" for s, c in _SEG_SQL])))
def q_action_segments(spark, sf_dir):
    return eda.action_segments(_members(spark, sf_dir))


_EARLY_SQL = [("early_droppers", "Lifetime <= 1"), ("sleeping_dogs", "Lifetime > 6 AND Avg_class_frequency_current_month < 0.5"),
              ("anuais_uso_zero", "Contract_period >= 12 AND Avg_class_frequency_current_month < 0.1")]


@register("a17_early_and_idle_segments", with_members(_union([
    f"SELECT '{s}' AS segment, COUNT(*) FILTER (WHERE {c}) AS members, "
    f"{fx(f'SUM(Churn) FILTER (WHERE {c}) / NULLIF(COUNT(*) FILTER (WHERE {c}), 0)', 4)} AS churn_rate FROM members" for s, c in _EARLY_SQL])))
def q_early_and_idle_segments(spark, sf_dir):
    return eda.early_and_idle_segments(_members(spark, sf_dir))


@register("a2_merged_profile", """SELECT 'event_type' AS column, COUNT(*) AS n_rows, CAST(COUNT(*) - COUNT(event_type) AS BIGINT) AS nulls, TRUE AS near FROM events
UNION ALL SELECT 'user_id', COUNT(*), CAST(COUNT(*) - COUNT(user_id) AS BIGINT), TRUE FROM events
UNION ALL SELECT 'event_id', COUNT(*), CAST(COUNT(*) - COUNT(event_id) AS BIGINT), TRUE FROM events""")
def q_merged_profile(spark, sf_dir):
    """Kept profiles of each day of the events, merged: counts, and whether the sketch is within 3 % of the exact count."""
    ev = read_table(spark, sf_dir, "events")
    daily = profile.profile_sketch(ev.select(F.to_date("ts").alias("day"), "event_type", "user_id", "event_id"), by=["day"])
    merged = profile.read_profile(profile.merge_profiles(daily))
    exact = profile.column_profile(ev.select("event_type", "user_id", "event_id")).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.03
    return merged.join(exact, "column").select("column", "n_rows", "nulls", near.alias("near"))


# A18
@register("a18_retention_by_lifetime", with_members(
    "SELECT CAST(g.m AS INTEGER) AS lifetime, CASE WHEN COUNT(Churn) > 0 THEN "
    f"{fx('COUNT(*) FILTER (WHERE Churn = 0) / COUNT(Churn)', 3)} END AS retention FROM range(13) g(m) LEFT JOIN members ON Lifetime = g.m GROUP BY g.m"))
def q_retention_by_lifetime(spark, sf_dir):
    return eda.retention_by_lifetime(_members(spark, sf_dir))


# A19
@register("a19_tier_split", with_members(
    "SELECT t.ord, t.tier, COUNT(s.risk_tier) AS count FROM (VALUES (0, 'baixo'), (1, 'medio'), (2, 'alto'), "
    "(3, 'critico')) t(ord, tier) LEFT JOIN scored s ON s.risk_tier = t.tier GROUP BY t.ord, t.tier", scored=True))
def q_tier_split(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return eda.category_split(s, "risk_tier", S.TIERS, "tier")


@register("a19_archetype_split", with_members(
    "SELECT t.ord, t.archetype, COUNT(s.archetype) AS count FROM (VALUES (0, 'preco_sensivel'), "
    "(1, 'desengajado_conteudo'), (2, 'early_dropper'), (3, 'sleeping_dog'), (4, 'concorrente_driven')) "
    "t(ord, archetype) LEFT JOIN scored s ON s.archetype = t.archetype GROUP BY t.ord, t.archetype", scored=True))
def q_archetype_split(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return eda.category_split(s, "archetype", S.ARCHETYPES, "archetype")


# A20 / A30
@register("a20_score_facts", with_members(
    f"SELECT COUNT(*) AS n, {fx('CAST(SUM(FLOOR(p_raw * 100000.0 + 0.5)) AS DOUBLE) / COUNT(*) / 100000.0', 4)} "
    "AS avg_score, COUNT(*) FILTER (WHERE Churn IN (0, 1)) AS n_labeled, "
    "COALESCE(SUM(CAST(Churn AS DOUBLE)) FILTER (WHERE Churn IN (0, 1)) / COUNT(*) FILTER (WHERE Churn IN (0, 1)), "
    "0.0) AS base_rate FROM scored", scored=True))
def q_score_facts(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return eda.score_facts(s)


# A21
@register("a21_future_variable_check", with_members(
    f"SELECT Contract_period, {fx('AVG(Month_to_end_contract)', 3)} AS mte_mean, MAX(Month_to_end_contract) AS mte_max, "
    f"COUNT(*) AS n, {fx('SUM(CAST(Churn AS DOUBLE)) / COUNT(*)', 3)} AS churn, CAST(NULL AS DOUBLE) AS corr_mte_contract, "
    "CAST(NULL AS DOUBLE) AS corr_mte_lifetime FROM members GROUP BY Contract_period UNION ALL "
    "SELECT CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), COUNT(*), CAST(NULL AS DOUBLE), "
    f"{fx('CORR(Month_to_end_contract, CAST(Contract_period AS DOUBLE))', 4)}, "
    f"{fx('CORR(Month_to_end_contract, CAST(Lifetime AS DOUBLE))', 4)} FROM members"))
def q_future_variable_check(spark, sf_dir):
    return eda.future_variable_check(_members(spark, sf_dir))


# A24 (on the scorecard probability)
@register("a24_risk_band_rollup", with_members(
    f"SELECT band, COUNT(*) AS count, {fx('SUM(CAST(Churn AS DOUBLE)) / COUNT(*)', 4)} AS churn_rate, "
    f"{fx('AVG(p_raw)', 4)} AS avg_probability FROM (SELECT *, CASE WHEN p_raw > -0.01 AND p_raw <= 0.4 "
    "THEN 'Baixo Risco' WHEN p_raw > 0.4 AND p_raw <= 0.7 THEN 'Risco Médio' WHEN p_raw > 0.7 AND p_raw <= 1.01 "
    "THEN 'Alto Risco' END AS band FROM scored) WHERE band IS NOT NULL GROUP BY band", scored=True))
def q_risk_band_rollup(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return eda.risk_band_rollup(s)


# A26
_MED = S.LEGACY_NUMERIC


def _mode_sql(c):
    return (f"(SELECT CAST({c} AS DOUBLE) FROM members GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)")


@register("a26_feature_defaults", with_members(_union(
    [f"SELECT '{c}' AS feature, 'median' AS stat, {fx(f'MEDIAN(CAST({c} AS DOUBLE))', 6)} AS value FROM members"
     for c in _MED]
    + [f"SELECT '{c}' AS feature, 'mode' AS stat, {fx(_mode_sql(c), 6)} AS value" for c in S.LEGACY_BINARY])))
def q_feature_defaults(spark, sf_dir):
    return eda.feature_defaults(_members(spark, sf_dir))


# A27 / A28
@register("a27_eligibility_funnel", with_members(
    "SELECT COUNT(*) AS base, COUNT(*) FILTER (WHERE risk_tier IN ('alto', 'critico')) AS at_risk, "
    "COUNT(*) FILTER (WHERE archetype = 'sleeping_dog') AS sleeping_dogs, "
    "COUNT(*) FILTER (WHERE risk_tier IN ('alto', 'critico') AND archetype = 'sleeping_dog') AS dogs_at_risk, "
    "COUNT(*) FILTER (WHERE risk_tier IN ('alto', 'critico')) - "
    "COUNT(*) FILTER (WHERE risk_tier IN ('alto', 'critico') AND archetype = 'sleeping_dog') AS target FROM scored",
    scored=True))
def q_eligibility_funnel(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return eda.eligibility_funnel(s)


# W1
@register("w1_kaplan_meier", with_members(f"""
SELECT lifetime, CASE WHEN MAX(CASE WHEN hazard >= 1 THEN 1 ELSE 0 END) OVER w = 1 THEN 0.0
       ELSE {fx('PRODUCT(1.0 - hazard) OVER w', 4)} END AS survival_probability, at_risk, events
FROM (SELECT t.lifetime, t.events, (SELECT COUNT(*) FROM members WHERE Lifetime >= t.lifetime) AS at_risk,
             t.events / (SELECT COUNT(*) FROM members WHERE Lifetime >= t.lifetime) AS hazard
      FROM (SELECT Lifetime AS lifetime, COUNT(*) FILTER (WHERE Churn = 1) AS events FROM members GROUP BY Lifetime) t)
WINDOW w AS (ORDER BY lifetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def q_kaplan_meier(spark, sf_dir):
    return eda.kaplan_meier(_members(spark, sf_dir))
