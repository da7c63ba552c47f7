"""Registered queries for operators and functions that other queries use only
in part (P1, P11, F12, F14, F15, F16, H5), with DuckDB twins. Expected values
in the twins are written out, not imported."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schema as S
from ...functions import text as T
from ...functions.core import with_derived_features
from ...operators import quality
from ...operators.scorecard import predicted_churn
from ...sources.members import member_snapshot
from ..oracle_sql import fx, sdiv, with_members
from ..registry import register
from .core import scored_members


@register("p1_model_features", with_members(f"""
SELECT customer_id, gender, Near_Location, Partner, Promo_friends, Phone, Contract_period, Group_visits, Age,
       Avg_additional_charges_total, Lifetime, Avg_class_frequency_total, Avg_class_frequency_current_month,
       {sdiv('Avg_class_frequency_current_month', 'Avg_class_frequency_total')} AS ratio_freq_atual_vs_lifetime,
       Avg_class_frequency_current_month - Avg_class_frequency_total AS delta_freq,
       CAST(Contract_period AS DOUBLE) * CAST(Lifetime AS DOUBLE) AS contract_x_lifetime,
       CAST(Lifetime <= 1 AS INTEGER) AS flag_early_user,
       CAST(Lifetime > 6 AND Avg_class_frequency_current_month < 0.5 AS INTEGER) AS flag_sleeping_dog
FROM members"""))
def q_model_features(spark, sf_dir):
    d = with_derived_features(member_snapshot(spark, sf_dir))
    return d.select("customer_id", *quality.model_features(d).columns)


@register("p11_apply_overrides", with_members("""
SELECT customer_id, 12 AS Contract_period, Group_visits, Lifetime,
       CAST(Avg_class_frequency_total AS DOUBLE) + CAST(1.0 AS DOUBLE) AS Avg_class_frequency_current_month, Churn FROM members"""))
def q_overrides(spark, sf_dir):
    d = quality.apply_overrides(member_snapshot(spark, sf_dir), {
        "Contract_period": 12, "Avg_class_frequency_current_month": F.col("Avg_class_frequency_total") + F.lit(1.0)})
    return d.select("customer_id", "Contract_period", "Group_visits", "Lifetime", "Avg_class_frequency_current_month", "Churn")


def _compact_sql(x: str) -> str:
    one = lambda y: f"regexp_replace(replace(printf('%.1f', {fx(y, 1)}), '.', ','), ',0$', '')"
    return (f"CASE WHEN {x} >= 1000000000 THEN {one(f'{x} / 1000000000.0')} || ' bi' WHEN {x} >= 1000000 THEN {one(f'{x} / 1000000.0')} || ' mi' "
            f"WHEN {x} >= 1000 THEN {one(f'{x} / 1000.0')} || ' mil' ELSE {one(x)} END")


_BIG = "CAST(customer_id * customer_id * 37 AS DOUBLE)"


@register("f12_formats", with_members(f"""
SELECT customer_id, printf('%.1f', {fx('churn_probability * 100', 1)}) || '%' AS pct,
       'R$ ' || replace(format('{{:,}}', CAST({_BIG} AS BIGINT)), ',', '.') AS brl, {_compact_sql(_BIG)} AS compact
FROM scored""", scored=True))
def q_formats(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    k = F.col("customer_id")
    big = (k * k * 37).cast("double")
    return s.select("customer_id", T.fmt_pct("churn_probability").alias("pct"), T.fmt_brl(big).alias("brl"), T.fmt_compact(big).alias("compact"))


@register("f14_f15_channels", with_members("""
SELECT customer_id, CASE WHEN len(kept) = 0 THEN 'e-mail' ELSE array_to_string(kept[1:2], ', ') END AS channels FROM (
  SELECT customer_id, list_filter(list_transform(list_filter([
      CASE WHEN customer_id % 2 = 0 THEN '  WhatsApp ' END, CASE WHEN customer_id % 3 = 0 THEN 'fax' END,
      CASE WHEN customer_id % 5 = 0 THEN 'Push notification' END, CASE WHEN customer_id % 7 = 0 THEN 'SMS' END,
      CASE WHEN customer_id % 11 = 0 THEN 'mail' END], lambda x: x IS NOT NULL), lambda x: trim(lower(x))),
    lambda c: instr(c, 'e-mail') > 0 OR instr('e-mail', c) > 0 OR instr(c, 'whatsapp') > 0 OR instr('whatsapp', c) > 0
      OR instr(c, 'push') > 0 OR instr('push', c) > 0 OR instr(c, 'ligacao') > 0 OR instr('ligacao', c) > 0
      OR instr(c, 'sms') > 0 OR instr('sms', c) > 0) AS kept
  FROM members)"""))
def q_channels(spark, sf_dir):
    """F14 / F15 on channel lists made from the member's id: known, unknown, longer and shorter names."""
    k = F.col("customer_id")
    some = F.array(*[F.when(k % n == 0, F.lit(c)) for n, c in ((2, "  WhatsApp "), (3, "fax"), (5, "Push notification"), (7, "SMS"), (11, "mail"))])
    d = member_snapshot(spark, sf_dir).select("customer_id", F.filter(some, lambda c: c.isNotNull()).alias("c"))
    return d.select("customer_id", T.join_channels(T.clean_channels("c")).alias("channels"))


@register("f16_extract_json", with_members("""
SELECT customer_id, CASE WHEN customer_id % 3 <> 0 THEN 'member ' || CAST(customer_id AS VARCHAR) END AS narrative,
       CASE WHEN customer_id % 3 <> 0 THEN Lifetime END AS n FROM members"""))
def q_extract_json(spark, sf_dir):
    """F16 on answers with a JSON object between other words, or without one."""
    k = F.col("customer_id").cast("string")
    answer = F.when(F.col("customer_id") % 3 != 0, F.concat(F.lit('Sure: {"narrative": "member '), k, F.lit('",\n "n": '), F.col("Lifetime").cast("string"),
                                                            F.lit("} as asked"))).otherwise(F.concat(F.lit("no object for "), k))
    d = member_snapshot(spark, sf_dir).select("customer_id", T.extract_json(answer, "narrative string, n int").alias("j"))
    return d.select("customer_id", "j.narrative", "j.n")


@register("h5_predicted_churn", with_members("""
SELECT customer_id, CAST(churn_probability >= 0.5 AS INTEGER) AS predicted_churn FROM scored""", scored=True))
def q_predicted(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return s.select("customer_id", predicted_churn("churn_probability", S.DEFAULT_THRESHOLD).alias("predicted_churn"))
