"""Minimum slice: snapshot -> features -> scorecard -> tier/archetype mix."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.scorecard import linear_scorecard
from ...sources.members import member_snapshot
from ..oracle_sql import with_members
from ..registry import register


def scored_members(spark, sf_dir, with_drivers=False):
    m = member_snapshot(spark, sf_dir)
    return m, linear_scorecard(m, keep=["customer_id", "Churn"], with_drivers=with_drivers)


@register("s4_member_snapshot", with_members("SELECT * FROM members"))
def q_member_snapshot(spark, sf_dir):
    return member_snapshot(spark, sf_dir)


@register("h1_linear_scorecard", with_members(
    """SELECT customer_id, churn_probability, risk_tier, archetype,
              archetype <> 'sleeping_dog' AS proactive_allowed, logit
       FROM scored""", scored=True), bench=True)
def q_linear_scorecard(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return s.select("customer_id", "churn_probability", "risk_tier", "archetype", "proactive_allowed", "logit")


@register("slice_archetype_tier_mix", with_members(
    """SELECT archetype, risk_tier, COUNT(*) AS members, CAST(SUM(Churn) AS BIGINT) AS churned,
              CAST(SUM(FLOOR(p_raw * 100000.0 + 0.5)) AS DOUBLE) / COUNT(*) / 100000.0 AS mean_probability
       FROM scored GROUP BY archetype, risk_tier""", scored=True), bench=True)
def q_archetype_tier_mix(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return archetype_tier_mix(s)


def archetype_tier_mix(scored):
    """Members, churned and mean (5-decimal) probability per archetype x tier.
    Exact integer sums, so the mean is the same double in every engine."""
    return (scored.groupBy("archetype", "risk_tier")
            .agg(F.count(F.lit(1)).alias("members"),
                 F.sum("Churn").cast("bigint").alias("churned"),
                 (F.sum("p5").cast("double") / F.count(F.lit(1)) / F.lit(100000.0)).alias("mean_probability")))
