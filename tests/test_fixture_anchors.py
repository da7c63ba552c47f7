"""Regression anchors from FIXTURES §2 (counts of the member snapshot)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnwise.operators.evaluate import brier, labeled_points
from churnwise.operators.scorecard import linear_scorecard
from churnwise.sources.members import member_snapshot


@pytest.fixture(scope="module")
def scored(spark):
    m = member_snapshot(spark, SF_SMALL)
    return linear_scorecard(m, keep=["customer_id", "Churn", "Lifetime", "Contract_period",
                                     "Avg_class_frequency_current_month"]).cache()


def test_member_counts(spark, scored):
    r = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("Churn").alias("churned"),
                   F.sum("flag_early_user").alias("early"), F.sum("flag_sleeping_dog").alias("dogs")).first()
    assert (r.n, r.churned, r.early, r.dogs) == (150, 65, 33, 11)


def test_tier_and_archetype_counts(scored):
    tiers = {r.risk_tier: r["count"] for r in scored.groupBy("risk_tier").count().collect()}
    assert tiers == {"critico": 110, "alto": 11, "medio": 7, "baixo": 22}
    arch = {r.archetype: r["count"] for r in scored.groupBy("archetype").count().collect()}
    assert arch == {"early_dropper": 29, "desengajado_conteudo": 36, "preco_sensivel": 21,
                    "concorrente_driven": 53, "sleeping_dog": 11}


def test_brier_anchor(scored):
    assert brier(labeled_points(scored)).first().brier == pytest.approx(0.490877, abs=1e-6)
