"""The registered queries without a twin, against what can be computed beside them."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnwise import schema as S
from churnwise.functions import text as T
from churnwise.operators import ml, whatif
from churnwise.plans.registry import load_all
from churnwise.sources.members import member_snapshot

REG = load_all()


def test_heatmap_is_the_profile_scaled(spark):
    rows = [(0, 1.0, 5.0), (1, 3.0, 5.0), (2, 2.0, 5.0)]
    got = {r.cluster: (r.a, r.b) for r in ml.heatmap_normalized(spark.createDataFrame(rows, "cluster int, a double, b double"), ["a", "b"]).collect()}
    assert got == {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (0.5, 0.0)}


def test_cluster_profile_counts(spark):
    rows = [(c, i % 2 if c else 0, float(i)) for c in range(3) for i in range(4 + c)]
    p = {r.cluster: r for r in ml.cluster_profile(spark.createDataFrame(rows, f"cluster int, {S.TARGET} int, Age double"), ["Age"]).collect()}
    assert [(p[c]["count"], p[c].churn_rate, p[c].Age) for c in range(3)] == [(4, 0.0, 1.5), (5, 0.4, 2.0), (6, 0.5, 2.5)]
    assert [p[c].risk_label for c in (2, 1, 0)] == ["Alto Risco", "Risco Médio-Alto", "Risco Médio-Baixo"]
    assert sum(r.share for r in p.values()) == pytest.approx(1)


def test_cluster_risk_mix_shares(spark):
    rows = [(0, p) for p in (0.1, 0.39999, 0.4, 0.7)] + [(1, 0.9)]
    got = {r.cluster: tuple(r)[1:] for r in ml.cluster_risk_mix(spark.createDataFrame(rows, "cluster int, p_model double")).collect()}
    assert got[1] == (0.9, 1.0, 0.0, 0.0) and got[0][1:] == (0.25, 0.25, 0.5)


def test_narration_texts(spark):
    rows = [("Avg_class_frequency_current_month", "frequência", 3.0, 0.9, 0.7), ("Group_visits", "grupo", 1.0, 0.5, 0.5), ("Contract_period", "contrato", 12.0, 0.61, 0.645),
            (None, None, None, 0.2, None), ("Avg_class_frequency_current_month", "frequência", 2.5, 0.305, 0.2)]
    df = spark.createDataFrame(rows, "lever_feature string, lever_label string, to_value double, _real double, projected double")
    got = [r.narration for r in whatif.narrate_change(df, F.lit("Contrato"), F.col("_real") > 0.5).collect()]
    tail = " Isto descreve o comportamento do modelo, não causalidade."
    assert got == [
        "Ao ajustar frequência para 3 aulas/sem, o modelo move o risco de 90% para 70% (queda de 20 p.p.). O maior fator é Contrato, empurrando o risco para cima." + tail,
        "Ao ajustar grupo para 1, o modelo move o risco de 50% para 50% (sem mudança no risco). O maior fator é Contrato, puxando o risco para baixo." + tail,
        "Ao ajustar contrato para 12 meses, o modelo move o risco de 61% para 65% (alta de 4 p.p.). O maior fator é Contrato, empurrando o risco para cima." + tail,
        "Sem ajustes, o modelo move o risco de 20% para 20% (sem mudança no risco). O maior fator é Contrato, puxando o risco para baixo." + tail,
        "Ao ajustar frequência para 2.5 aulas/sem, o modelo move o risco de 31% para 20% (queda de 10 p.p.). O maior fator é Contrato, puxando o risco para baixo." + tail]


def test_driver_lines_text(spark):
    d = "array<struct<feature:string,value:double,shap_value:double,direction:string,actionable:boolean>>"
    rows = [([("a", 3.0, 1.23456, "up", True), ("b", 0.25, -0.5, "down", False)],), ([],)]
    got = [r[0] for r in spark.createDataFrame(rows, f"d {d}").select(T.driver_lines("d", {"a": "Um"})).collect()]
    assert got == ["- Um = 3 (SHAP 1.235, aumenta o risco, acionável)\n- b = 0.25 (SHAP -0.500, reduz o risco, não-acionável)", ""]


def test_every_member_is_narrated(spark):
    df = REG["f17_narrate_cheapest_lever"].fn(spark, SF_SMALL)
    r = df.agg(F.count("*").alias("n"), F.count("narration").alias("told"), F.count_distinct("customer_id").alias("ids")).first()
    assert r.n == r.told == r.ids == member_snapshot(spark, SF_SMALL).count()


def test_late_report_counts_the_replayed_week(spark):
    rows = REG["t6_late_data_report"].fn(spark, SF_SMALL).collect()
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    first = ev.agg(F.min("ts")).first()[0]
    week = ev.where(F.col("ts") < F.lit(first) + F.expr("INTERVAL 7 DAYS")).count()
    assert sum(r.input_rows for r in rows if r.run == 1) == ev.count() and sum(r.input_rows for r in rows if r.run == 2) == week
    assert sum(r.dropped_by_watermark for r in rows if r.run == 1) == 0 < sum(r.dropped_by_watermark for r in rows if r.run == 2)


def test_analysis_sections_equal_the_read_models(spark):
    """The SQL sections of the on-demand analysis, computed anew from the cleaned members."""
    rows = REG["m22_analysis_run"].fn(spark, SF_SMALL).collect()
    parts = {}
    for r in rows:
        parts.setdefault((r.algorithm, r.section), []).append(json.loads(r.row))
    cols = S.LEGACY_FEATURES + [S.TARGET]
    m = member_snapshot(spark, SF_SMALL).select(*cols).dropna().dropDuplicates().toPandas()
    assert parts["eda", "cleaning"][0]["rows_clean"] == len(m)
    assert parts["eda", "summary"][0]["customers"] == len(m) and parts["eda", "summary"][0]["churn_rate"] == pytest.approx(m.Churn.mean(), abs=5e-5)
    dist = {(r["column"], r["label"]): r["count"] for r in parts["eda", "distributions"]}
    assert dist == {(c, str(v)): n for c in ("Churn", "Contract_period", "Group_visits") for v, n in m[c].value_counts().items()}
    cohorts = {r["cohort"]: r["count"] for r in parts["eda", "cohort_churn"]}
    assert sum(cohorts.values()) == int((m.Lifetime >= -1).sum()) and cohorts["2-3 meses"] == int(((m.Lifetime > 1) & (m.Lifetime <= 3)).sum())
    km = sorted(parts["eda", "survival_curve"], key=lambda r: next(iter(r.values())))
    assert len(km) == m.Lifetime.nunique()
    algorithms = {a for a, _ in parts} - {"eda"}
    assert algorithms == {"kmeans", "random_forest", "logistic_regression", "xgboost", "lightgbm", "business_rules_baseline"}
    for a in algorithms:
        assert sum(r["count"] for r in parts[a, "segments"]) == len(m), a
        assert len(parts[a, "personas"]) == len(parts[a, "segments"])
