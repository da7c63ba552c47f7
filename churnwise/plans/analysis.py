"""On-demand analysis (M22 / X5): clean -> EDA -> chosen algorithms ->
segments -> personas, over a member DataFrame.

The cleaned table is written once to the shared folder, so every section plans
from a plain scan. The EDA sections are the same for all algorithms and are
made once. The registry maps an algorithm name to a function ``DataFrame ->
dict[str, DataFrame]``; every value is a lazy DataFrame, so a caller writes or
shows only what it needs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.core import fixed, with_derived_features
from ..operators import clusters, eda, evaluate as ev, ml, quality
from ..operators.personas import personas
from ..operators.scorecard import rule_scorecard
from ..session import scratch_path, stored

#: Rows of the prediction preview (the reference's own limit).
PREVIEW = 500


def _segments_from_labels(df: DataFrame, label: str, order: list[str]) -> DataFrame:
    g = df.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(S.TARGET).cast("double"))
                                                 .alias("r"))
    lab = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(order)], "ord int, label string")
    j = lab.join(g, lab.label == g._l, "left")
    return j.select("ord", "label", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
                    fixed("r", 4).alias("churn_rate"))


def run_baseline(df: DataFrame, params: dict) -> dict[str, DataFrame]:
    h = rule_scorecard(df)
    rules = df.sparkSession.createDataFrame([(x,) for x in S.LEGACY_FEATURES], "feature string")
    return {"segments": _segments_from_labels(h, "risk_label", ["Alto Risco", "Risco Médio", "Baixo Risco"]),
            "rules_used": rules,
            "predictions": h.orderBy(F.col("risk_points").desc(), ROW_KEY).limit(PREVIEW).select(ROW_KEY, "risk_points", "risk_label")}


def run_kmeans(df: DataFrame, params: dict) -> dict[str, DataFrame]:
    x = stored(ml.scaled_features(df.withColumnRenamed(ROW_KEY, "customer_id")), "analysis-kmeans")
    km = clusters.fit_kmeans(x, int(params.get("n_clusters", 4)), starts=int(params.get("n_init", 10)))
    prof = stored(ml.cluster_profile(km.assign(x)), "analysis-profile")
    return {"segments": prof.select(F.col("risk_label").alias("label"), "count", "churn_rate", "cluster"),
            "heatmap": ml.heatmap_normalized(prof), "profile": prof}


def _importance(model, names: list[str], spark) -> DataFrame:
    """Feature importance: of the trees, or the size of a linear model's weights as shares of their sum."""
    raw = getattr(model, "featureImportances", None)
    values = [abs(float(v)) for v in (raw if raw is not None else model.coefficients).toArray()]
    total = sum(values) or 1.0
    out = spark.createDataFrame(list(zip(names, [v / total for v in values])), "feature string, importance double")
    return out.orderBy(F.col("importance").desc(), "feature")


def _supervised(fit: Callable) -> Callable:
    def run(df: DataFrame, params: dict) -> dict[str, DataFrame]:
        d = df.withColumnRenamed(ROW_KEY, "customer_id")
        d = d.withColumn("split", F.when(ml.hash01("customer_id") < 0.8, "train").otherwise("test"))
        feats = S.LEGACY_FEATURES
        prep = ml.fit_prep(d.filter(F.col("split") == "train"), numeric=[f for f in feats if f not in S.LEGACY_BINARY],
                           binary=S.LEGACY_BINARY, winsor=[])
        x = stored(prep.transform(d, ["customer_id", S.TARGET, "split"]).select("customer_id", S.TARGET, "split", "features"), "analysis-features")
        model = fit(stored(ml.class_weights(x.filter(F.col("split") == "train")), "analysis-train"))
        pred = stored(ml.prob_col(model.transform(x)).select("customer_id", S.TARGET, "split", "p_model"), "analysis-scored")
        test = ev.labeled_points(pred.filter(F.col("split") == "test"), p="p_model")
        names = [f for f in feats if f not in S.LEGACY_BINARY] + list(S.LEGACY_BINARY)
        return {"metrics": ev.compute_metrics(ev.score_hist(test), 0.5),
                "segments": eda.risk_band_rollup(pred, "p_model").withColumnRenamed("band", "label"),
                "feature_importance": _importance(model, names, df.sparkSession),
                "predictions": pred.orderBy("customer_id").limit(PREVIEW)
                .select(F.col("customer_id").alias(ROW_KEY), fixed("p_model", 4).alias("probability"))}
    return run


REGISTRY: dict[str, Callable[[DataFrame, dict], dict[str, DataFrame]]] = {
    "kmeans": run_kmeans,
    "random_forest": _supervised(lambda t: ml.fit_random_forest(t, n_trees=100)),
    "logistic_regression": _supervised(lambda t: ml.fit_logistic(t)),
    "xgboost": _supervised(lambda t: ml.fit_boosted(t)),
    "lightgbm": _supervised(lambda t: ml.fit_boosted(t, {"maxDepth": 6, "stepSize": 0.05})),
    "business_rules_baseline": run_baseline,
}

#: A row's own key: a hash of its content, the same in every evaluation (rows are distinct after cleaning).
ROW_KEY = "row_key"


def cleaned(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cleaned member table, stored, and the cleaning report. Duplicate members are told by the
    features alone; the id is not one of them."""
    cols = S.LEGACY_FEATURES + [S.TARGET]
    quality.check_columns(df, cols)
    clean_df, report = quality.clean(df.drop("customer_id"), cols)
    path = scratch_path(df.sparkSession, f"analysis/{uuid.uuid4().hex[:10]}")
    clean_df.withColumn(ROW_KEY, F.xxhash64(*cols)).write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    quality.guard_min_rows(out, 10)
    return out, report


def eda_sections(clean_df: DataFrame, report: DataFrame) -> dict[str, DataFrame]:
    return {"cleaning": report,
            "summary": eda.kpi_summary(clean_df),
            "distributions": eda.value_distribution(clean_df, ["Churn", "Contract_period", "Group_visits"]),
            "top_correlations": eda.target_correlation(with_derived_features(clean_df), top=8),
            "comparison_by_churn": eda.compare_by_churn(clean_df, [f for f in eda.COMPARE_LABELS]),
            "survival_curve": eda.kaplan_meier(clean_df),
            "cohort_churn": eda.churn_by_cohort(clean_df, "legacy"),
            "diagnostic_segments": eda.diagnostic_segments(clean_df)}


def analysis_run(df: DataFrame, algorithms: list[str], params: dict | None = None) -> dict[str, dict[str, DataFrame]]:
    """Clean, guard, EDA read models (under ``eda``), then each algorithm's
    outputs and personas. The algorithms are independent: their fits run as
    parallel Spark jobs."""
    wrong = [a for a in algorithms if a not in REGISTRY]
    if wrong:
        raise ValueError(f"invalid algorithm; options: {', '.join(REGISTRY)}")
    clean_df, report = cleaned(df)
    out = {"eda": eda_sections(clean_df, report)}
    with ThreadPoolExecutor(max_workers=max(1, len(algorithms))) as pool:
        results = pool.map(lambda name: REGISTRY[name](clean_df, params or {}), algorithms)
        for name, res in zip(algorithms, results):
            out[name] = {**res, "personas": personas(res["segments"], name)}
    return out


def as_rows(sections: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """All sections as rows: algorithm (or ``eda``), section, and each row of it as JSON."""
    out = None
    for algorithm, parts in sections.items():
        for section, df in parts.items():
            rows = df.select(F.lit(algorithm).alias("algorithm"), F.lit(section).alias("section"),
                             F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row"))
            out = rows if out is None else out.unionByName(rows)
    return out
