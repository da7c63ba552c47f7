"""Registered quality, file-source, bundle and analysis queries (P3-P5, P10,
S1-S3, S5, S6, S14, X1, M22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schema as S
from ...functions.core import fixed, with_derived_features
from ...operators import eda, ml, profile, quality
from ...operators.scorecard import linear_scorecard
from ...session import stored
from ...sources import bundle
from ...sources.members import (dataset_fingerprint, member_snapshot, read_members, read_table, read_untrusted_csv,
                                table_fingerprint)
from ...streaming.jobs import run_dir
from .ml import DERIVED
from ..analysis import REGISTRY, analysis_run, as_rows
from ..oracle_sql import fx, with_members
from ..registry import register


class _Row(dict):
    """A dict with Row.asDict(), for per-feature reference values."""

    def asDict(self):
        return dict(self)

_COLS = S.LEGACY_FEATURES + [S.TARGET]


def _dirty(spark, sf_dir):
    """Members with injected dirt derived from the tables: exact duplicates
    (id % 50), duplicates that differ only in the dropped 'gender' column
    (id % 45) and rows with two nulls (id % 40). One pass: every member row
    emits its variants through one explode."""
    m = member_snapshot(spark, sf_dir)
    k = F.col("customer_id")
    cols = ["gender"] + _COLS

    def variant(cond, gender=None, null_cols=()):
        fields = []
        for c in cols:
            e = F.col(c)
            if c == "gender" and gender is not None:
                e = gender
            if c in null_cols:
                e = F.lit(None).cast("int")
            fields.append(e.alias(c))
        st = F.struct(*fields)
        return st if cond is None else F.when(cond, st)

    arr = F.array(variant(None), variant(k % 50 == 0), variant(k % 45 == 0, gender=1 - F.col("gender")),
                  variant(k % 40 == 0, null_cols=("Age", "Lifetime")))
    return m.select(F.explode(arr).alias("v")).filter(F.col("v").isNotNull()).select("v.*")


_DIRTY_SQL = ("dirty AS (SELECT gender, " + ", ".join(_COLS) + " FROM members "
              "UNION ALL SELECT gender, " + ", ".join(_COLS) + " FROM members WHERE customer_id % 50 = 0 "
              "UNION ALL SELECT 1 - gender, " + ", ".join(_COLS) + " FROM members WHERE customer_id % 45 = 0 "
              "UNION ALL SELECT gender, " + ", ".join("CAST(NULL AS INTEGER)" if c in ("Age", "Lifetime") else c
                                                     for c in _COLS) + " FROM members WHERE customer_id % 40 = 0)")


@register("p4_clean_report", with_members(
    f"SELECT * FROM (WITH {_DIRTY_SQL} SELECT (SELECT COUNT(*) FROM dirty) AS rows_original, "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(_COLS)} FROM dirty) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _COLS) + ") AS rows_clean, "
    "(SELECT COUNT(*) FROM dirty) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicates_removed, "
    "(SELECT CAST(" + " + ".join(f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in _COLS)
    + " AS BIGINT) FROM dirty) AS null_values)"))
def q_clean_report(spark, sf_dir):
    _, report = quality.clean(_dirty(spark, sf_dir), _COLS)
    return report


@register("p10_fill_defaults", with_members(
    "SELECT * FROM (WITH partial AS (SELECT customer_id, "
    + ", ".join(
        f"CASE WHEN customer_id % 97 = 0 AND '{c}' <> 'Lifetime' THEN NULL "
        f"WHEN customer_id % 3 = 0 AND '{c}' IN ('Age', 'Avg_class_frequency_total') THEN NULL "
        f"WHEN customer_id % 5 = 0 AND '{c}' = 'Lifetime' THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in S.LEGACY_FEATURES) + " FROM members), "
    "d AS (SELECT " + ", ".join(
        [f"(SELECT MEDIAN(CAST({c} AS DOUBLE)) FROM members) AS d_{c}" for c in S.LEGACY_NUMERIC]
        + [f"(SELECT CAST({c} AS DOUBLE) FROM members GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS d_{c}"
           for c in S.LEGACY_BINARY]) + ") "
    "SELECT customer_id, informed, informed >= 2 AS accepted, "
    + ", ".join(f"CASE WHEN informed >= 2 THEN COALESCE({c}, d_{c}) ELSE {c} END AS {c}" for c in S.LEGACY_FEATURES)
    + " FROM (SELECT p.*, d.*, " + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in S.LEGACY_FEATURES)
    + " AS informed FROM partial p, d))"))
def q_fill_defaults(spark, sf_dir):
    """Partial records derived from the members, filled with the members'
    medians / smallest modes (A26); rows with fewer than 2 fields rejected."""
    m = member_snapshot(spark, sf_dir)
    k = F.col("customer_id")
    cols = {}
    for c in S.LEGACY_FEATURES:
        e = F.col(c).cast("double")
        if c != "Lifetime":
            e = F.when(k % 97 == 0, F.lit(None).cast("double")).otherwise(e)
        if c in ("Age", "Avg_class_frequency_total"):
            e = F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(e)
        if c == "Lifetime":
            e = F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(e)
        cols[c] = e
    partial = m.select("customer_id", *[v.alias(c) for c, v in cols.items()])
    from ...operators.quantiles import quantile_map
    med = quantile_map(m, S.LEGACY_NUMERIC, [0.5])
    modes = m.agg(*[F.mode(F.col(c).cast("double"), True).alias(c) for c in S.LEGACY_BINARY]).first().asDict()
    row = _Row({**{c: med[(c, 0.5)] for c in S.LEGACY_NUMERIC}, **modes})
    filled = quality.fill_defaults(partial, row.asDict())
    return filled.select("customer_id", "informed", "accepted", *S.LEGACY_FEATURES)


@register("p3_p5_checks", None)
def q_checks(spark, sf_dir):
    m = member_snapshot(spark, sf_dir)
    quality.check_columns(m, _COLS)
    r = quality.check_binary_target(m)
    quality.guard_min_rows(m, 10, per_class=2)
    return r.withColumn("ok", F.lit(True))


_UPLOAD = S.MEMBER.fieldNames()


@register("s1_s2_csv_roundtrip", with_members(
    "SELECT COUNT(*) AS good_rows, (SELECT COUNT(*) FROM members WHERE customer_id % 100 = 0) AS rejected_rows, "
    f"CAST(SUM(Age) AS BIGINT) AS age_total, {fx('SUM(Avg_additional_charges_total)', 4)} AS charges_total FROM members"))
def q_csv(spark, sf_dir):
    """Members written as header CSV files; the fixed-schema FAILFAST reader reads them, and the untrusted reader reads
    the same folder with corrupt copies of every 100th row (Age not a number) and tells good and rejected rows."""
    out = _upload(spark, sf_dir)
    clean = read_members(spark, f"{out}/clean")
    ok, rejected = read_untrusted_csv(spark, f"{out}/upload")
    good = ok.agg(F.count(F.lit(1)).alias("good_rows"), F.sum("Age").cast("bigint").alias("age_total"),
                  fixed(F.sum("Avg_additional_charges_total"), 4).alias("charges_total"), F.lit(1).alias("one"))
    same = clean.agg(F.count(F.lit(1)).alias("clean_rows"), F.lit(1).alias("one"))
    bad = rejected.agg(F.count(F.lit(1)).alias("rejected_rows"), F.lit(1).alias("one"))
    j = good.join(same, "one").join(bad, "one")  # one row each
    return j.select(F.when(F.col("good_rows") == F.col("clean_rows"), F.col("good_rows")).alias("good_rows"), "rejected_rows", "age_total", "charges_total")


def _upload(spark, sf_dir):
    """A folder ``clean`` of CSV files with a header each, and ``upload``, the same and files with corrupt rows."""
    out = run_dir(spark, "csv")
    fields = stored(member_snapshot(spark, sf_dir).select("customer_id", *_UPLOAD), "upload")
    fields.drop("customer_id").write.option("header", True).csv(f"{out}/clean")
    fields.drop("customer_id").write.option("header", True).csv(f"{out}/upload")
    bad = fields.where("customer_id % 100 = 0").withColumn("Age", F.lit("x"))
    bad.drop("customer_id").write.mode("append").option("header", True).csv(f"{out}/upload")
    return out


@register("s2_rejected_reasons", with_members(
    "SELECT 'Age: not int: x' AS reason, COUNT(*) AS lines FROM members WHERE customer_id % 100 = 0 HAVING COUNT(*) > 0"))
def q_reasons(spark, sf_dir):
    """Why lines were rejected."""
    _, rejected = read_untrusted_csv(spark, f"{_upload(spark, sf_dir)}/upload")
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@register("s3_dataset_fingerprint", None)
def q_fingerprint(spark, sf_dir):
    """Digests of every table file of the scale-factor folder and of all together."""
    return dataset_fingerprint(spark, f"{sf_dir.rstrip('/')}/*.parquet")


_DIGESTED = {"documents": ["doc_id", "text", "lang", "source", "n_chars"], "labels": ["doc_id", "quality", "toxic"],
             "nation": ["n_nationkey", "n_name", "n_regionkey"], "conversations": ["conv_id", "turn", "role", "text"]}


@register("s3_table_fingerprint", "WITH d AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS file, CAST('0x' || SUBSTRING(md5("
    + " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    + f"), 1, 15) AS BIGINT) AS h FROM {t}" for t, cols in _DIGESTED.items())
    + ") SELECT file, COUNT(*) AS n_rows, CAST(SUM(h) AS VARCHAR) AS digest FROM d GROUP BY file "
    "UNION ALL SELECT '__dataset__', COUNT(*), CAST(SUM(h) AS VARCHAR) FROM d")
def q_table_fingerprint(spark, sf_dir):
    """Order-insensitive digests of four tables' rows, and of all of them."""
    out = None
    for t, cols in _DIGESTED.items():
        d = table_fingerprint(read_table(spark, sf_dir, t).select(*cols)).withColumn("file", F.lit(t))
        out = d if out is None else out.unionByName(d)
    total = out.agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))
    return out.unionByName(total.withColumn("file", F.lit("__dataset__")))


@register("x1_winsorizer_bounds", with_members(
    f"SELECT * FROM (WITH t AS (SELECT * FROM ({DERIVED}) WHERE split = 'train') "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {fx(f'QUANTILE_CONT({c}, 0.01)', 6)} AS lower, "
                         f"{fx(f'QUANTILE_CONT({c}, 0.99)', 6)} AS upper, "
                         f"(SELECT COUNT(*) FROM members WHERE {c} > (SELECT QUANTILE_CONT({c}, 0.99) FROM t) "
                         f"OR {c} < (SELECT QUANTILE_CONT({c}, 0.01) FROM t)) AS clipped FROM t"
                         for c in S.WINSORIZE_FEATURES) + ")"))
def q_winsorizer(spark, sf_dir):
    """The Winsorizer estimator fitted on the training split only,
    then applied to every member; bounds and the number of clipped values."""
    import json
    m = ml.stratified_split(member_snapshot(spark, sf_dir))
    est = bundle.Winsorizer(inputCols=S.WINSORIZE_FEATURES)
    model = est.fit(m.filter(F.col("split") == "train"))
    b = json.loads(model.getOrDefault(model.bounds))
    out = model.transform(m.select("customer_id", *[F.col(c).alias(f"raw_{c}") for c in S.WINSORIZE_FEATURES],
                                   *S.WINSORIZE_FEATURES))
    clipped = out.agg(*[F.count_if(F.col(c) != F.col(f"raw_{c}")).alias(c) for c in S.WINSORIZE_FEATURES]).first()
    from ...functions.core import fixed
    rows = [(c, b[c][0], b[c][1], int(clipped[c])) for c in S.WINSORIZE_FEATURES]
    t = spark.createDataFrame(rows, "feature string, lower double, upper double, clipped long")
    return t.select("feature", fixed("lower", 6).alias("lower"), fixed("upper", 6).alias("upper"), "clipped")


@register("s5_s6_bundle_roundtrip", None)
def q_bundle(spark, sf_dir):
    """Save the trained bundle, load it, score every member both ways and
    compare (M23), and write the metrics and feature metadata (S6)."""
    from .ml import members, trained
    model, scored = trained(spark, sf_dir)
    out = run_dir(spark, "bundle")
    bundle.save_bundle(model, f"{out}/model", spark)
    loaded = bundle.load_bundle(f"{out}/model", spark)
    m = members(spark, sf_dir)
    a = ml.score_batch(model, m).select("customer_id", F.col("p_cal").alias("p_a"))
    b = ml.score_batch(loaded, m).select("customer_id", F.col("p_cal").alias("p_b"))
    bundle.write_metrics(ml.split_metrics(scored, model.threshold), f"{out}/metrics")
    bundle.write_metrics(bundle.feature_meta(spark, model.prep, model.threshold), f"{out}/feature_meta")
    return ml.scoring_parity(a, b, pa="p_a", pb="p_b").withColumn(
        "metrics_rows", F.lit(spark.read.json(f"{out}/metrics").count()))


def eda_models(spark, sf_dir):
    """Every EDA read model by name. The members are derived once, into a stored table."""
    m = stored(member_snapshot(spark, sf_dir), "eda-members")
    d = with_derived_features(m)
    s = linear_scorecard(m, keep=["customer_id", "Churn"], with_drivers=False)
    return {"validation": eda.validation_report(m), "column_profile": profile.column_profile(m), "describe": eda.describe(m, S.RAW_FEATURES + [S.TARGET]),
            "duplicates": profile.duplicate_count(m), "summary": eda.kpi_summary(m), "distributions": eda.value_distribution(m, ["Churn", "Contract_period", "Group_visits"]),
            "by_contract": eda.churn_by_contract(m), **{f"by_cohort_{k}": eda.churn_by_cohort(m, k) for k in eda.COHORT_SCHEMES},
            "freq_dist": eda.frequency_distribution(m), "by_binary": eda.churn_by_binary(m), "compare": eda.compare_by_churn(m),
            "derived_means": eda.derived_means_by_churn(d), "box_stats": eda.box_stats_by_churn(m), "correlation": eda.correlation_matrix(m),
            "target_correlation": eda.target_correlation(d), "diagnostic_segments": eda.diagnostic_segments(m), "action_segments": eda.action_segments(m),
            "early_and_idle_segments": eda.early_and_idle_segments(m), "retention": eda.retention_by_lifetime(m), "survival": eda.kaplan_meier(m),
            "tiers": eda.category_split(s, "risk_tier", S.TIERS, "tier"), "score_facts": eda.score_facts(s), "defaults": eda.feature_defaults(m),
            "funnel": eda.eligibility_funnel(s)}


@register("s14_eda_bundle", with_members("""
SELECT 'summary' AS model, 'customers' AS field, CAST(COUNT(*) AS VARCHAR) AS value FROM members
UNION ALL SELECT 'funnel', 'base', CAST(COUNT(*) AS VARCHAR) FROM scored
UNION ALL SELECT 'by_contract', CAST(Contract_period AS VARCHAR), CAST(COUNT(*) AS VARCHAR) FROM members GROUP BY Contract_period
UNION ALL SELECT 'models', 'written', '26'""", scored=True))
def q_eda_bundle(spark, sf_dir):
    """All EDA read models written under one folder and read back; some of their rows, and how many models there are."""
    models = eda_models(spark, sf_dir)
    folder = f"{run_dir(spark, 'eda')}/bundle"
    back = bundle.write_eda_bundle(models, folder)
    text = lambda name, field, value: back[name].select(F.lit(name).alias("model"), field.alias("field"), F.col(value).cast("string").alias("value"))
    n = spark.range(1).select(F.lit("models").alias("model"), F.lit("written").alias("field"), F.lit(str(len(back))).alias("value"))
    return (text("summary", F.lit("customers"), "customers").unionByName(text("funnel", F.lit("base"), "base"))
            .unionByName(text("by_contract", F.col("contract").cast("string"), "total")).unionByName(n))


@register("m22_analysis_run", None)
def q_analysis(spark, sf_dir):
    """The legacy on-demand analysis: the EDA sections once, then all six
    algorithms; every section's rows as JSON."""
    return as_rows(analysis_run(member_snapshot(spark, sf_dir), list(REGISTRY)))
