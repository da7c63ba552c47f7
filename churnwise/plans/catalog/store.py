"""Registered serving-table queries (S7-S13, S15, W2, J1-J5, P7-P12, O1, O3,
U3, D8, F21) with DuckDB twins.

Serving tables are derived from the member snapshot and its scorecard; the
score history follows FIXTURES §5 (three versions, a created_at tie, some
members unscored, some scores without explanation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schema as S
from ...functions.core import dbl, fixed, risk_tier
from ...session import scratch_path
from ...sources import store
from ...sources.members import member_snapshot, sample_rows
from ...operators.scorecard import linear_scorecard
from ..oracle_sql import fx, with_members
from .decisions import CONTRIB_SQL, RANKED_SQL
from ..registry import register


def _tag(sf_dir):
    return sf_dir.rstrip("/").split("/")[-1]


def _base(spark, sf_dir):
    m = member_snapshot(spark, sf_dir)
    s = linear_scorecard(m, keep=["customer_id", "Churn"], with_drivers=True)
    return m, s


def score_history(scored, versions: int = 3, skip_mod: int = 17, tie_mod: int = 7) -> DataFrame:
    """Test history of score rows (FIXTURES §5): every member scored
    ``versions`` times with rising created_at, the last version carrying the
    current probability; members with id % ``tie_mod`` == 0 get a created_at
    tie between the last two versions (the higher id must win); members with
    id % ``skip_mod`` == 0 are left unscored."""
    k = F.explode(F.sequence(F.lit(1), F.lit(versions))).alias("k")
    s = scored.filter(F.col("customer_id") % skip_mod != 0).select("*", k)
    p = F.least(F.greatest(dbl("churn_probability") + (F.col("k") - versions) * F.lit(0.01), F.lit(0.0)), F.lit(1.0))
    day = F.when((F.col("customer_id") % tie_mod == 0) & (F.col("k") == versions), F.col("k") - 1).otherwise(F.col("k"))
    return s.select(
        (F.col("customer_id") * 10 + F.col("k")).alias("id"), "customer_id",
        fixed(p, 5).cast("decimal(6,5)").alias("churn_probability"),
        risk_tier(fixed(p, 5), "scorecard").alias("risk_tier"), "archetype",
        (F.col("archetype") != "sleeping_dog").alias("proactive_allowed"),
        F.lit(S.DEFAULT_THRESHOLD).cast("decimal(6,5)").alias("threshold"),
        F.concat(F.lit("v"), F.col("k").cast("string")).alias("model_version"),
        (F.lit(store.SNAPSHOT_TS).cast("timestamp_ntz") + F.make_interval(days=day.cast("int"))).alias("created_at"))


def _history(spark, sf_dir):
    _, s = _base(spark, sf_dir)
    return score_history(s)


HIST_SQL = f"""hist AS (
 SELECT customer_id * 10 + k AS id, customer_id, CAST({fx('p', 5)} AS DECIMAL(6,5)) AS churn_probability,
   CASE WHEN {fx('p', 5)} >= 0.75 THEN 'critico' WHEN {fx('p', 5)} >= 0.55 THEN 'alto'
        WHEN {fx('p', 5)} >= 0.35 THEN 'medio' ELSE 'baixo' END AS risk_tier, archetype,
   archetype <> 'sleeping_dog' AS proactive_allowed, CAST(0.5 AS DECIMAL(6,5)) AS threshold,
   'v' || CAST(k AS VARCHAR) AS model_version,
   TIMESTAMP '2001-01-01 00:00:00' + to_days(CAST(CASE WHEN customer_id % 7 = 0 AND k = 3 THEN k - 1 ELSE k END AS INTEGER))
     AS created_at
 FROM (SELECT s.*, t.k, LEAST(GREATEST(s.churn_probability + CAST(t.k - 3 AS DOUBLE) * CAST(0.01 AS DOUBLE), 0.0), 1.0) AS p
       FROM scored s, (SELECT CAST(range AS INTEGER) AS k FROM range(1, 4)) t WHERE s.customer_id % 17 <> 0)),
latest AS (SELECT * FROM (SELECT h.*, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY created_at DESC, id DESC) AS rn
                          FROM hist h) WHERE rn = 1)"""


def _hist_sql(body: str) -> str:
    return with_members(f"SELECT * FROM (WITH {HIST_SQL} {body})", scored=True)


_HIST_COLS = ("id, customer_id, CAST(churn_probability AS DOUBLE) AS churn_probability, risk_tier, archetype, "
              "proactive_allowed, CAST(threshold AS DOUBLE) AS threshold, model_version, created_at")


def _hist_out(df):
    return df.select("id", "customer_id", F.col("churn_probability").cast("double"), "risk_tier", "archetype",
                     "proactive_allowed", F.col("threshold").cast("double"), "model_version", "created_at")


@register("s8_s12_s13_score_history", _hist_sql(f"SELECT {_HIST_COLS} FROM hist"))
def q_score_history(spark, sf_dir):
    """Write the history partitioned by model_version (dynamic partition
    overwrite: re-running replaces the same partitions), read it back in full."""
    path = scratch_path(spark, f"store/{_tag(sf_dir)}/score")
    store.write_table(_history(spark, sf_dir), path, mode="overwrite", partition_by=["model_version"])
    return _hist_out(store.read_all(spark, path))


@register("s8_write_scores", with_members(
    "SELECT customer_id, CAST(churn_probability AS DOUBLE) AS churn_probability, risk_tier, archetype, archetype <> 'sleeping_dog' AS proactive_allowed, "
    "CAST(0.5 AS DOUBLE) AS threshold, 'scorecard-1' AS model_version, TIMESTAMP '2001-01-02 03:04:05' AS created_at FROM scored", scored=True))
def q_write_scores(spark, sf_dir):
    """One scoring of every member written as score rows of its model version and read back."""
    _, s = _base(spark, sf_dir)
    path = scratch_path(spark, f"store/{_tag(sf_dir)}/scored")
    at = F.lit("2001-01-02 03:04:05").cast("timestamp_ntz")
    store.write_table(store.score_rows(s, "scorecard-1", at, 0.5), path, mode="overwrite", partition_by=["model_version"])
    d = store.read_all(spark, path)
    return d.select("customer_id", F.col("churn_probability").cast("double"), "risk_tier", "archetype", "proactive_allowed",
                    F.col("threshold").cast("double"), "model_version", "created_at")


@register("w2_latest_score", _hist_sql(f"SELECT {_HIST_COLS} FROM latest"))
def q_latest_score(spark, sf_dir):
    return _hist_out(store.latest_per_key(_history(spark, sf_dir)))


@register("s7_f21_customer_roundtrip", with_members(
    "SELECT customer_id AS id, printf('VZ%04d', customer_id) AS external_ref, CAST(Churn AS TINYINT) AS true_churn, "
    + ", ".join(S.RAW_FEATURES) + " FROM members"))
def q_customer_roundtrip(spark, sf_dir):
    """S7 rows with the JSON features parsed back to a typed struct."""
    c = store.customer_rows(member_snapshot(spark, sf_dir))
    from ...functions.text import features_from_json
    return c.select("id", "external_ref", "true_churn", features_from_json("features", S.FEATURES_STRUCT).alias("f")) \
        .select("id", "external_ref", "true_churn", "f.*")


_J2_SQL = """
SELECT m.customer_id AS id, printf('VZ%04d', m.customer_id) AS external_ref, CAST(m.Churn AS TINYINT) AS true_churn,
  l.id AS score_id,
  CASE WHEN l.id IS NOT NULL THEN CAST(l.churn_probability AS DOUBLE) ELSE s.churn_probability END AS churn_probability,
  CASE WHEN l.id IS NOT NULL THEN l.risk_tier ELSE s.risk_tier END AS risk_tier,
  CASE WHEN l.id IS NOT NULL THEN l.archetype ELSE s.archetype END AS archetype,
  CASE WHEN l.id IS NOT NULL THEN l.proactive_allowed ELSE s.archetype <> 'sleeping_dog' END AS proactive_allowed,
  CASE WHEN l.id IS NOT NULL THEN l.model_version ELSE 'heuristic-fallback-0.1' END AS model_version,
  CASE WHEN l.id IS NOT NULL THEN 'model' ELSE 'heuristic' END AS source, 'heuristic' AS driver_source
FROM members m LEFT JOIN latest l ON l.customer_id = m.customer_id LEFT JOIN scored s ON s.customer_id = m.customer_id"""


def _listed(spark, sf_dir):
    m = member_snapshot(spark, sf_dir)
    s = linear_scorecard(m, keep=m.columns, with_drivers=False)
    latest = store.latest_per_key(score_history(s))
    customers = store.customer_rows(s, keep=("churn_probability", "risk_tier", "archetype"))
    return store.customers_with_latest_score(customers, latest)


@register("j1_j2_u3_customers_with_latest_score", _hist_sql(_J2_SQL))
def q_customers_latest(spark, sf_dir):
    return _listed(spark, sf_dir).select("id", "external_ref", "true_churn", "score_id", "churn_probability",
                                         "risk_tier", "archetype", "proactive_allowed", "model_version", "source",
                                         "driver_source")


@register("j4_unscored", _hist_sql(
    "SELECT customer_id AS id, printf('VZ%04d', customer_id) AS external_ref FROM members m "
    "WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.customer_id = m.customer_id)"))
def q_unscored(spark, sf_dir):
    m, s = _base(spark, sf_dir)
    return store.unscored(store.customer_rows(m), score_history(s)).select("id", "external_ref")


@register("s9_j3_score_explanations", _hist_sql(f"""
, {CONTRIB_SQL}, {RANKED_SQL}
SELECT l.customer_id, l.id AS score_id,
  CASE WHEN l.customer_id % 10 <> 0 THEN 'explanation' ELSE 'heuristic' END AS driver_source, d.drivers
FROM latest l JOIN (SELECT customer_id, string_agg(feature || '=' || printf('%.6f', {fx('shap', 6)}), ', ' ORDER BY step) AS drivers
                    FROM ranked WHERE step <= 6 GROUP BY customer_id) d USING (customer_id)"""))
def q_score_explanations(spark, sf_dir):
    """S9 explanation rows for every score (inner join: unscored members
    skipped), then J3: newest explanation of the newest score, scorecard
    drivers when there is none."""
    _, s = _base(spark, sf_dir)
    hist = score_history(s)
    # fixture: members with an id divisible by 10 have no explanation yet, so the fallback is used
    expl = store.explanation_rows(hist, s.filter(F.col("customer_id") % 10 != 0))
    j = store.score_with_latest_explanation(store.latest_per_key(hist), expl, s)
    drivers = F.array_join(F.transform("drivers", lambda d: F.concat(d.feature, F.lit("="), F.format_string("%.6f", fixed(d.shap_value, 6)))), ", ")
    return j.select("customer_id", "score_id", "driver_source", drivers.alias("drivers"))


def _requests(m):
    k = F.col("customer_id")
    key = (F.when(k % 11 == 0, F.concat(F.lit("VZ-missing-"), k.cast("string")))
           .when(k % 2 == 0, k.cast("string")).otherwise(store.external_ref(k)))
    return m.select(key.alias("key"))


@register("j5_p9_resolve_keys", with_members("""
SELECT r.key, COALESCE(a.customer_id, b.customer_id) AS customer_id FROM (
  SELECT CASE WHEN customer_id % 11 = 0 THEN 'VZ-missing-' || CAST(customer_id AS VARCHAR)
              WHEN customer_id % 2 = 0 THEN CAST(customer_id AS VARCHAR) ELSE printf('VZ%04d', customer_id) END AS key
  FROM members) r
LEFT JOIN members a ON regexp_full_match(r.key, '[0-9]+') AND TRY_CAST(r.key AS BIGINT) = a.customer_id
LEFT JOIN members b ON NOT regexp_full_match(r.key, '[0-9]+') AND r.key = printf('VZ%04d', b.customer_id)"""))
def q_resolve_keys(spark, sf_dir):
    m = member_snapshot(spark, sf_dir)
    return store.resolve_keys(_requests(m), store.customer_rows(m))


@register("p7_p12_o1_portfolio", _hist_sql(f"""
SELECT id, external_ref, churn_probability, risk_tier, archetype, proactive_allowed FROM ({_J2_SQL})
WHERE risk_tier = 'critico' AND archetype = 'desengajado_conteudo'"""))
def q_portfolio(spark, sf_dir):
    return store.portfolio(_listed(spark, sf_dir), tier="critico", archetype="desengajado_conteudo")


@register("p8_eligible", _hist_sql(f"""
SELECT risk_tier, COUNT(*) FILTER (WHERE proactive_allowed) AS eligible,
       COUNT(*) FILTER (WHERE NOT proactive_allowed) AS blocked FROM ({_J2_SQL}) GROUP BY risk_tier"""))
def q_eligible(spark, sf_dir):
    return _listed(spark, sf_dir).groupBy("risk_tier").agg(
        F.count_if(F.col("proactive_allowed")).alias("eligible"),
        F.count_if(~F.col("proactive_allowed")).alias("blocked"))


@register("o3_prediction_preview", with_members(
    f"SELECT customer_id AS id, {fx('p_raw', 4)} AS probability FROM scored ORDER BY customer_id LIMIT 500",
    scored=True))
def q_prediction_preview(spark, sf_dir):
    """First 500 predictions by id (the reference's by-position preview)."""
    from ...functions.core import fixed
    _, s = _base(spark, sf_dir)
    return s.orderBy("customer_id").limit(500).select(F.col("customer_id").alias("id"),
                                                      fixed("p_raw", 4).alias("probability"))


@register("s15_sample_rows", with_members(
    "SELECT customer_id, Churn FROM members ORDER BY md5(CAST(customer_id AS VARCHAR) || '|42'), customer_id LIMIT 400"))
def q_sample_rows(spark, sf_dir):
    """Exact-size deterministic sample of 400 members (the scatter read model)."""
    return sample_rows(member_snapshot(spark, sf_dir), 400).select("customer_id", "Churn")


@register("d8_s10_s11_apply_batch", _hist_sql(f"""
SELECT status, COUNT(*) AS interventions, COUNT(*) AS audit_rows FROM (
  SELECT CASE WHEN archetype = 'sleeping_dog' OR NOT proactive_allowed THEN 'bloqueada' ELSE 'aplicada' END AS status
  FROM ({_J2_SQL}) WHERE risk_tier IN ('alto', 'critico')) GROUP BY status"""))
def q_apply_batch(spark, sf_dir):
    """Select every alto/critico member of the listing, write interventions
    (S10) and their audit rows (S11, partitioned by day) to the shared
    folder, read both back and count per status."""
    from ...operators.decide import recommend
    listed = _listed(spark, sf_dir)
    _, s = _base(spark, sf_dir)
    drivers = s.select(F.col("customer_id").alias("_cid"), "top_drivers")
    elig = recommend(listed.join(drivers, listed.id == F.col("_cid")).drop("_cid"))
    selected = listed.filter(F.col("risk_tier").isin("alto", "critico")).select("id")
    inter, audit = store.apply_batch(selected, elig, at=F.lit(store.SNAPSHOT_TS).cast("timestamp_ntz"))
    base = scratch_path(spark, f"store/{_tag(sf_dir)}")
    store.write_table(inter, f"{base}/intervention", mode="overwrite")
    store.write_audit(audit, f"{base}/audit")
    i = store.read_all(spark, f"{base}/intervention", ["customer_id", "status"])
    a = store.read_all(spark, f"{base}/audit", ["entity_id", "payload"])
    a = a.select(F.col("entity_id").cast("bigint").alias("customer_id"),
                 F.get_json_object("payload", "$.status").alias("status"))
    ai = i.groupBy("status").agg(F.count(F.lit(1)).alias("interventions"))
    aa = a.groupBy("status").agg(F.count(F.lit(1)).alias("audit_rows"))
    return ai.join(aa, "status", "full")
