"""Serving tables (S5-S13) and the joins / lookups that read them (J1-J5, W2,
P7-P12, O1, O3, U3, D8).

Tables are parquet directories; appends are partitioned (``model_version``
for scores, ``dt`` for audit) so readers prune partitions, and reloads use
dynamic partition overwrite, so a re-run replaces only what it rewrites.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.core import dbl, fixed

SNAPSHOT_TS = "2001-01-01 00:00:00"


def external_ref(key: Column | str = "customer_id") -> Column:
    """VZ + zero-padded id."""
    return F.format_string("VZ%04d", F.col(key) if isinstance(key, str) else key)


def customer_rows(members: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, external_ref, features as JSON, label kept for audit, and ``keep``."""
    feats = F.to_json(F.struct(*[F.col(c) for c in S.RAW_FEATURES]))
    return members.select(F.col("customer_id").alias("id"), external_ref().alias("external_ref"),
                          feats.alias("features"), F.col("Churn").cast("tinyint").alias("true_churn"),
                          F.lit(SNAPSHOT_TS).cast("timestamp_ntz").alias("created_at"), *keep)


def score_rows(scored: DataFrame, model_version: str, at: Column, threshold: float = S.DEFAULT_THRESHOLD) -> DataFrame:
    """Score rows of the scoring at the time ``at``; probability and threshold as DECIMAL(6,5)."""
    return scored.select(
        F.col("customer_id"), fixed("churn_probability", 5).cast("decimal(6,5)").alias("churn_probability"),
        "risk_tier", "archetype", (F.col("archetype") != "sleeping_dog").alias("proactive_allowed"),
        F.lit(threshold).cast("decimal(6,5)").alias("threshold"), F.lit(model_version).alias("model_version"),
        at.alias("created_at"))


def write_audit(audit: DataFrame, path: str) -> str | None:
    """Append audit rows by day. A failure never fails the action that is
    audited: it is logged and its message returned."""
    try:
        write_table(audit, path, mode="overwrite", partition_by=["dt"])
    except Exception as e:  # noqa: BLE001 - whatever the sink raises
        logging.getLogger(__name__).warning("audit rows not written: %s", e)
        return str(e)
    return None


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """S8/S10/S11/S12 sink. ``overwrite`` with partition columns replaces only
    the partitions present in ``df`` (dynamic partition overwrite), so a
    reload is idempotent and leaves other versions / days untouched."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_all(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """Full scan of a serving table with chosen columns (pruned at read)."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def latest_per_key(df: DataFrame, key: str = "customer_id", order: list[str] = ("created_at", "id")) -> DataFrame:
    """Newest row per key. One hash aggregate with ``max_by`` over the
    (created_at, id) ordering: partial aggregation keeps one row per key per
    task before the shuffle, so a key holding a third of all rows costs one
    row on the wire, not a third of the table."""
    cols = [c for c in df.columns]
    return (df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols if c != key]),
                                         F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select(key, "_r.*"))


def customers_with_latest_score(customers: DataFrame, latest: DataFrame) -> DataFrame:
    """Every customer with its newest persisted score, else the
    scorecard's; ``source`` says which. ``customers`` are the customer rows (S7)
    with the scorecard's churn_probability, risk_tier and archetype beside
    them, so the fallback needs no join. Listing drivers always come from the
    scorecard (``driver_source``), as in the reference."""
    l = latest.select(F.col("id").alias("score_id"), F.col("customer_id").alias("_lid"), dbl("churn_probability").alias("_lp"),
                      F.col("risk_tier").alias("_lt"), F.col("archetype").alias("_la"), F.col("proactive_allowed").alias("_lo"),
                      F.col("model_version").alias("_lv"))
    j = customers.join(l, customers.id == l._lid, "left")
    has = F.col("score_id").isNotNull()
    return j.select(
        "id", "external_ref", "true_churn", "score_id",
        F.when(has, F.col("_lp")).otherwise(F.col("churn_probability")).alias("churn_probability"),
        F.when(has, F.col("_lt")).otherwise(F.col("risk_tier")).alias("risk_tier"),
        F.when(has, F.col("_la")).otherwise(F.col("archetype")).alias("archetype"),
        F.when(has, F.col("_lo")).otherwise(F.col("archetype") != "sleeping_dog").alias("proactive_allowed"),
        F.when(has, F.col("_lv")).otherwise(F.lit(S.HEURISTIC_VERSION)).alias("model_version"),
        F.when(has, "model").otherwise("heuristic").alias("source"),
        F.lit("heuristic").alias("driver_source"))


def unscored(customers: DataFrame, scores: DataFrame, key: str = "id", score_key: str = "customer_id") -> DataFrame:
    """Customers without any score (anti join); ``scored_only`` is the
    semi join complement."""
    return customers.join(scores.select(F.col(score_key).alias("_k")).distinct(),
                          customers[key] == F.col("_k"), "left_anti")


def resolve_keys(requests: DataFrame, customers: DataFrame, key: str = "key") -> DataFrame:
    """An all-digit key matches the id, any other key the
    external_ref. Two equi joins and a coalesce: never an OR join (that would
    plan as a nested loop)."""
    digits = F.col(key).rlike("^[0-9]+$")
    by_id = customers.select(F.col("id").alias("_id1"), F.col("id").alias("_m1"))
    by_ref = customers.select(F.col("external_ref").alias("_ref2"), F.col("id").alias("_m2"))
    r = requests.withColumn("_num", F.when(digits, F.col(key).try_cast("bigint")))
    r = r.join(by_id, r._num == by_id._id1, "left").join(by_ref, (~digits) & (r[key] == by_ref._ref2), "left")
    return r.select(*requests.columns, F.coalesce("_m1", "_m2").alias("customer_id"))


def explanation_rows(scores: DataFrame, drivers: DataFrame) -> DataFrame:
    """One explanation per score (base value + sorted driver array); members
    without a score are skipped (inner join)."""
    d = drivers.select("customer_id", F.col("base_value"), F.col("top_drivers").alias("drivers"))
    return scores.select(F.col("id").alias("score_id"), "customer_id", "created_at").join(d, "customer_id", "inner") \
        .select(F.col("score_id") * 10 + 1, "score_id", "base_value", "drivers", "created_at") \
        .toDF("id", "score_id", "base_value", "drivers", "created_at")


def score_with_latest_explanation(latest: DataFrame, expl: DataFrame, fallback: DataFrame) -> DataFrame:
    """Newest explanation of the newest score; falls back to the scorecard
    drivers when there is none or its driver list is empty."""
    le = latest_per_key(expl, "score_id")
    j = latest.join(le.select("score_id", F.col("drivers").alias("_d"), "base_value"),
                    latest.id == F.col("score_id"), "left")
    fb = fallback.select(F.col("customer_id").alias("_fid"), F.col("top_drivers").alias("_fd"))
    j = j.join(fb, j.customer_id == fb._fid, "left")
    use = F.coalesce(F.size("_d"), F.lit(0)) > 0
    return j.select("customer_id", F.col("id").alias("score_id"),
                    F.when(use, F.col("_d")).otherwise(F.col("_fd")).alias("drivers"),
                    F.when(use, "explanation").otherwise("heuristic").alias("driver_source"))


def portfolio(df: DataFrame, tier: str = "todos", archetype: str = "todos") -> DataFrame:
    """Optional equality filters ('todos' = no filter), the
    listed projection, ordered by probability descending then id."""
    if tier != "todos":
        df = df.filter(F.col("risk_tier") == tier)
    if archetype != "todos":
        df = df.filter(F.col("archetype") == archetype)
    return df.select("id", "external_ref", "churn_probability", "risk_tier", "archetype", "proactive_allowed") \
        .orderBy(F.col("churn_probability").desc(), "id")


def apply_batch(selected: DataFrame, eligible: DataFrame, at: Column, actor: str = "batch") -> tuple[DataFrame, DataFrame]:
    """Interventions for the selected members that are eligible (semi
    join), with D7 status, and one audit row each (S11 payload as JSON),
    partitioned by the day of the action's time ``at``."""
    from ..operators.decide import intervention_status
    sel = eligible.join(selected.select(F.col("id").alias("_sid")), eligible.id == F.col("_sid"), "left_semi")
    inter = sel.select(F.col("id").alias("customer_id"), "archetype", "offer",
                       F.array_join("channel", ", ").alias("channel"), "copy", "timing",
                       intervention_status("archetype", "proactive_allowed").alias("status"))
    audit = inter.select(F.lit(actor).alias("actor"), F.lit("apply_intervention").alias("action"),
                         F.lit("intervention").alias("entity"), F.col("customer_id").cast("string").alias("entity_id"),
                         F.to_json(F.struct("archetype", "status", "offer")).alias("payload"),
                         at.cast("date").alias("dt"))
    return inter, audit
