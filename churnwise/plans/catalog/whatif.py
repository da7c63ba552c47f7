"""Registered what-if, uplift and pick queries (Q1, Q3-Q6, Q13, Q14, O4, O5,
U1). The DuckDB twins evaluate the explicit member x candidate cross product
(brute force) and pick with ROW_NUMBER, independent of the array search."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ...functions.core import dbl
from ...operators import decide, whatif
from ...operators.scorecard import linear_scorecard
from ...sources.members import member_snapshot
from ..oracle_sql import _scorecard_terms_sql, fx, scorecard_logit_sql, sdiv, with_members
from ..registry import register
from .core import scored_members

MEMBER_KEEP = ["customer_id", "Churn", "churn_probability", "risk_tier", "archetype",
               "Avg_class_frequency_current_month", "Avg_class_frequency_total", "Contract_period",
               "Month_to_end_contract", "Lifetime", "Group_visits", "Avg_additional_charges_total", "Promo_friends",
               "Partner"]


def _scored(spark, sf_dir):
    """Members with their score: one pass over the snapshot, no join."""
    m = member_snapshot(spark, sf_dir)
    return linear_scorecard(m, keep=m.columns, with_drivers=False).select(*m.columns, "churn_probability", "risk_tier", "archetype", "p5")


def _grid_values(compat=False):
    return ", ".join(f"({li}, CAST({v!r} AS DOUBLE), {i})" for li, v, i in whatif.lever_grid(compat))


def _tier_sql(x):
    return (f"CASE WHEN {x} >= 0.75 THEN 'critico' WHEN {x} >= 0.55 THEN 'alto' WHEN {x} >= 0.35 THEN 'medio' "
            "ELSE 'baixo' END")


def _rank_sql(t):
    return f"CASE {t} WHEN 'baixo' THEN 0 WHEN 'medio' THEN 1 WHEN 'alto' THEN 2 WHEN 'critico' THEN 3 END"


def _cand_sql():
    vals = {
        "Avg_class_frequency_current_month": "CASE WHEN g.lever = 0 THEN g.v ELSE b.Avg_class_frequency_current_month END",
        "Group_visits": "CASE WHEN g.lever = 1 THEN g.v ELSE b.Group_visits END",
        "Contract_period": "CASE WHEN g.lever = 2 THEN g.v ELSE b.Contract_period END",
        "Month_to_end_contract": "CASE WHEN g.lever = 3 THEN g.v ELSE b.Month_to_end_contract END",
        "ratio_freq_atual_vs_lifetime":
            f"CASE WHEN g.lever = 0 THEN {fx(sdiv('g.v', 'b.Avg_class_frequency_total'), 3)} ELSE b.ratio3 END",
    }
    terms = _scorecard_terms_sql("b", vals)
    sim_new = fx(f"1.0 / (1.0 + EXP(-{scorecard_logit_sql(terms)}))", 5)
    frm = ("CASE g.lever WHEN 0 THEN b.Avg_class_frequency_current_month WHEN 1 THEN CAST(b.Group_visits AS DOUBLE) "
           "WHEN 2 THEN CAST(b.Contract_period AS DOUBLE) ELSE b.Month_to_end_contract END")
    return f"""
cand AS (SELECT b.customer_id, g.lever, g.v, g.ord, {frm} AS frm,
   LEAST(GREATEST(b.churn_probability + {sim_new} - b.churn_probability, 0.0), 1.0) AS projected FROM scored b,
   (VALUES {_grid_values()}) g(lever, v, ord)),
eff AS (SELECT *, {_tier_sql('projected')} AS to_tier,
   CASE WHEN lever = 0 THEN ABS(v - frm) / 5.0 WHEN lever = 3 THEN ABS(v - frm) / 12.0
        WHEN lever = 2 AND list_position([1.0, 3.0, 6.0, 12.0], frm) IS NOT NULL
             AND list_position([1.0, 3.0, 6.0, 12.0], v) IS NOT NULL
        THEN CAST(ABS(list_position([1.0, 3.0, 6.0, 12.0], v) - list_position([1.0, 3.0, 6.0, 12.0], frm)) AS DOUBLE)
        ELSE ABS(v - frm) END AS effort FROM cand),
best AS (SELECT * FROM (SELECT e.*, ROW_NUMBER() OVER (PARTITION BY e.customer_id ORDER BY e.effort, e.ord) AS rn
   FROM eff e JOIN scored s ON s.customer_id = e.customer_id
   WHERE e.v <> e.frm AND {_rank_sql('e.to_tier')} < {_rank_sql(_tier_sql('s.churn_probability'))}
     AND NOT (s.Lifetime > 6 AND s.Avg_class_frequency_current_month < 0.5)) WHERE rn = 1),
lev AS (SELECT s.customer_id, s.churn_probability AS real, {_tier_sql('s.churn_probability')} AS from_tier,
   (s.Lifetime > 6 AND s.Avg_class_frequency_current_month < 0.5) AS dog,
   CASE b.lever WHEN 0 THEN 'Avg_class_frequency_current_month' WHEN 1 THEN 'Group_visits'
        WHEN 2 THEN 'Contract_period' WHEN 3 THEN 'Month_to_end_contract' END AS lever_feature,
   b.frm AS from_value, b.v AS to_value, b.projected, b.to_tier, b.effort,
   CASE b.lever WHEN 0 THEN 'levar o membro a ~' || regexp_replace(printf('%.1f', {fx('b.v', 1)}), '\\.0$', '') || ' aulas por semana'
        WHEN 1 THEN CASE WHEN b.v >= 0.5 THEN 'incluir o membro nos desafios em grupo' ELSE 'tirar o membro dos desafios em grupo' END
        WHEN 2 THEN 'renovar para um plano de ' || CAST(CAST(FLOOR(b.v + 0.5) AS BIGINT) AS VARCHAR) || ' meses'
        WHEN 3 THEN 'trabalhar a renovação (' || CAST(CAST(FLOOR(b.v + 0.5) AS BIGINT) AS VARCHAR) || ' meses até o fim)'
   END AS human_action
   FROM scored s LEFT JOIN best b ON b.customer_id = s.customer_id)"""


UPLIFT_SQL = with_members(f"""
SELECT * FROM (WITH {_cand_sql()}
SELECT customer_id, from_tier, lever_feature, from_value, to_value, projected, to_tier, effort, human_action,
  CASE WHEN lever_feature IS NOT NULL THEN GREATEST(0.0, real - projected) ELSE 0.0 END AS uplift,
  CASE WHEN lever_feature IS NOT NULL THEN GREATEST(0.0, real - projected) ELSE 0.0 END * 712.0 AS expected_value,
  CASE WHEN dog THEN 'nao_intrusao' WHEN lever_feature IS NULL AND from_tier = 'baixo' THEN 'ja_baixo'
       WHEN lever_feature IS NULL THEN 'sem_alavanca' ELSE 'ok' END AS reason
FROM lev)""", scored=True)


def _uplift_df(spark, sf_dir):
    lev = whatif.cheapest_lever(_scored(spark, sf_dir))
    return whatif.uplift_proxy(lev)


@register("q4_q5_cheapest_lever_uplift", UPLIFT_SQL, bench=True)
def q_cheapest_lever(spark, sf_dir):
    return _uplift_df(spark, sf_dir).select(
        "customer_id", "from_tier", "lever_feature", "from_value", "to_value", "projected", "to_tier", "effort",
        "human_action", "uplift", "expected_value", "reason")


def _q1_sql():
    vals = {"Avg_class_frequency_current_month":
            "GREATEST(b.Avg_class_frequency_current_month, b.Avg_class_frequency_total)",
            "ratio_freq_atual_vs_lifetime": fx(sdiv("GREATEST(b.Avg_class_frequency_current_month, "
                                                    "b.Avg_class_frequency_total)", "b.Avg_class_frequency_total"), 3)}
    terms = _scorecard_terms_sql("b", vals)
    sim_new = fx(f"1.0 / (1.0 + EXP(-{scorecard_logit_sql(terms)}))", 5)
    return with_members(f"""
SELECT customer_id, sim_baseline, sim_new, projected,
       CAST(FLOOR((projected - churn_probability) * 100.0 + 0.5) AS INTEGER) AS delta_pp FROM (
  SELECT b.customer_id, b.churn_probability, b.churn_probability AS sim_baseline, {sim_new} AS sim_new,
         LEAST(GREATEST(b.churn_probability + {sim_new} - b.churn_probability, 0.0), 1.0) AS projected FROM scored b)""",
                        scored=True)


@register("q1_project_anchored", _q1_sql())
def q_project_anchored(spark, sf_dir):
    """Scenario: current frequency restored to the member's historical level."""
    s = _scored(spark, sf_dir)
    p = whatif.project_anchored(s, {"Avg_class_frequency_current_month":
                                    F.greatest(dbl("Avg_class_frequency_current_month"),
                                               dbl("Avg_class_frequency_total"))})
    return p.select("customer_id", "sim_baseline", "sim_new", "projected", "delta_pp")


@register("q3_lever_effort_summary", with_members(f"""
SELECT * FROM (WITH {_cand_sql()}
SELECT lever, COUNT(*) AS candidates, COUNT(*) FILTER (WHERE v <> frm) AS moves,
       {fx('SUM(effort)', 6)} AS total_effort, MAX(effort) AS max_effort FROM eff GROUP BY lever)""", scored=True))
def q_lever_effort(spark, sf_dir):
    """Q2 / Q3 over every member x candidate: candidate count, real moves and
    effort totals per lever (the grid is exploded from the literal array)."""
    s = _scored(spark, sf_dir)
    g = s.select(F.col("*"), F.explode(whatif._grid_col()).alias("c"))
    frm = whatif._from_value(F.col("c.lever"))
    e = g.select(F.col("c.lever").alias("lever"), F.col("c.v").alias("v"), frm.alias("frm"),
                 whatif.lever_effort(F.col("c.lever"), frm, F.col("c.v")).alias("effort"))
    from ...functions.core import fixed
    return e.groupBy("lever").agg(F.count(F.lit(1)).alias("candidates"),
                                  F.count_if(F.col("v") != F.col("frm")).alias("moves"),
                                  fixed(F.sum("effort"), 6).alias("total_effort"), F.max("effort").alias("max_effort"))


# O4 ------------------------------------------------------------------------
@register("o4_contrasting_pair", with_members(
    "SELECT (SELECT customer_id FROM scored ORDER BY churn_probability DESC, customer_id LIMIT 1) AS highest_id, "
    "(SELECT MAX(churn_probability) FROM scored) AS highest_p, "
    "(SELECT customer_id FROM scored ORDER BY churn_probability, customer_id LIMIT 1) AS lowest_id, "
    "(SELECT MIN(churn_probability) FROM scored) AS lowest_p", scored=True))
def q_contrasting_pair(spark, sf_dir):
    """Highest vs lowest risk member in one aggregation (ties: smaller id)."""
    _, s = scored_members(spark, sf_dir)
    return s.agg(F.min_by("customer_id", F.struct(-F.col("p5"), F.col("customer_id"))).alias("highest_id"),
                 F.max("churn_probability").alias("highest_p"),
                 F.min_by("customer_id", F.struct(F.col("p5"), F.col("customer_id"))).alias("lowest_id"),
                 F.min("churn_probability").alias("lowest_p"))


# O5 + U1 + Q6 ---------------------------------------------------------------
def representative_picks(s):
    """Two highest risks (ties by id), the first sleeping dog by id, the
    lowest-risk 'baixo' member (ties: the larger id); U1 keeps the first
    occurrence of each member. Whole rows with ``prio``: the highest two are a
    bounded top-k, the other two one aggregation, so nothing is written or
    joined back."""
    row = F.struct(*s.columns)
    top2 = s.orderBy(F.col("p5").desc(), "customer_id").limit(2).select(
        F.row_number().over(Window.orderBy(F.col("p5").desc(), "customer_id")).alias("prio"), row.alias("row"))
    dog, low = F.col("archetype") == "sleeping_dog", F.col("risk_tier") == "baixo"
    others = s.agg(F.min_by(row, F.when(dog, F.col("customer_id"))).alias("dog"),
                   F.min_by(row, F.when(low, F.struct(F.col("p5"), -F.col("customer_id")))).alias("low"))
    others = others.select(F.explode(F.array(F.struct(F.lit(3).alias("prio"), F.col("dog").alias("row")),
                                             F.struct(F.lit(4).alias("prio"), F.col("low").alias("row")))).alias("x")).select("x.*").where("row IS NOT NULL")
    picks = top2.unionByName(others)
    return picks.groupBy(F.col("row.customer_id").alias("_id")).agg(F.min("prio").alias("prio"), F.min_by("row", "prio").alias("row")).select("prio", "row.*")


@register("q6_uplift_panel", with_members(f"""
SELECT * FROM (WITH {_cand_sql()},
 top2 AS (SELECT customer_id, ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id) AS prio FROM scored
          ORDER BY churn_probability DESC, customer_id LIMIT 2),
 picks AS (SELECT customer_id, MIN(prio) AS prio FROM (
   SELECT * FROM top2
   UNION ALL SELECT MIN(customer_id), 3 FROM scored WHERE archetype = 'sleeping_dog' HAVING COUNT(*) > 0
   UNION ALL SELECT * FROM (SELECT customer_id, 4 FROM scored WHERE risk_tier = 'baixo'
                            ORDER BY churn_probability, customer_id DESC LIMIT 1)) GROUP BY customer_id)
SELECT p.prio, printf('VZ%04d', s.customer_id) AS ref, s.churn_probability AS real_prob, s.risk_tier AS tier,
  a.label AS archetype,
  CAST(FLOOR(CASE WHEN l.lever_feature IS NOT NULL THEN GREATEST(0.0, l.real - l.projected) ELSE 0.0 END * 100 + 0.5)
       AS INTEGER) AS uplift_pp,
  CASE WHEN NOT l.dog THEN l.human_action END AS action,
  CASE WHEN l.dog THEN 'nao_intrusao' WHEN l.lever_feature IS NULL AND l.from_tier = 'baixo' THEN 'ja_baixo'
       WHEN l.lever_feature IS NULL THEN 'sem_alavanca' ELSE 'ok' END AS reason
FROM picks p JOIN scored s ON s.customer_id = p.customer_id JOIN lev l ON l.customer_id = p.customer_id
JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in decide.ARCHETYPE_LABELS.items())}) a(k, label) ON a.k = s.archetype)""",
                                     scored=True))
def q_uplift_panel(spark, sf_dir):
    j = whatif.uplift_proxy(whatif.cheapest_lever(representative_picks(_scored(spark, sf_dir))))  # four rows at most
    return j.select("prio", F.format_string("VZ%04d", F.col("customer_id")).alias("ref"),
                    F.col("churn_probability").alias("real_prob"), F.col("risk_tier").alias("tier"),
                    decide.lookup(decide.ARCHETYPE_LABELS, F.col("archetype")).alias("archetype"),
                    F.floor(F.col("uplift") * 100 + 0.5).cast("int").alias("uplift_pp"),
                    F.col("recommended_action").alias("action"), "reason")


# Q13 / Q14 ------------------------------------------------------------------
@register("q13_assign_experiment", with_members(
    "SELECT arm, COUNT(*) AS members, CAST(SUM(Churn) AS BIGINT) AS churned FROM (SELECT *, CASE "
    "WHEN Lifetime > 6 AND Avg_class_frequency_current_month < 0.5 THEN NULL "
    "WHEN CAST(('0x' || SUBSTRING(md5(CAST(customer_id AS VARCHAR) || 'uplift-ab'), 1, 8)) AS BIGINT) "
    "% 2 = 0 THEN 'treatment' ELSE 'control' END AS arm FROM members) GROUP BY arm"))
def q_assign_experiment(spark, sf_dir):
    from ...sources.members import member_snapshot
    a = whatif.assign_experiment(member_snapshot(spark, sf_dir))
    return a.groupBy("arm").agg(F.count(F.lit(1)).alias("members"), F.sum("Churn").cast("bigint").alias("churned"))


_Q14_SQL = with_members(f"""
SELECT * FROM (WITH {_cand_sql()},
 u AS (SELECT l.customer_id, m.Churn AS y, CAST(FLOOR((CASE WHEN lever_feature IS NOT NULL THEN GREATEST(0.0, real - projected) ELSE 0.0 END) * 100000.0 + 0.5) AS BIGINT) AS s,
         CASE WHEN m.Lifetime > 6 AND m.Avg_class_frequency_current_month < 0.5 THEN NULL
              WHEN CAST(('0x' || SUBSTRING(md5(CAST(l.customer_id AS VARCHAR) || 'uplift-ab'), 1, 8)) AS BIGINT) % 2 = 0 THEN 't' ELSE 'c' END AS arm
       FROM lev l JOIN members m ON m.customer_id = l.customer_id),
 h AS (SELECT s, COUNT(*) FILTER (WHERE arm = 't') AS nt, COUNT(*) FILTER (WHERE arm = 'c') AS nc, SUM(y) FILTER (WHERE arm = 't') AS yt,
         SUM(y) FILTER (WHERE arm = 'c') AS yc FROM u WHERE arm IS NOT NULL GROUP BY s),
 c AS (SELECT *, SUM(nt + nc) OVER (ORDER BY s DESC) AS cum_n, SUM(nt + nc) OVER () AS n FROM h),
 g AS (SELECT CAST(LEAST(10, CEIL(CAST(cum_n AS DOUBLE) * 10.0 / n)) AS INTEGER) AS decile, SUM(nt) AS nt, SUM(nc) AS nc, SUM(yt) AS yt, SUM(yc) AS yc FROM c GROUP BY 1)
SELECT decile, CAST(nt AS BIGINT) AS nt, CAST(nc AS BIGINT) AS nc, CASE WHEN nc > 0 THEN yc / nc END - CASE WHEN nt > 0 THEN yt / nt END AS uplift,
  COALESCE(SUM(yc) OVER w / SUM(nc) OVER w, 0.0) * SUM(nt) OVER w - COALESCE(SUM(yt) OVER w, 0) AS qini
FROM g WINDOW w AS (ORDER BY decile ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""", scored=True)


@register("q14_uplift_eval", _Q14_SQL)
def q_uplift_eval(spark, sf_dir):
    """Per uplift-proxy decile: observed churn difference between arms and
    cumulative Qini (needs a real experiment to mean anything; on the fixture
    the arms are a hash split, so it is a plumbing check)."""
    u = _uplift_df(spark, sf_dir)
    a = whatif.assign_experiment(u)
    return whatif.uplift_eval(a)


@register("f17_narrate_cheapest_lever", None)
def q_narrate(spark, sf_dir):
    """The cheapest lever of every member applied as an
    override, re-scored, and narrated with the simulated top driver."""
    from ...operators.scorecard import linear_scorecard
    lev = whatif.cheapest_lever(_scored(spark, sf_dir))
    feat = F.col("lever_feature")
    over = {f: F.when(feat == f, F.col("to_value")).otherwise(F.col(f).cast("double"))
            for f in ("Avg_class_frequency_current_month", "Group_visits", "Contract_period", "Month_to_end_contract")}
    told = ["customer_id", "lever_feature", "lever_label", "to_value", "projected", "_real"]
    j = linear_scorecard(lev.withColumns(over), keep=told, top_k=1).withColumns({
        "_tf": F.col("top_drivers")[0]["feature"], "_up": F.col("top_drivers")[0]["shap_value"] >= 0})
    n = whatif.narrate_change(j, decide.lookup(decide.FEATURE_LABELS, F.col("_tf"), ""), F.col("_up"))
    return n.select("customer_id", "lever_feature", "to_value", "narration")
