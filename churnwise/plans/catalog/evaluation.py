"""Registered evaluation queries (W4-W6, M14-M17, Q7-Q12) on scorecard scores.

The DuckDB twins recompute the statistics straight from the member points
(pairwise AUC, per-threshold precision), not from the histogram, so they
check the histogram rewrite as well as the arithmetic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import evaluate as ev
from ..oracle_sql import fx, with_members
from ..registry import register
from .core import scored_members

PTS = "pts AS (SELECT customer_id, FLOOR(p_raw * 100000.0 + 0.5) AS p5, Churn AS y FROM scored WHERE Churn IN (0, 1))"


def _with_pts(body: str, extra: str = "") -> str:
    return with_members(f"SELECT * FROM (WITH {PTS}{extra} {body})", scored=True)


def _points(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return ev.labeled_points(s, keep=["customer_id"])


def _hist(spark, sf_dir):
    return ev.score_hist(_points(spark, sf_dir))


@register("p6_score_hist", _with_pts(
    "SELECT p5, COUNT(*) FILTER (WHERE y = 1) AS n_pos, COUNT(*) FILTER (WHERE y = 0) AS n_neg FROM pts GROUP BY p5"))
def q_score_hist(spark, sf_dir):
    return _hist(spark, sf_dir)


_AUC = ("(SELECT CAST(SUM(CASE WHEN a.p5 > b.p5 THEN 2 WHEN a.p5 = b.p5 THEN 1 ELSE 0 END) AS DOUBLE) "
        "/ (2.0 * (SELECT COUNT(*) FROM pts WHERE y = 1) * (SELECT COUNT(*) FROM pts WHERE y = 0)) "
        "FROM pts a, pts b WHERE a.y = 1 AND b.y = 0)")
_AP = ("(SELECT SUM((SELECT COUNT(*) FROM pts q WHERE q.y = 1 AND q.p5 = t.p5) / (SELECT COUNT(*) FROM pts WHERE y = 1) "
       "* (SELECT COUNT(*) FROM pts q WHERE q.y = 1 AND q.p5 >= t.p5) / (SELECT COUNT(*) FROM pts q WHERE q.p5 >= t.p5)) "
       "FROM (SELECT DISTINCT p5 FROM pts WHERE y = 1) t)")
_LIFT = ("(SELECT (SUM(CASE WHEN LEAST(GREATEST(k - prev_n, 0), nb) > 0 THEN LEAST(GREATEST(k - prev_n, 0), nb) "
         "* np / nb ELSE 0.0 END) / MAX(k)) / (MAX(P) / MAX(n)) FROM (SELECT p5, np, nb, "
         "SUM(nb) OVER (ORDER BY p5 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - nb AS prev_n, "
         "GREATEST(1, CEIL(CAST((SELECT COUNT(*) FROM pts) AS DOUBLE) * 0.1)) AS k, "
         "(SELECT COUNT(*) FROM pts WHERE y = 1) AS P, (SELECT COUNT(*) FROM pts) AS n "
         "FROM (SELECT p5, COUNT(*) FILTER (WHERE y = 1) AS np, COUNT(*) AS nb FROM pts GROUP BY p5)))")


@register("w4_w6_rank_metrics", _with_pts(
    f"SELECT (SELECT COUNT(*) FROM pts) AS n, (SELECT COUNT(*) FROM pts WHERE y = 1) AS positives, "
    f"{_AUC} AS roc_auc, {fx(_AP, 9)} AS pr_auc, {fx(_LIFT, 9)} AS lift"), bench=True)
def q_rank_metrics(spark, sf_dir):
    return ev.rank_metrics(_hist(spark, sf_dir))


def _confusion_sql(cut_expr_table: str, select_extra: str = "") -> str:
    return (f"SELECT g.i, g.cutoff, COUNT(*) FILTER (WHERE p5 / 100000.0 >= g.cutoff AND y = 1) AS tp, "
            "COUNT(*) FILTER (WHERE p5 / 100000.0 >= g.cutoff AND y = 0) AS fp, "
            "COUNT(*) FILTER (WHERE p5 / 100000.0 < g.cutoff AND y = 1) AS fn, "
            "COUNT(*) FILTER (WHERE p5 / 100000.0 < g.cutoff AND y = 0) AS tn "
            f"FROM {cut_expr_table} g, pts GROUP BY g.i, g.cutoff")


def _cm_cols(src: str, keep: str = "i, cutoff") -> str:
    return (f"SELECT {keep}, tp, fp, fn, tn, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall, "
            "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, "
            "CASE WHEN fp + tn = 0 THEN 0.0 ELSE fp / (fp + tn) END AS fpr, tp + fp AS flagged, "
            f"CAST(tp AS DOUBLE) * 0.35 * 712.0 - CAST(tp + fp AS DOUBLE) * 40.0 AS roi FROM ({src})")


@register("q7_threshold_eval", _with_pts(_cm_cols(_confusion_sql("(SELECT 0 AS i, 0.5 AS cutoff)"), "cutoff")))
def q_threshold_eval(spark, sf_dir):
    return ev.threshold_eval(_hist(spark, sf_dir), 0.5)


_ROI_GRID = "(SELECT CAST(range AS INTEGER) AS i, range / 100.0 AS cutoff FROM range(101))"
_SWEEP_GRID = "(SELECT CAST(range AS INTEGER) AS i, range / 50.0 AS cutoff FROM range(51))"
_COST_GRID = ("(SELECT CAST(range AS INTEGER) AS i, CASE WHEN range = 180 THEN 0.95 "
              "ELSE CAST(range AS DOUBLE) * ((0.95 - 0.05) / 180) + 0.05 END AS cutoff FROM range(181))")


@register("q8_threshold_sweep", _with_pts(
    f"SELECT i, {fx('cutoff', 2)} AS cutoff, recall, precision FROM ({_cm_cols(_confusion_sql(_SWEEP_GRID))})"))
def q_threshold_sweep(spark, sf_dir):
    return ev.threshold_sweep(_hist(spark, sf_dir), 51)


@register("q9_best_roi_cutoff", _with_pts(
    f"SELECT cutoff, tp, fp, fn, tn, recall, precision, fpr, flagged, roi FROM ({_cm_cols(_confusion_sql(_ROI_GRID))}) "
    "ORDER BY roi DESC, i LIMIT 1"))
def q_best_roi_cutoff(spark, sf_dir):
    return ev.best_roi_cutoff(_hist(spark, sf_dir))


@register("m17_cost_threshold", _with_pts(
    f"SELECT {fx('cutoff', 4)} AS threshold, {fx('cost', 2)} AS expected_cost, {fx('recall', 4)} AS recall_at_threshold, "
    "0.7 AS constraint_recall_min, (SELECT MAX(CASE WHEN recall >= 0.7 THEN 1 ELSE 0 END) FROM c) = 1 "
    "AS feasible_region_nonempty, i IN (0, 180) AS at_grid_edge FROM c "
    "ORDER BY CASE WHEN recall >= 0.7 THEN 0 ELSE 1 END, cost, recall DESC, i LIMIT 1",
    extra=f", c AS (SELECT *, fn * 10.0 + fp * 2.0 + tp * 1.0 AS cost FROM ({_cm_cols(_confusion_sql(_COST_GRID))}))"))
def q_cost_threshold(spark, sf_dir):
    return ev.cost_threshold(_hist(spark, sf_dir))


@register("m15_compute_metrics", _with_pts(
    f"SELECT {fx(_AUC, 4)} AS roc_auc, {fx(_AP, 4)} AS pr_auc, {fx('recall', 4)} AS recall, "
    f"{fx('precision', 4)} AS precision, "
    f"{fx('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END', 4)} AS f1, "
    f"{fx(_LIFT, 4)} AS lift_top_decile, 0.5 AS threshold, tp + fp + fn + tn AS n, "
    f"{fx('(tp + fn) / (tp + fp + fn + tn)', 4)} AS positive_rate "
    f"FROM ({_cm_cols(_confusion_sql('(SELECT 0 AS i, 0.5 AS cutoff)'))})"), bench=True)
def q_compute_metrics(spark, sf_dir):
    return ev.compute_metrics(_hist(spark, sf_dir), 0.5)


@register("m16_classification_report", _with_pts("""
SELECT class, {p}, {r}, {f}, support FROM (
 SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m
 UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
 UNION ALL SELECT 'accuracy', NULL, NULL, acc, s0 + s1 FROM m
 UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m
 UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
        (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM m)""".format(
    p=fx("precision", 4) + " AS precision", r=fx("recall", 4) + " AS recall", f=fx("f1_score", 4) + " AS f1_score"),
    extra=""",
 c AS (SELECT COUNT(*) FILTER (WHERE p5 / 100000.0 >= 0.5 AND y = 1) AS tp,
              COUNT(*) FILTER (WHERE p5 / 100000.0 >= 0.5 AND y = 0) AS fp,
              COUNT(*) FILTER (WHERE p5 / 100000.0 < 0.5 AND y = 1) AS fn,
              COUNT(*) FILTER (WHERE p5 / 100000.0 < 0.5 AND y = 0) AS tn FROM pts),
 r AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
              CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
              CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
              tn + fp AS s0, tp + fn AS s1,
              CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS acc FROM c),
 m AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
              CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM r)"""))
def q_classification_report(spark, sf_dir):
    return ev.classification_report(_points(spark, sf_dir), 0.5)


@register("q10_calibration_bins", _with_pts(
    "SELECT b.bin, b.bin / 10.0 AS lo, (b.bin + 1) / 10.0 AS hi, (b.bin / 10.0 + (b.bin + 1) / 10.0) / 2 AS mid, "
    "CASE WHEN COUNT(x.p5) > 0 THEN CAST(SUM(x.p5) AS DOUBLE) / COUNT(x.p5) / 100000.0 "
    "ELSE (b.bin / 10.0 + (b.bin + 1) / 10.0) / 2 END AS predicted, "
    "CASE WHEN COUNT(x.p5) > 0 THEN CAST(SUM(x.y) AS DOUBLE) / COUNT(x.p5) ELSE 0.0 END AS observed, "
    "COUNT(x.p5) AS count FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) b LEFT JOIN "
    "(SELECT p5, y, CAST(LEAST(GREATEST(FLOOR(p5 / 100000.0 * 10.0), 0), 9) AS INTEGER) AS bin FROM pts) x "
    "ON x.bin = b.bin GROUP BY b.bin"))
def q_calibration_bins(spark, sf_dir):
    return ev.calibration_bins(_points(spark, sf_dir), 10)


@register("q11_brier", _with_pts(
    f"SELECT COUNT(*) AS n, {fx('AVG(POWER(p5 / 100000.0 - y, 2))', 6)} AS brier FROM pts"))
def q_brier(spark, sf_dir):
    return ev.brier(_points(spark, sf_dir))


_SCEN = [(r, a, c) for r in (50, 70, 90) for a in (20, 35, 50) for c in (20.0, 40.0)]


@register("q12_campaign_roi", with_members(
    "SELECT archetype, at_risk, reach, accept_rate, cost_per, contacted, recovered, recovered * 712.0 AS preserved_revenue, "
    "contacted * cost_per AS total_cost, recovered * 712.0 - contacted * cost_per AS net, "
    "CASE WHEN contacted * cost_per > 0 THEN (recovered * 712.0 - contacted * cost_per) / (contacted * cost_per) "
    "ELSE 0.0 END AS roi FROM (SELECT *, CAST(FLOOR(contacted * accept_rate / 100.0 + 0.5) AS BIGINT) AS recovered "
    "FROM (SELECT a.archetype, a.at_risk, s.reach, s.accept_rate, s.cost_per, "
    "CAST(FLOOR(a.at_risk * s.reach / 100.0 + 0.5) AS BIGINT) AS contacted FROM "
    "(SELECT archetype, COUNT(*) FILTER (WHERE risk_tier IN ('alto', 'critico')) AS at_risk FROM scored "
    "GROUP BY archetype) a, (VALUES " + ", ".join(f"({r}, {a}, {c})" for r, a, c in _SCEN)
    + ") s(reach, accept_rate, cost_per)))", scored=True))
def q_campaign_roi(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    at_risk = s.groupBy("archetype").agg(F.count_if(F.col("risk_tier").isin("alto", "critico")).alias("at_risk"))
    return ev.campaign_roi(at_risk, _SCEN)
