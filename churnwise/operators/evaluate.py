"""Evaluation on labelled scores.

Scores are stored with 5 decimals, so at most 100,001 distinct values exist.
Every metric is computed from ``score_hist`` = one row per distinct score with
its positive and negative counts: one distributed partial aggregation over
the members, after which ROC-AUC, average precision, lift, confusion
matrices, sweeps, calibration and ROI only touch that bounded table. This is
the only table that enters unpartitioned windows, and it never grows with the
member count. Counts are exact integers, so most results are the same double
in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schema as S
from ..functions.core import dbl, fixed

SCALE = 100000.0


def labeled_points(scored: DataFrame, p: str = "churn_probability", y: str = S.TARGET,
                   keep: list[str] | None = None) -> DataFrame:
    """Keep labels in {0, 1}; project (p5 = score in 1e-5 units, y)."""
    keep = keep or []
    return scored.filter(F.col(y).isin(0, 1)).select(
        *keep, F.floor(dbl(p) * F.lit(SCALE) + F.lit(0.5)).alias("p5"), F.col(y).cast("int").alias("y"))


def score_hist(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., p5, n_pos, n_neg): the exact sufficient statistic of every metric."""
    by = by or []
    return points.groupBy(*by, "p5").agg(F.count_if(F.col("y") == 1).alias("n_pos"),
                                         F.count_if(F.col("y") == 0).alias("n_neg"))


def _cumulate(hist: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or []
    desc = Window.partitionBy(*by).orderBy(F.col("p5").desc()).rowsBetween(Window.unboundedPreceding,
                                                                            Window.currentRow)
    tot = Window.partitionBy(*by)
    return hist.select(
        *by, "p5", "n_pos", "n_neg",
        F.sum("n_pos").over(desc).alias("cum_pos"), F.sum("n_neg").over(desc).alias("cum_neg"),
        F.sum("n_pos").over(tot).alias("P"), F.sum("n_neg").over(tot).alias("N"))


def rank_metrics(hist: DataFrame, by: list[str] | None = None, decile: float = 0.1,
                 threshold: float | None = None) -> DataFrame:
    """ROC-AUC (ties count half), average precision (step-wise, no
    interpolation) and lift in the top ``decile`` (ties split pro rata)."""
    by = by or []
    c = _cumulate(hist, by)
    n = F.col("P") + F.col("N")
    k = F.greatest(F.lit(1), F.ceil(n.cast("double") * F.lit(decile)))
    prev_n = F.col("cum_pos") + F.col("cum_neg") - F.col("n_pos") - F.col("n_neg")
    take = F.least(F.greatest(k - prev_n, F.lit(0)), F.col("n_pos") + F.col("n_neg"))
    top_pos = F.when(take > 0, take.cast("double") * F.col("n_pos") / (F.col("n_pos") + F.col("n_neg")))
    auc2 = (F.col("n_neg").cast("decimal(38,0)")
            * (F.lit(2) * (F.col("cum_pos") - F.col("n_pos")) + F.col("n_pos")).cast("decimal(38,0)"))
    ap_term = F.when(F.col("n_pos") > 0, (F.col("n_pos") / F.col("P"))
                     * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))))
    extra = []
    if threshold is not None:  # confusion counts at one cut, in the same pass
        pos = F.col("p5").cast("double") / F.lit(SCALE) >= F.lit(float(threshold))
        extra = [F.sum(F.when(pos, F.col("n_pos")).otherwise(0)).alias("tp"),
                 F.sum(F.when(pos, F.col("n_neg")).otherwise(0)).alias("fp"),
                 F.sum(F.when(~pos, F.col("n_pos")).otherwise(0)).alias("fn"),
                 F.sum(F.when(~pos, F.col("n_neg")).otherwise(0)).alias("tn")]
    g = c.groupBy(*by).agg(
        F.first("P").alias("P"), F.first("N").alias("N"), F.sum(auc2).alias("auc2"),
        F.sum(ap_term).alias("ap"), F.sum(F.coalesce(top_pos, F.lit(0.0))).alias("top_pos"), F.first(k).alias("k"),
        *extra)
    return g.select(*[c_ for c_ in ("tp", "fp", "fn", "tn") if threshold is not None],
        *by, (F.col("P") + F.col("N")).alias("n"), F.col("P").alias("positives"),
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("auc2").cast("double") / (F.lit(2.0) * F.col("P") * F.col("N"))).alias("roc_auc"),
        fixed(F.col("ap"), 9).alias("pr_auc"),
        F.when(F.col("P") > 0, fixed((F.col("top_pos") / F.col("k")) / (F.col("P") / (F.col("P") + F.col("N"))), 9))
        .otherwise(F.lit(0.0)).alias("lift"))


COST_STEP = (0.95 - 0.05) / 180


def grid_cuts(kind: str = "roi", steps: int = 101) -> list[float]:
    """Threshold grids as doubles: ``roi`` i/(steps-1); ``cost`` 181 cuts
    0.05..0.95 built like numpy.linspace (i * step + start, last = stop)."""
    if kind == "cost":
        return [0.95 if i == 180 else i * COST_STEP + 0.05 for i in range(181)]
    return [i / (steps - 1) for i in range(steps)]


def cut_grid(spark: SparkSession, kind: str = "roi", steps: int = 101) -> DataFrame:
    cuts = grid_cuts(kind, steps)
    return spark.createDataFrame(list(enumerate(cuts)), "i int, cutoff double")


def _grid_index(p: Column, kind: str, steps: int) -> Column:
    """Largest grid index i with cut_i <= p (-1 when p is below every cut):
    an arithmetic guess, corrected by exact comparisons with the neighbouring
    cuts, so it agrees with ``p >= cut`` on every double."""
    if kind == "cost":
        n = 181
        cut = lambda j: F.when(j == 180, F.lit(0.95)).otherwise(j.cast("double") * F.lit(COST_STEP) + F.lit(0.05))
        guess = F.floor((p - F.lit(0.05)) / F.lit(COST_STEP))
    else:
        n = steps
        cut = lambda j: j.cast("double") / F.lit(float(steps - 1))
        guess = F.floor(p * F.lit(float(steps - 1)))
    g = F.least(F.greatest(guess, F.lit(-1)), F.lit(n - 1)).cast("int")
    up = (g + 1 <= n - 1) & (cut(g + 1) <= p)
    down = (g >= 0) & (cut(g) > p)
    return F.when(up, g + 1).when(down, g - 1).otherwise(g)


def confusion_grid(hist: DataFrame, kind: str = "roi", steps: int = 101, by: list[str] | None = None,
                   retention_cost: float = S.RETENTION_COST, churn_loss: float = S.CHURN_LOSS,
                   save_rate: float = S.SAVE_RATE) -> DataFrame:
    """M14 / Q7 for every cut of a grid: positive when p >= cut.
    Each histogram row falls in the bin of the highest cut it reaches; a
    group's bins (no more than cuts) are gathered in one array, and every cut
    adds up the bins on its either side. The histogram is made once, nothing is
    joined, and every table here is bounded by the grid size, not the member
    count."""
    by = by or []
    p = F.col("p5").cast("double") / F.lit(SCALE)
    bins = hist.groupBy(*by, _grid_index(p, kind, steps).alias("i")).agg(
        F.sum("n_pos").alias("_np"), F.sum("n_neg").alias("_nn"))
    one = bins.groupBy(*by).agg(F.collect_list(F.struct("i", F.col("_np").alias("np"), F.col("_nn").alias("nn"))).alias("_bins"))
    zero = F.lit(0).cast("long")
    total = lambda of, keep: F.aggregate(F.filter("_bins", keep), zero, lambda acc, x: acc + F.coalesce(x[of], zero))
    cuts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("cutoff")) for i, c in enumerate(grid_cuts(kind, steps))])
    rows = one.select(*by, F.explode(F.transform(cuts, lambda c: F.struct(
        c["i"].alias("i"), c["cutoff"].alias("cutoff"), total("np", lambda x: x["i"] >= c["i"]).alias("tp"),
        total("nn", lambda x: x["i"] >= c["i"]).alias("fp"), total("np", lambda x: x["i"] < c["i"]).alias("fn"),
        total("nn", lambda x: x["i"] < c["i"]).alias("tn")))).alias("g")).select(*by, "g.*")
    return confusion_columns(rows, retention_cost, churn_loss, save_rate)


def confusion_at(hist: DataFrame, cutoff: float, by: list[str] | None = None) -> DataFrame:
    """M14 at one cut: conditional sums over the histogram."""
    by = by or []
    pos = F.col("p5").cast("double") / F.lit(SCALE) >= F.lit(float(cutoff))
    g = hist.groupBy(*by).agg(F.sum(F.when(pos, F.col("n_pos")).otherwise(0)).alias("tp"),
                              F.sum(F.when(pos, F.col("n_neg")).otherwise(0)).alias("fp"),
                              F.sum(F.when(~pos, F.col("n_pos")).otherwise(0)).alias("fn"),
                              F.sum(F.when(~pos, F.col("n_neg")).otherwise(0)).alias("tn"))
    return g.withColumn("cutoff", F.lit(float(cutoff)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def confusion_columns(g: DataFrame, retention_cost=S.RETENTION_COST, churn_loss=S.CHURN_LOSS,
                      save_rate=S.SAVE_RATE) -> DataFrame:
    tp, fp, fn, tn = (F.col(c).cast("bigint") for c in ("tp", "fp", "fn", "tn"))
    return g.select(
        *[c for c in g.columns if c not in ("tp", "fp", "fn", "tn")],
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        _ratio(tp, tp + fn).alias("recall"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(fp, fp + tn).alias("fpr"), (tp + fp).alias("flagged"),
        (tp.cast("double") * F.lit(save_rate) * F.lit(churn_loss) - (tp + fp).cast("double") * F.lit(retention_cost))
        .alias("roi"))


def threshold_eval(hist: DataFrame, cutoff: float, **costs) -> DataFrame:
    """Q7 at one cut."""
    return confusion_columns(confusion_at(hist, cutoff), **costs)


def threshold_sweep(hist: DataFrame, steps: int = 51) -> DataFrame:
    """Q8: recall and precision for cuts i/(steps-1), cut shown with 2 decimals."""
    g = confusion_grid(hist, "roi", steps)
    return g.select("i", fixed("cutoff", 2).alias("cutoff"), "recall", "precision")


def best_roi_cutoff(hist: DataFrame, steps: int = 101, **costs) -> DataFrame:
    """The cut with maximum ROI; the first (lowest) cut wins ties."""
    g = confusion_grid(hist, "roi", steps, **costs)
    best = g.agg(F.min_by(F.struct(*g.columns), F.struct(-F.col("roi"), F.col("i"))).alias("b"))
    return best.select("b.*").drop("i")


def cost_threshold(hist: DataFrame, cost_fn: float = S.COST_FN, cost_fp: float = S.COST_FP,
                   cost_tp: float = S.COST_TP, min_recall: float = S.MIN_RECALL) -> DataFrame:
    """Over 181 cuts, minimise fn*10 + fp*2 + tp*1 among cuts with recall
    >= 0.70 (all cuts if none qualifies); ties by higher recall, then lower cut.
    Flags when the chosen cut sits on the grid edge."""
    g = confusion_grid(hist, "cost")
    g = g.withColumn("cost", F.col("fn") * F.lit(cost_fn) + F.col("fp") * F.lit(cost_fp) + F.col("tp") * F.lit(cost_tp))
    feasible = F.col("recall") >= min_recall
    a = g.agg(
        F.min_by(F.struct("cutoff", "cost", "recall", "i"),
                 F.struct((~feasible).cast("int"), F.col("cost"), -F.col("recall"), F.col("i"))).alias("b"),
        F.max(feasible.cast("int")).alias("feas"))
    return a.select(fixed("b.cutoff", 4).alias("threshold"), fixed("b.cost", 2).alias("expected_cost"),
                    fixed("b.recall", 4).alias("recall_at_threshold"), F.lit(min_recall).alias("constraint_recall_min"),
                    (F.col("feas") == 1).alias("feasible_region_nonempty"),
                    F.col("b.i").isin(0, 180).alias("at_grid_edge"))


def compute_metrics(hist: DataFrame, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """ROC-AUC, PR-AUC, recall, precision, F1, lift, n, positive rate,
    each rounded to 4 decimals like the reference report."""
    by = by or []
    j = confusion_columns(rank_metrics(hist, by, threshold=threshold))
    f1 = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return j.select(*by, fixed("roc_auc", 4).alias("roc_auc"), fixed("pr_auc", 4).alias("pr_auc"),
                    fixed("recall", 4).alias("recall"), fixed("precision", 4).alias("precision"),
                    fixed(f1, 4).alias("f1"), fixed("lift", 4).alias("lift_top_decile"),
                    F.lit(float(threshold)).alias("threshold"), F.col("n"),
                    fixed(F.col("positives") / F.col("n"), 4).alias("positive_rate"))


def classification_report(points: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and
    weighted averages (long form, one aggregation)."""
    pred = (F.col("p5").cast("double") / F.lit(SCALE) >= threshold).cast("int")
    a = points.agg(F.count_if((pred == 1) & (F.col("y") == 1)).alias("tp"),
                   F.count_if((pred == 1) & (F.col("y") == 0)).alias("fp"),
                   F.count_if((pred == 0) & (F.col("y") == 1)).alias("fn"),
                   F.count_if((pred == 0) & (F.col("y") == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1_1, f1_0 = _ratio(2 * p1 * r1, p1 + r1), _ratio(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    w = a.select(p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
                 p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"),
                 _ratio(tp + tn, n).alias("acc"), n.alias("n"))
    rows = w.selectExpr(
        "stack(5, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        "acc, n, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n, "
        "'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n) "
        "AS (class, precision, recall, f1_score, support)")
    return rows.select("class", *[fixed(c, 4).alias(c) for c in ("precision", "recall", "f1_score")], "support")


def calibration_bins(points: DataFrame, n_bins: int = 10) -> DataFrame:
    """Q10: bin = floor(p * n) clamped to [0, n-1]; mean p and observed rate per
    bin, empty bins show the midpoint and 0 (densified with a range join)."""
    p = F.col("p5").cast("double") / F.lit(SCALE)
    idx = F.least(F.greatest(F.floor(p * F.lit(float(n_bins))), F.lit(0)), F.lit(n_bins - 1)).cast("int")
    g = points.groupBy(idx.alias("_b")).agg(F.count(F.lit(1)).alias("count"), F.sum("p5").alias("sum_p5"),
                                             F.sum("y").alias("sum_y"))
    bins = points.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    j = bins.join(F.broadcast(g), bins.bin == g._b, "left")
    lo = F.col("bin") / F.lit(float(n_bins))
    hi = (F.col("bin") + 1) / F.lit(float(n_bins))
    cnt = F.coalesce(F.col("count"), F.lit(0))
    return j.select(
        "bin", lo.alias("lo"), hi.alias("hi"), ((lo + hi) / 2).alias("mid"),
        F.when(cnt > 0, F.col("sum_p5").cast("double") / cnt / F.lit(SCALE)).otherwise((lo + hi) / 2).alias("predicted"),
        F.when(cnt > 0, F.col("sum_y").cast("double") / cnt).otherwise(F.lit(0.0)).alias("observed"),
        cnt.cast("bigint").alias("count"))


def brier(points: DataFrame) -> DataFrame:
    """Q11: mean squared error of p, from exact integer squares."""
    d = (F.col("p5") - F.col("y") * F.lit(100000)).cast("decimal(38,0)")
    return points.agg(F.count(F.lit(1)).alias("n"), F.sum(d * d).alias("_s")).select(
        "n", F.when(F.col("n") > 0, fixed(F.col("_s").cast("double") / F.col("n") / F.lit(1e10), 6))
        .otherwise(F.lit(0.0)).alias("brier"))


def overfit_gap(metrics: DataFrame, split_col: str = "split", train: str = "train", test: str = "test",
                limit: float = 0.05) -> DataFrame:
    """Train minus test ROC-AUC with a verdict at ``limit``."""
    a = metrics.agg(F.max(F.when(F.col(split_col) == train, F.col("roc_auc"))).alias("train_auc"),
                    F.max(F.when(F.col(split_col) == test, F.col("roc_auc"))).alias("test_auc"))
    gap = F.col("train_auc") - F.col("test_auc")
    return a.select("train_auc", "test_auc", fixed(gap, 4).alias("auc_gap"),
                    F.when(F.abs(gap) <= limit, "sem overfit relevante").otherwise("atenção: gap alto").alias("verdict"))


# Campaign defaults (monthly revenue, LTV months, accept %, cost, reach %).
CAMPAIGN_DEFAULTS = {"avg_monthly_revenue": 89.0, "ltv_months": 8, "accept_rate": 35, "cost_per": 40.0, "reach": 70}


def campaign_roi(at_risk: DataFrame, scenarios: list[tuple[int, int, float]], avg_monthly_revenue: float = 89.0,
                 ltv_months: int = 8) -> DataFrame:
    """Q12: contacted, recovered, revenue, cost, net, roi for every scenario
    (reach %, accept %, cost per contact) against an at-risk count table
    (optionally per segment). The scenarios are a literal array exploded on
    each (small) at-risk row."""
    arr = F.array(*[F.struct(F.lit(r).alias("reach"), F.lit(a).alias("accept_rate"), F.lit(float(c)).alias("cost_per"))
                    for r, a, c in scenarios])
    j = at_risk.select("*", F.explode(arr).alias("_s")).select(*at_risk.columns, "_s.*")
    contacted = F.floor(F.col("at_risk") * F.col("reach") / F.lit(100.0) + F.lit(0.5))
    recovered = F.floor(F.col("contacted") * F.col("accept_rate") / F.lit(100.0) + F.lit(0.5))
    j = j.withColumn("contacted", contacted.cast("bigint")).withColumn("recovered", recovered.cast("bigint"))
    ltv = avg_monthly_revenue * ltv_months
    cost = F.col("contacted") * F.col("cost_per")
    net = F.col("recovered") * F.lit(ltv) - cost
    return j.select(*at_risk.columns, "reach", "accept_rate", "cost_per", "contacted", "recovered",
                    (F.col("recovered") * F.lit(ltv)).alias("preserved_revenue"), cost.alias("total_cost"),
                    net.alias("net"), F.when(cost > 0, net / cost).otherwise(F.lit(0.0)).alias("roi"))
