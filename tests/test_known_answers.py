"""Known answers ported from the reference unit tests and FIXTURES §3."""

import pytest
from pyspark.sql import functions as F

from churnwise import schema as S
from churnwise.operators import evaluate as ev
from churnwise.operators import whatif
from churnwise.operators.scorecard import linear_scorecard

# Test rows: the reference's hand-written sample members (id, 13 raw features).
SAMPLES = [
    ("VZ-1042", 1, 1, 0, 0, 1, 1, 0, 24, 48.0, 1.0, 1, 1.1, 0.3),
    ("VZ-2098", 0, 1, 1, 1, 1, 12, 1, 33, 320.0, 9.0, 14, 2.6, 2.4),
    ("VZ-3071", 1, 0, 0, 0, 1, 6, 0, 41, 95.0, 2.0, 4, 2.2, 0.9),
    ("VZ-4115", 0, 1, 1, 0, 1, 12, 0, 52, 210.0, 7.0, 11, 1.4, 0.2),
    ("VZ-5230", 1, 1, 0, 1, 1, 6, 1, 28, 175.0, 4.0, 7, 2.9, 1.6),
    ("VZ-6087", 0, 0, 0, 0, 1, 1, 0, 36, 60.0, 1.0, 2, 1.8, 1.0),
    ("VZ-7194", 1, 1, 1, 1, 1, 12, 1, 45, 410.0, 11.0, 22, 3.1, 3.0),
    ("VZ-8256", 0, 1, 0, 0, 1, 6, 0, 31, 130.0, 3.0, 5, 2.4, 1.2),
]
EXPECTED = {  # p, tier, archetype, (to value, effort, projected) or None
    "VZ-1042": (0.99898, "critico", "early_dropper", (3.0, 0.54, 0.73744)),
    "VZ-2098": (0.09835, "baixo", "concorrente_driven", None),
    "VZ-3071": (0.99215, "critico", "desengajado_conteudo", (3.1, 0.44, 0.725)),
    "VZ-4115": (0.96447, "critico", "sleeping_dog", None),
    "VZ-5230": (0.88347, "critico", "desengajado_conteudo", (2.2, 0.12, 0.7368)),
    "VZ-6087": (0.99618, "critico", "desengajado_conteudo", (3.5, 0.50, 0.71918)),
    "VZ-7194": (0.01285, "baixo", "concorrente_driven", None),
    "VZ-8256": (0.98184, "critico", "desengajado_conteudo", (2.9, 0.34, 0.74227)),
}


@pytest.fixture(scope="module")
def samples(spark):
    cols = "ref string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FEATURES_STRUCT.fields)
    return spark.createDataFrame(SAMPLES, cols)


def test_scorecard_samples(samples):
    s = {r.ref: r for r in linear_scorecard(samples, keep=["ref"]).collect()}
    for ref, (p, tier, arch, _) in EXPECTED.items():
        assert (s[ref].churn_probability, s[ref].risk_tier, s[ref].archetype) == (p, tier, arch), ref


@pytest.mark.parametrize("compat", [False, True])
def test_cheapest_lever_samples(samples, compat):
    sc = linear_scorecard(samples, keep=["ref"], with_drivers=False).select("ref", "churn_probability")
    lev = {r.ref: r for r in whatif.cheapest_lever(samples.join(sc, "ref"), compat=compat).collect()}
    for ref, (_, _, _, want) in EXPECTED.items():
        r = lev[ref]
        if want is None:
            assert r.lever_feature is None, ref
        else:
            assert r.lever_feature == "Avg_class_frequency_current_month", ref
            assert r.to_value == pytest.approx(want[0]) and round(r.effort, 2) == pytest.approx(want[1])
            assert r.projected == pytest.approx(want[2], abs=1e-9) and r.to_tier == "alto"


def test_lever_effort_levels(spark):
    df = spark.range(1).select(
        whatif.lever_effort(F.lit(2), F.lit(1.0), F.lit(12.0)).alias("contract"),
        whatif.lever_effort(F.lit(0), F.lit(0.0), F.lit(2.5)).alias("freq"))
    r = df.first()
    assert r.contract == 3.0 and r.freq == 0.5


POINTS = [(0.9, 1), (0.8, 1), (0.6, 0), (0.3, 0), (0.2, 1)]


@pytest.fixture(scope="module")
def pts(spark):
    return ev.labeled_points(spark.createDataFrame(POINTS, "p double, Churn int"), p="p")


def test_confusion_and_roi(pts):
    r = ev.threshold_eval(ev.score_hist(pts), 0.5).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 1)
    assert r.recall == pytest.approx(2 / 3) and r.precision == pytest.approx(2 / 3) and r.fpr == 0.5
    assert r.roi == pytest.approx(2 * 0.35 * 712 - 3 * 40)


def test_best_roi_beats_grid(pts):
    h = ev.score_hist(pts)
    best = ev.best_roi_cutoff(h).first()
    def roi(c):  # brute force on the points
        tp = sum(1 for p, y in POINTS if p >= c and y == 1)
        fp = sum(1 for p, y in POINTS if p >= c and y == 0)
        return tp * 0.35 * 712 - (tp + fp) * 40
    assert best.roi == pytest.approx(max(roi(i / 100) for i in range(101)))
    sweep = {r.i: r for r in ev.confusion_grid(h, "roi", 101).collect()}
    for i in range(101):
        assert sweep[i].roi == pytest.approx(roi(i / 100)), i


def test_empty_points_give_zeros(spark):
    e = ev.labeled_points(spark.createDataFrame([], "p double, Churn int"), p="p")
    assert ev.brier(e).first().brier == 0.0


def test_calibration_bins(spark):
    pts = ev.labeled_points(spark.createDataFrame([(0.05, 0), (0.15, 0), (0.55, 1), (0.95, 1), (1.0, 1)],
                                                  "p double, Churn int"), p="p")
    b = {r.bin: r for r in ev.calibration_bins(pts, 10).collect()}
    assert b[9]["count"] == 2 and len(b) == 10
    assert b[3].predicted == pytest.approx(0.35) and b[3].observed == 0.0
    four = ev.labeled_points(spark.createDataFrame([(0.02, 0), (0.04, 0), (0.06, 1), (0.08, 0)],
                                                   "p double, Churn int"), p="p")
    b0 = ev.calibration_bins(four, 10).filter("bin = 0").first()
    assert b0.predicted == pytest.approx(0.05) and b0.observed == pytest.approx(0.25)


def test_brier(spark):
    pts = ev.labeled_points(spark.createDataFrame([(0.9, 1), (0.1, 0), (0.5, 1)], "p double, Churn int"), p="p")
    assert ev.brier(pts).first().brier == pytest.approx((0.01 + 0.01 + 0.25) / 3, abs=1e-6)


def test_auc_pairwise(spark):
    import random
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(300)]
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    pts = ev.labeled_points(spark.createDataFrame(rows, "p double, Churn int"), p="p")
    assert ev.rank_metrics(ev.score_hist(pts)).first().roc_auc == pytest.approx(want, abs=1e-12)
