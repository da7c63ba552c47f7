"""Exact quantiles by radix selection vs numpy (linear interpolation), the order-preserving bits vs the IEEE format, and
that nothing runs or depends on a group's size while the plan is built."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.operators.quantiles import exact_quantiles, order_bits, quantiles_long

P = [0.01, 0.25, 0.5, 0.75, 0.99]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(3, 20000), 2).tolist() + [5.0] * 5000 + [1.5, 2.5, 9.0]
    grp = [0 if i < 24000 else (1 if i < 25000 else 2) for i in range(len(vals))]  # sizes 24000 / 1000 / 3
    return vals, grp, spark.createDataFrame(list(zip(grp, vals)), "g int, v double")


def test_global(data):
    vals, _, df = data
    got = {r.q_idx: r.quantile for r in exact_quantiles(df, "v", P).collect()}
    for i, w in enumerate(np.quantile(np.array(vals), P)):
        assert got[i] == pytest.approx(w, abs=1e-12)


@pytest.mark.parametrize("groups", [None, 3])
def test_grouped(data, groups):
    vals, grp, df = data
    rows = exact_quantiles(df, "v", P, by=["g"], groups=groups).collect()
    assert len(rows) == 3 * len(P)
    for r in rows:
        sub = np.array([v for g, v in zip(grp, vals) if g == r.g])
        assert r.quantile == pytest.approx(np.quantile(sub, r.p), abs=1e-12)


def test_bits_have_the_order_of_the_values(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal(2000) * 10.0 ** rng.integers(-320, 308, 2000), [0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
                        1.7976931348623157e308, float("inf"), float("-inf"), 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2), -1.0, 0.1, 0.3, 1e22, -1e-300],
                        2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1000, 1024), 0)])
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", order_bits(F.col("x")).alias("k")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.k == (-bits - 1 if r.x < 0 else bits), r.x


def test_odd_values(spark):
    rows = [("a", -1.5), ("a", 2.0), ("a", None), (None, 3.0), (None, 4.0), ("b", None), ("c", 1e300), ("c", -1e300), ("c", 0.0), ("c", -0.0), ("d", 5e-324)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.p): r.quantile for r in exact_quantiles(df, "v", [0.0, 0.5, 1.0], by=["g"]).collect()}
    assert got == {("a", 0.0): -1.5, ("a", 0.5): 0.25, ("a", 1.0): 2.0, (None, 0.0): 3.0, (None, 0.5): 3.5, (None, 1.0): 4.0, ("c", 0.0): -1e300, ("c", 0.5): 0.0,
                   ("c", 1.0): 1e300, ("d", 0.0): 5e-324, ("d", 0.5): 5e-324, ("d", 1.0): 5e-324}
    assert exact_quantiles(df.where("g = 'z'"), "v", [0.5]).collect() == []


def test_no_job_while_the_plan_is_built(data, spark):
    _, _, df = data
    spark.sparkContext.setJobGroup("plan-only", "")
    quantiles_long(df, ["v", "g"], P)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only") == []
    spark.sparkContext.setJobGroup("rest", "")


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    from churnwise.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
