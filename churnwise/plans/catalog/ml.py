"""Registered preparation / model / attribution queries (M1-M23, H4, E2, E5,
A22-A25, A29, W3, W8, S5, S6).

Training is not expressible in SQL, so most of these are rows-only checks;
the parameter table, split/fold/weight assignment and the reference-driver
ranking have DuckDB twins. The trained bundle is memoised per session and
scale-factor folder, so the queries that read it train once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schema as S
from ...functions.core import fixed, with_derived_features
from ...operators import attribution as at
from ...operators import clusters, ml, treesql, tuning
from ...session import stored
from ...sources.members import member_snapshot, sample_rows
from ..oracle_sql import fx, sdiv, with_members
from ..registry import register


class _Row(dict):
    """A dict with Row.asDict(), for per-feature reference values."""

    def asDict(self):
        return dict(self)

_CACHE: dict = {}


def _key(spark, sf_dir, what):
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


def members(spark, sf_dir):
    """The members as a stored table: training, scoring and attribution read the same one."""
    k = _key(spark, sf_dir, "members")
    if k not in _CACHE:
        _CACHE[k] = stored(member_snapshot(spark, sf_dir), "members")
    return _CACHE[k]


def trained(spark, sf_dir):
    k = _key(spark, sf_dir, "model")
    if k not in _CACHE:
        _CACHE[k] = ml.train_model(members(spark, sf_dir))
    return _CACHE[k]


def attributions(spark, sf_dir):
    k = _key(spark, sf_dir, "attr")
    if k not in _CACHE:
        model, _ = trained(spark, sf_dir)
        trees, weights = at.extract_trees(model.trees, spark)
        _CACHE[k] = (trees, weights)
    return _CACHE[k]


def _hash_sql(key: str, salt: str) -> str:
    return (f"CAST(CAST(('0x' || SUBSTRING(md5(CAST({key} AS VARCHAR) || '|{salt}|42'), 1, 8)) AS BIGINT) AS DOUBLE) "
            "/ 4294967296.0")


_U = {i: f"QUANTILE_CONT(u, {p}) OVER (PARTITION BY Churn)" for i, p in enumerate((0.7, 0.85))}
DERIVED = ("SELECT * EXCLUDE (u, v), " + f"CASE WHEN u < {_U[0]} THEN 'train' WHEN u < {_U[1]} THEN 'val' ELSE 'test' END AS split, "
           "CAST(" + " + ".join(f"CAST(v >= QUANTILE_CONT(v, {i / 5}) OVER (PARTITION BY Churn) AS INTEGER)" for i in range(1, 5))
           + f" AS INTEGER) AS fold FROM (SELECT m.*, {sdiv('Avg_class_frequency_current_month', 'Avg_class_frequency_total')} "
           "AS ratio_freq_atual_vs_lifetime, Avg_class_frequency_current_month - Avg_class_frequency_total AS delta_freq, "
           "CAST(Contract_period AS DOUBLE) * CAST(Lifetime AS DOUBLE) AS contract_x_lifetime, "
           f"{_hash_sql('customer_id', 'split')} AS u, {_hash_sql('customer_id', 'fold')} AS v FROM members m) m")


@register("m6_m7_m8_split_folds_weights", with_members(f"""
SELECT split, fold, Churn, COUNT(*) AS n, MAX(w.weight) AS weight FROM ({DERIVED}) d
JOIN (SELECT Churn AS c, SUM(COUNT(*)) OVER () / (2.0 * COUNT(*)) AS weight FROM ({DERIVED}) t WHERE split = 'train' GROUP BY Churn) w
  ON w.c = d.Churn GROUP BY split, fold, Churn"""))
def q_split_folds(spark, sf_dir):
    d = ml.split_and_folds(member_snapshot(spark, sf_dir))
    d = ml.class_weights(d, fit_on=d.filter(F.col("split") == "train"))
    return d.groupBy("split", "fold", "Churn").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))


def _prep_sql():
    feats = [f for f in S.model_feature_list() if f in S.NUMERIC_FEATURES + S.DERIVED_NUMERIC]
    parts = []
    for f in feats:
        if f in S.WINSORIZE_FEATURES:
            lo, hi = f"QUANTILE_CONT({f}, 0.01)", f"QUANTILE_CONT({f}, 0.99)"
            clip = f"LEAST(GREATEST(CAST({f} AS DOUBLE), b.lo), b.hi)"
            parts.append(
                f"SELECT '{f}' AS feature, {fx('b.lo', 6)} AS lower, {fx('b.hi', 6)} AS upper, "
                f"{fx(f'MEDIAN({clip})', 6)} AS median, {fx(f'AVG({clip})', 6)} AS mean, "
                f"{fx(f'STDDEV_POP({clip})', 6)} AS scale FROM t, (SELECT {lo} AS lo, {hi} AS hi FROM t) b "
                "GROUP BY b.lo, b.hi")
        else:
            x = f"CAST({f} AS DOUBLE)"
            parts.append(f"SELECT '{f}' AS feature, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper, "
                         f"{fx(f'MEDIAN({x})', 6)} AS median, {fx(f'AVG({x})', 6)} AS mean, "
                         f"{fx(f'CASE WHEN STDDEV_POP({x}) > 0 THEN STDDEV_POP({x}) ELSE 1.0 END', 6)} AS scale FROM t")
    return with_members(f"SELECT * FROM (WITH t AS (SELECT * FROM ({DERIVED}) WHERE split = 'train') "
                        + " UNION ALL ".join(parts) + ")")


@register("m1_m5_prep_params", _prep_sql())
def q_prep_params(spark, sf_dir):
    """Winsor bounds, median, mean and population std fitted on train only."""
    d = ml.prepare_members(member_snapshot(spark, sf_dir))
    prep = ml.fit_prep(d.filter(F.col("split") == "train"))
    t = prep.param_table(spark)
    return t.select("feature", *[fixed(c, 6).alias(c) for c in ("lower", "upper", "median", "mean", "scale")])


@register("m11_m13_m15_m17_m18_train_evaluate", None)
def q_train_evaluate(spark, sf_dir):
    """Boosted trees + calibration on train, cost threshold on validation,
    metrics per split and the train - test AUC gap."""
    model, scored = trained(spark, sf_dir)
    m = ml.split_metrics(scored, model.threshold)
    from pyspark.sql.window import Window
    all_ = Window.partitionBy()  # over the 3 split rows
    gap = (F.max(F.when(F.col("split") == "train", F.col("roc_auc"))).over(all_)
           - F.max(F.when(F.col("split") == "test", F.col("roc_auc"))).over(all_))
    return m.withColumns({"auc_gap": fixed(gap, 4),
                          "verdict": F.when(F.abs(gap) <= 0.05, "sem overfit relevante").otherwise("atenção: gap alto"),
                          "calibration": F.lit(model.calibrator.method)})


@register("m17_model_cost_threshold", None)
def q_model_threshold(spark, sf_dir):
    from ...operators import evaluate as ev
    _, scored = trained(spark, sf_dir)
    h = ev.score_hist(ev.labeled_points(scored.filter(F.col("split") == "val"), p="p_cal"))
    return ev.cost_threshold(h)


@register("m9_logistic_coefficients", None)
def q_logistic(spark, sf_dir):
    d = ml.prepare_members(member_snapshot(spark, sf_dir))
    prep = ml.fit_prep(d.filter(F.col("split") == "train"))
    x = prep.transform(d, ["customer_id", S.TARGET, "split"])
    lr = ml.fit_logistic(ml.class_weights(x.filter(F.col("split") == "train")))
    rows = [(f, float(c)) for f, c in zip(prep.output_order, lr.coefficients)]
    t = spark.createDataFrame(rows, "feature string, coefficient double")
    from ...functions.core import direction
    return t.select("feature", fixed("coefficient", 4).alias("coefficient"),
                    direction("coefficient", "risk").alias("direction"))


@register("m10_random_forest_importances", None)
def q_rf(spark, sf_dir):
    d = ml.prepare_members(member_snapshot(spark, sf_dir))
    prep = ml.fit_prep(d.filter(F.col("split") == "train"))
    x = prep.transform(d, ["customer_id", S.TARGET, "split"])
    rf = ml.fit_random_forest(x.filter(F.col("split") == "train"), n_trees=100)
    imp = rf.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(prep.output_order, imp)],
                                 "feature string, importance double").orderBy(F.col("importance").desc())


@register("m12_tune", None)
def q_tune(spark, sf_dir):
    """Successive halving over seeded trials by exact mean fold AUC (4 trials with few trees x 3 folds here)."""
    d = ml.prepare_members(member_snapshot(spark, sf_dir))
    prep = ml.fit_prep(d.filter(F.col("split") == "train"))
    train = prep.transform(d.filter(F.col("split") == "train"), ["customer_id", S.TARGET])
    space = tuning.SPACE | {"n_estimators": ("int", 10, 30)}
    res = tuning.tune(train, n_trials=4, k=3, space=space)
    return spark.createDataFrame([(t["trial"], t["rung"], t["trees"], t["folds"], t["max_depth"], float(t["learning_rate"]), float(t["mean_auc"]))
                                  for t in res["trials"]],
                                 "trial int, rung int, trees int, folds int, max_depth int, learning_rate double, mean_auc double")


@register("m19_leakage_probe", None)
def q_leakage(spark, sf_dir):
    return ml.leakage_probe(member_snapshot(spark, sf_dir))


def _segments(spark, sf_dir, k=4):
    key = _key(spark, sf_dir, f"kmeans{k}")
    if key not in _CACHE:
        x = stored(ml.scaled_features(member_snapshot(spark, sf_dir)), "segments")
        km = clusters.fit_kmeans(x, k)
        _CACHE[key] = (km, km.assign(x))
    return _CACHE[key]


@register("m20_m21_a22_w3_cluster_profile", None)
def q_cluster_profile(spark, sf_dir):
    km, pred = _segments(spark, sf_dir)
    prof = ml.cluster_profile(pred)
    return prof.withColumn("inertia", F.lit(km.inertia)) \
        .withColumn("silhouette", F.lit(float(ml.silhouette(pred))))


@register("a23_heatmap_normalized", None)
def q_heatmap(spark, sf_dir):
    _, pred = _segments(spark, sf_dir)
    return ml.heatmap_normalized(ml.cluster_profile(pred))


@register("a25_j10_cluster_risk_mix", None)
def q_cluster_risk(spark, sf_dir):
    """Cluster assignment and model probability on the same member rows."""
    _, pred = _segments(spark, sf_dir)
    _, scored = trained(spark, sf_dir)
    j = pred.select("customer_id", "cluster").join(scored.select("customer_id", "p_cal"), "customer_id")
    return ml.cluster_risk_mix(j, "p_cal")


# Importances of the rule baseline (feature, importance).
BASELINE_IMPORTANCE = {"Contract_period": 0.30, "Lifetime": 0.28, "Avg_class_frequency_current_month": 0.22,
                       "Month_to_end_contract": 0.12, "Group_visits": 0.08}
W8_FEATURES = S.LEGACY_FEATURES


def _w8_sql():
    refs = ", ".join(
        [f"(SELECT MEDIAN(CAST({c} AS DOUBLE)) FROM members) AS r_{c}" for c in S.LEGACY_NUMERIC]
        + [f"(SELECT CAST({c} AS DOUBLE) FROM members GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS r_{c}"
           for c in S.LEGACY_BINARY])
    rows = []
    for i, f in enumerate(W8_FEATURES):
        imp = BASELINE_IMPORTANCE.get(f, 0.0)
        v, r = f"CAST(m.{f} AS DOUBLE)", f"r.r_{f}"
        rows.append(f"SELECT m.customer_id, '{f}' AS feature, {imp!r} * GREATEST(ABS({v} - {r}) / GREATEST(ABS({r}), 1.0), "
                    f"0.2) AS score, {imp!r} AS importance, {i} AS idx FROM members m, ({'SELECT ' + refs}) r")
    return with_members(
        "SELECT customer_id, rank, feature FROM (SELECT customer_id, feature, ROW_NUMBER() OVER (PARTITION BY "
        "customer_id ORDER BY score DESC, importance DESC, idx) AS rank FROM (" + " UNION ALL ".join(rows)
        + ")) WHERE rank <= 3")


@register("w8_top3_reference_drivers", _w8_sql())
def q_top3_reference(spark, sf_dir):
    """Reference = medians / smallest modes of the base (A26), importances of
    the rule baseline; top 3 per member by (score, importance)."""
    m = member_snapshot(spark, sf_dir)
    from ...operators.quantiles import quantile_map
    med = quantile_map(m, S.LEGACY_NUMERIC, [0.5])
    modes = m.agg(*[F.mode(F.col(c).cast("double"), True).alias(c) for c in S.LEGACY_BINARY]).first().asDict()
    row = _Row({**{c: med[(c, 0.5)] for c in S.LEGACY_NUMERIC}, **modes})
    ref = row.asDict()  # one value per feature (bounded)
    t = ml.top3_reference_drivers(m, ref, BASELINE_IMPORTANCE, W8_FEATURES)
    return t.select("customer_id", F.posexplode("top_3_drivers").alias("pos", "d")).select(
        "customer_id", (F.col("pos") + 1).alias("rank"), F.col("d.feature").alias("feature"))


def _attr_df(spark, sf_dir):
    model, _ = trained(spark, sf_dir)
    trees, weights = attributions(spark, sf_dir)
    d = with_derived_features(members(spark, sf_dir))
    x = model.prep.transform(d, ["customer_id"] + model.prep.output_order)
    a = at.tree_attribution(x, trees, weights, model.prep.output_order)
    return model, d, x, a


@register("e2_tree_attribution_additivity", None)
def q_attr_check(spark, sf_dir):
    """base + sum(values) against 2 x the GBT margin on every member."""
    model, d, x, a = _attr_df(spark, sf_dir)
    marg = ml.margin_col(model.trees.transform(x)).select("customer_id", "margin")
    s = sum((F.col(f"phi_{f}") for f in model.prep.output_order), F.col("base_value"))
    j = a.join(marg, "customer_id")
    return j.agg(F.count(F.lit(1)).alias("members"),
                 F.max(F.abs(s - F.lit(2.0) * F.col("margin"))).alias("max_additivity_error"))


@register("h4_e3_d1_score_batch", None)
def q_score_batch(spark, sf_dir):
    """Batch scoring with calibrated probability, model tier, predicted flag,
    sorted drivers and the model archetype, for every member."""
    model, d, x, a = _attr_df(spark, sf_dir)
    drivers = at.driver_array(a, d.select("customer_id", *model.prep.output_order), model.prep.output_order)
    s = ml.score_batch(model, members(spark, sf_dir), drivers)
    return s.select("customer_id", "churn_probability", "risk_tier", "predicted_churn", "threshold", "model_version",
                    "archetype_model", F.array_join("top_drivers", ",").alias("top_drivers"))


@register("e5_a29_global_importance", None)
def q_global_importance(spark, sf_dir):
    model, d, x, a = _attr_df(spark, sf_dir)
    drivers = at.driver_array(a, d.select("customer_id", *model.prep.output_order), model.prep.output_order)
    return at.global_importance(drivers)


@register("e5_example_member", with_members("""SELECT customer_id, 17 AS steps FROM (
  SELECT customer_id, Avg_class_frequency_current_month AS f FROM members ORDER BY md5(CAST(customer_id AS VARCHAR) || '|42'), customer_id LIMIT 1000)
ORDER BY f, customer_id LIMIT 1"""))
def q_example_member(spark, sf_dir):
    """The example member of the sample of 1000, and the number of steps of its waterfall."""
    model, d, x, a = _attr_df(spark, sf_dir)
    drivers = at.driver_array(a, d.select("customer_id", *model.prep.output_order), model.prep.output_order)
    rows = at.example_member(drivers, d, sample_rows(d.select("customer_id"), 1000))
    return rows.groupBy("customer_id").agg(F.count(F.lit(1)).cast("int").alias("steps"))


@register("s5_m23_scoring_parity", """SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS missing, TRUE AS parity_ok FROM (
  SELECT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey HAVING COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-01-01') > 0)""")
def q_parity(spark, sf_dir):
    """Spark ML's path against the compiled one (parameter table, trees and curves as SQL expressions) on every member."""
    model, _ = trained(spark, sf_dir)
    d = with_derived_features(members(spark, sf_dir))
    a = model.scored(model.prep.transform(d, ["customer_id"]), "p_a").select("customer_id", "p_a")
    b = treesql.score_compiled(d, model.prep, [at.extract_trees(t, spark) for t in model.fold_trees], model.calibrator, ["customer_id"], "p_b")
    return ml.scoring_parity(a, b).select("n", "missing", "parity_ok")
