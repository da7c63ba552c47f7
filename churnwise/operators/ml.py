"""Preparation, training, calibration and batch scoring (M1-M13, M19-M23,
H4, A22-A25, W3, W8) on Spark ML.

* Splits and folds compare a hash of the member key with its quantiles in the
  class (radix selection: no sort, no window per class), so they scale and are
  stable across runs and engines.
* Preprocessing parameters are fitted on the training split only, in two
  aggregation passes, and kept as a small parameter table; applying them is
  plain column expressions (no UDF), identical in batch and streaming.
* Models are Spark ML estimators; metrics come from the exact score
  histogram (operators.evaluate), not the binned Spark evaluator.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.core import dbl, fixed, risk_tier, with_derived_features
from ..session import stored
from . import evaluate as ev
from .calibrate import Calibrator, add_margin, calibrators, fold_margin

SPLIT_SALT = "split"
FOLD_SALT = "fold"


def hash32(key: Column | str, seed: int = S.SEED, salt: str = SPLIT_SALT) -> Column:
    """The first 32 bits of md5(key|salt|seed)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat_ws("|", k.cast("string"), F.lit(salt), F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")


def hash01(key: Column | str, seed: int = S.SEED, salt: str = SPLIT_SALT) -> Column:
    """The same, uniform in [0, 1)."""
    return hash32(key, seed, salt).cast("double") / F.lit(4294967296.0)


def class_cuts(df: DataFrame, cuts: dict[str, list[float]], label: str = S.TARGET) -> DataFrame:
    """One row per class: ``_class`` and, for each column of hashes (``hash32``) in ``cuts``, an array named after it of
    the exact quantiles of the hash / 2^32 within the class. All hashes share one histogram of their upper 16 bits per
    class, and only its bins that hold a cut are refined (two passes of radix selection)."""
    from .quantiles import interpolated, radix_select
    probs = sorted({p for ps in cuts.values() for p in ps})
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("which"), F.col(c).alias("h")) for c in cuts]))
    d = df.select(F.col(label).alias("_class"), each.alias("_h")).select(
        "_class", F.col("_h.which").alias("_which"), F.col("_h.h").alias("_k"), (F.col("_h.h").cast("double") / F.lit(4294967296.0)).alias("_x"))
    q = interpolated(radix_select(d, ["_class", "_which"], probs, bits=32, groups=2 * len(cuts)), ["_class", "_which"], probs)
    return q.groupBy("_class").agg(*[
        F.array(*[F.max(F.when((F.col("_which") == c) & (F.col("q_idx") == probs.index(p)), F.col("quantile"))) for p in ps]).alias(c)
        for c, ps in cuts.items()])


def _with_cuts(df: DataFrame, hashes: dict[str, tuple[Column, list[float]]], label: str) -> DataFrame:
    """``df`` with each hash as ``_u<name>`` in [0, 1) and its class's cuts as ``_c<name>``."""
    keyed = df.withColumns({n: h for n, (h, _) in hashes.items()})
    cuts = class_cuts(keyed, {n: ps for n, (_, ps) in hashes.items()}, label).withColumnsRenamed({n: f"_c{n}" for n in hashes})
    out = keyed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")  # a row per class
    return out.withColumns({f"_u{n}": F.col(n).cast("double") / F.lit(4294967296.0) for n in hashes}).drop(*hashes)


def _split_of(fractions) -> tuple[Column, list[float]]:
    probs = [fractions[0], fractions[0] + fractions[1]]
    return F.when(F.col("_u_s") < F.col("_c_s")[0], "train").when(F.col("_u_s") < F.col("_c_s")[1], "val").otherwise("test"), probs


def _fold_of(k: int) -> tuple[Column, list[float]]:
    return F.size(F.filter("_c_f", lambda c: F.col("_u_f") >= c)), [i / k for i in range(1, k)]


def stratified_split(df: DataFrame, key: str = "customer_id", fractions=(0.70, 0.15, 0.15),
                     seed: int = S.SEED, label: str = S.TARGET) -> DataFrame:
    """M6: train / val / test with the given proportions in every class: a
    uniform hash of the key against its quantiles within the class."""
    split, probs = _split_of(fractions)
    return _with_cuts(df, {"_s": (hash32(key, seed), probs)}, label).withColumn("split", split).select(*df.columns, "split")


def assign_folds(df: DataFrame, k: int = S.KFOLDS, key: str = "customer_id", seed: int = S.SEED,
                 label: str = S.TARGET) -> DataFrame:
    """M7: fold id in [0, k), each with 1 / k of every class, by an independent
    hash of the key."""
    fold, probs = _fold_of(k)
    return _with_cuts(df, {"_f": (hash32(key, seed, FOLD_SALT), probs)}, label).withColumn("fold", fold).select(*df.columns, "fold")


def split_and_folds(df: DataFrame, k: int = S.KFOLDS, key: str = "customer_id", fractions=(0.70, 0.15, 0.15),
                    seed: int = S.SEED, label: str = S.TARGET) -> DataFrame:
    """M6 and M7 together: ``df`` is derived once, into a stored table; both hashes share the passes over it. What comes
    out is stored too, so that those who read it often do not look for the cuts each time."""
    df = stored(df, "split")
    (split, ps), (fold, pf) = _split_of(fractions), _fold_of(k)
    out = _with_cuts(df, {"_s": (hash32(key, seed), ps), "_f": (hash32(key, seed, FOLD_SALT), pf)}, label)
    return stored(out.withColumn("split", split).withColumn("fold", fold).select(*df.columns, "split", "fold"), "split-folds")


def class_weights(df: DataFrame, label: str = S.TARGET, fit_on: DataFrame | None = None) -> DataFrame:
    """M8: balanced weight n / (2 n_class) per row, counted over ``fit_on``
    (the training rows; ``df`` itself if not given): a 2-row aggregate,
    broadcast back; plus ``scale_pos_weight`` = neg / pos."""
    from pyspark.sql.window import Window
    c = (df if fit_on is None else fit_on).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    all_ = Window.partitionBy()  # over the 2 class rows only
    w = c.select(label, (F.sum("_nc").over(all_) / (F.lit(2.0) * F.col("_nc"))).alias("weight"),
                 (F.max(F.when(F.col(label) == 0, F.col("_nc"))).over(all_)
                  / F.max(F.when(F.col(label) == 1, F.col("_nc"))).over(all_)).alias("scale_pos_weight"))
    return df.join(F.broadcast(w), label, "left")


# ---------------------------------------------------------------------------
# M1-M5: preprocessing fitted on train only, as a parameter table.
# ---------------------------------------------------------------------------
@dataclass
class PrepModel:
    """Fitted preprocessing: numeric (winsorize -> median impute -> standardize
    with population std) then binary passthrough, in a fixed output order."""
    numeric: list[str]
    binary: list[str]
    params: dict[str, dict] = field(default_factory=dict)

    @property
    def output_order(self) -> list[str]:
        return self.numeric + self.binary

    def param_rows(self) -> list[tuple]:
        return [(f, p.get("lower"), p.get("upper"), p["median"], p["mean"], p["scale"])
                for f, p in self.params.items()]

    def param_table(self, spark) -> DataFrame:
        """M5: (feature, lower, upper, median, mean, scale)."""
        return spark.createDataFrame(self.param_rows(), "feature string, lower double, upper double, "
                                                        "median double, mean double, scale double")

    def columns(self) -> list[Column]:
        """M5 apply: the transformed feature columns as pure expressions."""
        out = []
        for f in self.numeric:
            p = self.params[f]
            x = dbl(f)
            if p.get("lower") is not None:
                x = F.least(F.greatest(x, F.lit(p["lower"])), F.lit(p["upper"]))
            x = F.coalesce(x, F.lit(p["median"]))
            out.append(((x - F.lit(p["mean"])) / F.lit(p["scale"])).alias(f"x_{f}"))
        out += [dbl(f).alias(f"x_{f}") for f in self.binary]
        return out

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        cols = self.columns()
        vec = VectorAssembler(inputCols=[f"x_{f}" for f in self.output_order], outputCol="features",
                              handleInvalid="keep")
        return vec.transform(df.select(*keep, *cols))


def fit_prep(train: DataFrame, features: list[str] | None = None,
             winsor: list[str] = S.WINSORIZE_FEATURES, pct: float = S.WINSORIZE_PERCENTILE,
             numeric: list[str] | None = None, binary: list[str] | None = None) -> PrepModel:
    """M1-M4: two aggregation passes over the training split.
    Pass 1: winsor bounds = np.percentile-style linear interpolation at
    pct and 100 - pct. Pass 2 (on clipped values): median, sum, sum of
    squares and counts, from which the imputed mean and population std follow."""
    features = features or S.model_feature_list()
    if numeric is None:
        numeric = [f for f in features if f in S.NUMERIC_FEATURES + S.DERIVED_NUMERIC]
    if binary is None:
        binary = [f for f in features if f in S.BINARY_FEATURES + S.DERIVED_BINARY]
    from .quantiles import quantile_map
    wcols = [f for f in numeric if f in winsor]
    b = {}
    if wcols:
        lo_p, hi_p = (100 - pct) / 100.0, pct / 100.0
        qm = quantile_map(train, wcols, [lo_p, hi_p])
        b = {f: (qm[(f, lo_p)], qm[(f, hi_p)]) for f in wcols}

    def clipped(f):
        x = dbl(f)
        return F.least(F.greatest(x, F.lit(b[f][0])), F.lit(b[f][1])) if f in b else x

    aggs = []
    for f in numeric:
        x = clipped(f)
        aggs += [F.sum(x).alias(f"{f}__s"), F.sum(x * x).alias(f"{f}__s2"), F.count(x).alias(f"{f}__k")]
    aggs.append(F.count(F.lit(1)).alias("__n"))
    r = train.agg(*aggs).first()
    meds = quantile_map(train.select(*[clipped(f).alias(f) for f in numeric]), numeric, [0.5]) if numeric else {}
    n = r["__n"]
    params = {}
    for f in numeric:
        med, s, s2, k = meds.get((f, 0.5)), r[f"{f}__s"] or 0.0, r[f"{f}__s2"] or 0.0, r[f"{f}__k"]
        med = med if med is not None else 0.0
        tot, tot2 = s + (n - k) * med, s2 + (n - k) * med * med
        mean = tot / n if n else 0.0
        var = max(tot2 / n - mean * mean, 0.0) if n else 0.0
        std = math.sqrt(var)
        params[f] = {"lower": b.get(f, (None, None))[0], "upper": b.get(f, (None, None))[1], "median": med,
                     "mean": mean, "scale": std if std > 0 else 1.0}
    return PrepModel(numeric, binary, params)


# ---------------------------------------------------------------------------
# Models.
# ---------------------------------------------------------------------------
def fit_logistic(train: DataFrame, n_train: int | None = None, weight: str | None = "weight", max_iter: int = 200):
    """M9: L2 logistic regression (C = 1 equivalent: regParam = 1 / n)."""
    n_train = n_train or train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=S.TARGET, maxIter=max_iter,
                            regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(train)


def fit_random_forest(train: DataFrame, n_trees: int = 200, max_depth: int = 8, seed: int = S.SEED):
    """Random forest; importances via ``featureImportances``."""
    return RandomForestClassifier(featuresCol="features", labelCol=S.TARGET, numTrees=n_trees, maxDepth=max_depth,
                                  seed=seed).fit(train)


GBT_DEFAULTS = {"maxIter": 60, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 1.0,
                "featureSubsetStrategy": "all", "minInstancesPerNode": 1}


def fit_boosted(train: DataFrame, params: dict | None = None, weight: str | None = "weight", seed: int = S.SEED):
    """Gradient boosted trees (log-loss); margin F(x) = sum of weighted
    trees and P(churn) = 1 / (1 + exp(-2 F))."""
    p = dict(GBT_DEFAULTS)
    p.update(params or {})
    g = GBTClassifier(featuresCol="features", labelCol=S.TARGET, seed=seed, **p)
    if weight:
        g = g.setWeightCol(weight)
    return g.fit(train)


def margin_col(pred: DataFrame, out: str = "margin") -> DataFrame:
    """GBT raw margin F(x) (rawPrediction = [-F, F])."""
    return pred.withColumn(out, vector_to_array("rawPrediction")[1])


def prob_col(pred: DataFrame, out: str = "p_model") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def auc_of(df: DataFrame, p: str, y: str = S.TARGET) -> float:
    pts = ev.labeled_points(df, p=p, y=y)
    return ev.rank_metrics(ev.score_hist(pts)).first().roc_auc


def pr_auc_of(df: DataFrame, p: str, y: str = S.TARGET) -> float:
    pts = ev.labeled_points(df, p=p, y=y)
    return ev.rank_metrics(ev.score_hist(pts)).first().pr_auc


@dataclass
class ChurnModel:
    """The trained bundle (S5): preprocessing, the trees of all training rows (attribution reads them), the k fold models
    whose calibrated probabilities are averaged, and the threshold."""
    prep: PrepModel
    trees: object
    fold_trees: list
    calibrator: Calibrator
    threshold: float
    version: str = S.MODEL_VERSION

    def scored(self, x: DataFrame, out: str = "p_cal") -> DataFrame:
        """``x`` (with ``features``) and the probability; the folds' margins are not kept."""
        for f, trees in enumerate(self.fold_trees):
            x = add_margin(x, trees, fold_margin(f))
        return self.calibrator.apply(x, out).drop(*map(fold_margin, range(len(self.fold_trees))))


def prepare_members(members: DataFrame) -> DataFrame:
    """Derived features (pipeline form, unrounded ratio) + split, each step a stored table: the passes that look for cuts
    and parameters, and those of a fit, scan it."""
    return stored(stratified_split(stored(with_derived_features(members), "derived")), "prepared")


def fit_folds(train: DataFrame, params: dict | None = None, k: int = S.KFOLDS) -> tuple[object, list, DataFrame]:
    """The model of all training rows, a model for each fold (column ``fold``) from the rows of the others,
    and the margins (fold, label, margin) of all rows by the model that has not seen them. The fits are independent and
    run as parallel Spark jobs."""
    with ThreadPoolExecutor(max_workers=k + 1) as pool:
        all_rows = pool.submit(fit_boosted, train, params)
        models = list(pool.map(lambda f: fit_boosted(train.filter(F.col("fold") != f), params), range(k)))
        trees = all_rows.result()
    oof = None
    for f, model in enumerate(models):
        part = add_margin(train.filter(F.col("fold") == f), model, "margin").select("fold", S.TARGET, "margin")
        oof = part if oof is None else oof.unionByName(part)
    return trees, models, oof


def train_model(members: DataFrame, params: dict | None = None, k: int = S.KFOLDS) -> tuple[ChurnModel, DataFrame]:
    """M6 -> M4 -> M11 -> M13 -> M17: fit on train, calibrate by k fold models, choose the calibration by PR-AUC and the
    cost threshold on validation. Returns the bundle and the scored member table with its split. What is read more than
    once is stored in the shared folder; nothing is cached."""
    d = split_and_folds(with_derived_features(members), k)
    prep = fit_prep(d.filter(F.col("split") == "train"))
    x = stored(prep.transform(d, ["customer_id", S.TARGET, "split", "fold"]).select("customer_id", S.TARGET, "split", "fold", "features"), "train")
    train = stored(class_weights(x.filter(F.col("split") == "train")), "train-weighted")  # weights of the training rows only
    trees, folds, oof = fit_folds(train, params, k)
    options = [ChurnModel(prep, trees, folds, c, S.DEFAULT_THRESHOLD) for c in calibrators(oof, k)]
    val = x.filter(F.col("split") == "val")
    model = max(options, key=lambda m: (pr_auc_of(m.scored(val), "p_cal"), m.calibrator.method == "sigmoid"))
    scored = stored(model.scored(add_margin(x, trees, "margin")).select("customer_id", S.TARGET, "split", "margin", "p_cal"), "scored")
    hist = ev.score_hist(ev.labeled_points(scored.filter(F.col("split") == "val"), p="p_cal"))
    model.threshold = ev.cost_threshold(hist).first().threshold
    return model, scored


def split_metrics(scored: DataFrame, threshold: float, p: str = "p_cal") -> DataFrame:
    """M15 per split + M18 overfit gap."""
    pts = ev.labeled_points(scored, p=p, keep=["split"])
    return ev.compute_metrics(ev.score_hist(pts, by=["split"]), threshold, by=["split"])


def score_batch(model: ChurnModel, members: DataFrame, drivers: DataFrame | None = None) -> DataFrame:
    """H4 / H5: derive -> preprocess -> tree margin -> calibrated probability
    -> tier (scheme model) -> predicted flag, one pass; drivers (E2) and the
    model archetype (D1) are joined on when given."""
    d = with_derived_features(members)
    keep = ["customer_id"] + [c for c in members.columns if c != "customer_id"] + S.DERIVED_NUMERIC + S.DERIVED_BINARY
    s = model.scored(add_margin(model.prep.transform(d, keep), model.trees, "margin"))
    s = s.withColumns({
        "churn_probability": fixed("p_cal", 5),
        "risk_tier": risk_tier("p_cal", "model"),
        "predicted_churn": (F.col("p_cal") >= F.lit(model.threshold)).cast("int"),
        "threshold": F.lit(model.threshold),
        "model_version": F.lit(model.version),
    }).drop("features")
    if drivers is not None:
        from .decide import archetype_model
        s = archetype_model(s.join(drivers, "customer_id", "left"), drivers="contributions")
    return s


# ---------------------------------------------------------------------------
# M19, M20-M21, A22-A25, W3, W8, M23
# ---------------------------------------------------------------------------
def leakage_probe(members: DataFrame, suspect: str = "Month_to_end_contract", test_frac: float = 0.30) -> DataFrame:
    """The same balanced logistic with and without the suspect column on
    one hash split; test AUC of each and the delta."""
    d = stored(with_derived_features(members).withColumn("split", F.when(hash01("customer_id") < 1 - test_frac, "train")
                                                         .otherwise("test")), "leakage")
    rows = []
    for label, feats in (("without", S.model_feature_list()), ("with", S.model_feature_list() + [suspect])):
        binary = [f for f in feats if f in S.BINARY_FEATURES + S.DERIVED_BINARY]
        numeric = [f for f in feats if f not in binary]
        prep = fit_prep(d.filter(F.col("split") == "train"), numeric=numeric, binary=binary)
        x = prep.transform(d, ["customer_id", S.TARGET, "split"])
        m = fit_logistic(class_weights(x.filter(F.col("split") == "train")))
        auc = auc_of(prob_col(m.transform(x.filter(F.col("split") == "test"))), "p_model")
        rows.append((label, float(auc)))
    spark = members.sparkSession
    t = spark.createDataFrame(rows, "variant string, test_auc double")
    return t.agg(F.max(F.when(F.col("variant") == "without", F.col("test_auc"))).alias("auc_without"),
                 F.max(F.when(F.col("variant") == "with", F.col("test_auc"))).alias("auc_with")) \
        .withColumn("delta_auc", fixed(F.col("auc_with") - F.col("auc_without"), 4))


def scaled_features(members: DataFrame, features: list[str] = S.LEGACY_FEATURES) -> DataFrame:
    """Standardised feature vector (population std) for clustering."""
    prep = PrepModel(list(features), [])
    aggs = []
    for f in features:
        aggs += [F.avg(dbl(f)).alias(f"{f}__m"), F.stddev_pop(dbl(f)).alias(f"{f}__s")]
    r = members.agg(*aggs).first()
    prep.params = {f: {"lower": None, "upper": None, "median": 0.0, "mean": r[f"{f}__m"],
                       "scale": r[f"{f}__s"] if r[f"{f}__s"] else 1.0} for f in features}
    return prep.transform(members, [c for c in members.columns])


def silhouette(pred: DataFrame) -> float:
    """Squared-Euclidean silhouette (Spark's linear-time form)."""
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(pred)


# Risk labels by churn-rate rank of the clusters.
RISK_LABELS = ["Alto Risco", "Risco Médio-Alto", "Risco Médio-Baixo", "Baixo Risco", "Muito Baixo Risco", "Estável"]


def cluster_profile(pred: DataFrame, features: list[str] = S.LEGACY_FEATURES) -> DataFrame:
    """A22 + W3: size, share, churn rate and feature means per cluster; risk
    label by churn-rate rank (the window runs over k <= 6 rows)."""
    from pyspark.sql.window import Window
    g = pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"),
                                    fixed(F.avg(dbl(S.TARGET)), 4).alias("churn_rate"),
                                    *[fixed(F.avg(dbl(f)), 3).alias(f) for f in features])
    w = Window.orderBy(F.col("churn_rate").desc(), "cluster")
    labels = F.array(*[F.lit(x) for x in RISK_LABELS])
    rk = F.row_number().over(w)
    return g.select("*", (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("share"),
                    F.when(rk <= len(RISK_LABELS), F.element_at(labels, rk))
                    .otherwise(F.concat(F.lit("Grupo "), rk.cast("string"))).alias("risk_label"),
                    F.concat(F.lit("Segmento "), (F.col("cluster") + 1).cast("string")).alias("label"))


def heatmap_normalized(profile: DataFrame, features: list[str] = S.LEGACY_FEATURES) -> DataFrame:
    """Min-max of cluster means per feature over the k-row profile; a
    zero span becomes 1."""
    from pyspark.sql.window import Window
    w = Window.partitionBy()
    cols = []
    for f in features:
        lo, hi = F.min(f).over(w), F.max(f).over(w)
        span = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
        cols.append(fixed((F.col(f) - lo) / span, 4).alias(f))
    return profile.select("cluster", *cols)


def cluster_risk_mix(pred: DataFrame, p: str = "p_model") -> DataFrame:
    """Mean probability and high / mid / low shares per cluster
    (cluster and probability are columns of the same row: no join)."""
    x = F.col(p)
    return pred.groupBy("cluster").agg(
        fixed(F.avg(x), 4).alias("avg_probability"),
        fixed(F.avg((x >= 0.7).cast("double")), 4).alias("high_risk_pct"),
        fixed(F.avg(((x >= 0.4) & (x < 0.7)).cast("double")), 4).alias("med_risk_pct"),
        fixed(F.avg((x < 0.4).cast("double")), 4).alias("low_risk_pct"))


def top3_reference_drivers(members: DataFrame, reference: dict[str, float], importance: dict[str, float],
                           features: list[str] = S.LEGACY_FEATURES) -> DataFrame:
    """Importance x max(|value - ref| / max(|ref|, 1), 0.2), top 3 by
    (score, importance) descending, with direction text. Reference values and
    importances are a few literals; per-row array sort, no shuffle."""
    structs = []
    for f in features:
        v, ref, imp = dbl(f), F.lit(float(reference[f])), F.lit(float(importance.get(f, 0.0)))
        nd = F.abs(v - ref) / F.greatest(F.abs(ref), F.lit(1.0))
        structs.append(F.struct(
            (imp * F.greatest(nd, F.lit(0.2))).alias("score"), imp.alias("importance"), F.lit(f).alias("feature"),
            v.alias("value"), ref.alias("reference_value"),
            F.when(v > ref, "acima da referência").when(v < ref, "abaixo da referência").otherwise("na referência")
            .alias("direction")))
    arr = F.array_sort(F.array(*structs), lambda a, b: F.when(a.score > b.score, -1).when(a.score < b.score, 1)
                       .when(a.importance > b.importance, -1).when(a.importance < b.importance, 1).otherwise(0))
    return members.select("customer_id", F.slice(arr, 1, 3).alias("top_3_drivers"))


def scoring_parity(a: DataFrame, b: DataFrame, key: str = "customer_id", pa: str = "p_a", pb: str = "p_b",
                   tol: float = 1e-3) -> DataFrame:
    """Max |p_a - p_b| over the whole table (join on key), pass flag."""
    j = a.select(key, F.col(pa).alias("_a")).join(b.select(key, F.col(pb).alias("_b")), key, "full")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("missing"),
                 F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff")) \
        .withColumn("parity_ok", (F.col("missing") == 0) & (F.col("max_abs_diff") < tol))
