"""What-if over whole member tables (Q1-Q6, Q13, Q14).

The interactive simulator is re-aimed as batch operators: every member is
tested against every candidate lever value in one pass. Candidates live in a
literal array (70 entries) evaluated with higher-order functions per row, so
there is no member x candidate row blow-up and no shuffle; the scorecard is
additive, so only the changed terms are recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import clamp01, dbl, fixed, risk_tier, safe_divide, sigmoid, tier_rank
from .scorecard import INTERCEPT, RATIO_WEIGHT, REFERENCE_MEMBER, SCORECARD_FEATURES, SCORECARD_WEIGHTS, \
    contribution_terms, scorecard_logit, scorecard_ratio

# Levers (feature, label, control, min, max, step, options), in order.
LEVERS = [
    ("Avg_class_frequency_current_month", "Frequência de aulas no mês", "slider", 0.0, 5.0, 0.1, None),
    ("Group_visits", "Participação em desafios em grupo", "toggle", None, None, None, None),
    ("Contract_period", "Duração do plano", "select", None, None, None, [1, 3, 6, 12]),
    ("Month_to_end_contract", "Meses até o fim do contrato", "slider", 0.0, 12.0, 1.0, None),
]
CONTRACT_OPTIONS = [1, 3, 6, 12]


def lever_grid(compat: bool = False) -> list[tuple[int, float, int]]:
    """Q2: (lever index, candidate value, order) for every candidate, in the
    reference's iteration order. Slider steps are integer multiples, so the
    values are exact decimals (k/10, k). The group toggle offers {0, 1};
    ``compat=True`` keeps the reference's [0] only."""
    out = []
    for li, (_, _, control, lo, hi, step, opts) in enumerate(LEVERS):
        if control == "select":
            vals = [float(v) for v in opts]
        elif control == "toggle":
            vals = [0.0] if compat else [0.0, 1.0]
        elif step == 0.1:
            vals = [k / 10 for k in range(0, 51)]
        else:
            vals = [float(k) for k in range(int(lo), int(hi) + 1)]
        out += [(li, v) for v in vals]
    return [(li, v, i) for i, (li, v) in enumerate(out)]


def _grid_col(compat: bool = False) -> Column:
    return F.array(*[F.struct(F.lit(li).alias("lever"), F.lit(v).alias("v"), F.lit(i).alias("ord"))
                     for li, v, i in lever_grid(compat)])


def _from_value(lever: Column) -> Column:
    return (F.when(lever == 0, dbl("Avg_class_frequency_current_month"))
            .when(lever == 1, dbl("Group_visits")).when(lever == 2, dbl("Contract_period"))
            .otherwise(dbl("Month_to_end_contract")))


def lever_effort(lever: Column, frm: Column, to: Column) -> Column:
    """Q3: slider |delta| / range; select = option steps (raw gap when the
    value is not an option); toggle |delta|."""
    opts = F.array(*[F.lit(float(o)) for o in CONTRACT_OPTIONS])
    fi, ti = F.array_position(opts, frm), F.array_position(opts, to)
    return (F.when(lever == 0, F.abs(to - frm) / F.lit(5.0))
            .when(lever == 3, F.abs(to - frm) / F.lit(12.0))
            .when((lever == 2) & (fi > 0) & (ti > 0), F.abs(ti - fi).cast("double"))
            .otherwise(F.abs(to - frm)))


def human_action(lever: Column, v: Column) -> Column:
    """the action phrase for a lever value."""
    freq_txt = F.regexp_replace(F.format_string("%.1f", fixed(v, 1)), r"\.0$", "")
    whole = F.floor(v + F.lit(0.5)).cast("bigint").cast("string")
    return (F.when(lever == 0, F.concat(F.lit("levar o membro a ~"), freq_txt, F.lit(" aulas por semana")))
            .when(lever == 1, F.when(v >= 0.5, F.lit("incluir o membro nos desafios em grupo"))
                  .otherwise(F.lit("tirar o membro dos desafios em grupo")))
            .when(lever == 2, F.concat(F.lit("renovar para um plano de "), whole, F.lit(" meses")))
            .otherwise(F.concat(F.lit("trabalhar a renovação ("), whole, F.lit(" meses até o fim)"))))


def _prepare(df: DataFrame, real_prob: str) -> DataFrame:
    """Baseline scorecard state needed by every candidate."""
    ratio3 = scorecard_ratio()
    base = df.withColumn("_ratio3", ratio3)
    vals = {f: F.col(f) for f in ("Avg_class_frequency_current_month", "Contract_period", "Month_to_end_contract",
                                  "Lifetime", "Group_visits", "Avg_additional_charges_total", "Promo_friends",
                                  "Partner")}
    vals["ratio_freq_atual_vs_lifetime"] = F.col("_ratio3")
    p = sigmoid(scorecard_logit(contribution_terms(vals)))
    dog = (F.col("Lifetime") > 6) & (dbl("Avg_class_frequency_current_month") < 0.5)
    return base.withColumns({
        "_sim_base": fixed(p, 5),
        "_real": dbl(real_prob),
        "_dog": dog,
        "_from_tier": risk_tier(dbl(real_prob), "scorecard"),
    })


_TERM_COLS = ["_t1", "_t2", "_t3", "_t4", "_t5", "_t6", "_t7", "_t8", "_t9"]
_LEVER_TERM = {0: 0, 1: 4, 2: 1, 3: 2}  # lever -> index of the scorecard term it changes


def _ordered_sum(terms: list[Column], start: Column) -> Column:
    s = start
    for t in terms:
        s = s + t
    return s


def _lever_scan(li: int, compat: bool) -> Column:
    """Evaluate every candidate value of one lever with a lean lambda.

    Only the changed scorecard term(s) are recomputed; the others are
    per-member columns, and the sum keeps the reference's left-to-right order
    (prefix of unchanged terms + changed term + the rest), so the result is
    the same double as a full re-score. Returns an array of structs ordered by
    (effort, order), null where the candidate is not valid."""
    feature, _, control, lo, hi, step, opts = LEVERS[li]
    grid = [(v, i) for lj, v, i in lever_grid(compat) if lj == li]
    values = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(i).alias("ord")) for v, i in grid])
    k = _LEVER_TERM[li]
    weight = {f: w for f, w, _ in SCORECARD_WEIGHTS}[feature]
    ref = float(REFERENCE_MEMBER[feature])
    frm = dbl(feature)
    from_rank = tier_rank(F.col("_from_tier"))

    def fn(c):
        v = c["v"]
        terms = [F.col(t) for t in _TERM_COLS]
        terms[k] = fixed(F.lit(weight) * (v - F.lit(ref)), 4)
        if li == 0:
            ratio3 = fixed(safe_divide(v, F.col("Avg_class_frequency_total")), 3)
            terms[8] = fixed(F.lit(RATIO_WEIGHT) * (ratio3 - F.lit(0.95)), 4)
        start = F.col(f"_pre{k}") if k > 0 else F.lit(0.0)
        logit = F.lit(INTERCEPT) + _ordered_sum(terms[k:], start)
        sim_new = fixed(sigmoid(logit), 5)
        projected = F.least(F.greatest(F.col("_real") + sim_new - F.col("_sim_base"), F.lit(0.0)), F.lit(1.0))
        to_rank = F.when(projected >= 0.75, 3).when(projected >= 0.55, 2).when(projected >= 0.35, 1).otherwise(0)
        if control == "select":
            opts_arr = F.array(*[F.lit(float(o)) for o in CONTRACT_OPTIONS])
            pos, vpos = F.array_position(opts_arr, frm), F.array_position(opts_arr, v)
            effort = F.when((pos > 0) & (vpos > 0), F.abs(vpos - pos).cast("double")).otherwise(F.abs(v - frm))
        elif control == "slider":
            effort = F.abs(v - frm) / F.lit(float(hi - lo))
        else:
            effort = F.abs(v - frm)
        return F.when((v != frm) & (to_rank < from_rank),
                      F.struct(effort.alias("effort"), c["ord"].alias("ord"), F.lit(li).alias("lever"),
                               v.alias("v"), frm.alias("frm"), projected.alias("projected")))

    return F.transform(values, fn)


def cheapest_lever(df: DataFrame, real_prob: str = "churn_probability", compat: bool = False) -> DataFrame:
    """Q4: per member, the least-effort single lever value that moves the
    anchored projection to a strictly lower tier (scheme scorecard). Null for
    sleeping dogs, members already 'baixo', or when no candidate works.
    Ties keep the first candidate in lever order then ascending value.

    The 70 candidates are evaluated per row with four lean array scans (one
    per lever); array_min over (effort, order) picks the winner. No member x
    candidate rows and no shuffle."""
    d = _prepare(df, real_prob)
    vals = {f: F.col(f) for f in ("Avg_class_frequency_current_month", "Contract_period", "Month_to_end_contract",
                                  "Lifetime", "Group_visits", "Avg_additional_charges_total", "Promo_friends",
                                  "Partner")}
    vals["ratio_freq_atual_vs_lifetime"] = F.col("_ratio3")
    terms = contribution_terms(vals)
    d = d.withColumns({t: terms[f] for t, f in zip(_TERM_COLS, SCORECARD_FEATURES)})
    t = [F.col(c) for c in _TERM_COLS]
    d = d.withColumns({"_pre1": F.lit(0.0) + t[0], "_pre2": (F.lit(0.0) + t[0]) + t[1],
                       "_pre4": (((F.lit(0.0) + t[0]) + t[1]) + t[2]) + t[3]})
    scans = F.concat(*[_lever_scan(li, compat) for li in range(len(LEVERS))])
    allowed = ~F.col("_dog") & (F.col("_from_tier") != "baixo")
    d = d.withColumn("_best0", F.when(allowed, F.array_min(scans)))
    b = F.col("_best0")
    labels = F.create_map(*[x for i, l in enumerate(LEVERS) for x in (F.lit(i), F.lit(l[1]))])
    feats = F.create_map(*[x for i, l in enumerate(LEVERS) for x in (F.lit(i), F.lit(l[0]))])
    return d.drop("_ratio3", *_TERM_COLS, "_pre1", "_pre2", "_pre4").withColumns({
        "lever_feature": feats[b["lever"]],
        "lever_label": labels[b["lever"]],
        "from_value": b["frm"],
        "to_value": b["v"],
        "human_action": F.when(b.isNotNull(), human_action(b["lever"], b["v"])),
        "projected": b["projected"],
        "from_tier": F.col("_from_tier"),
        "to_tier": F.when(b.isNotNull(), risk_tier(b["projected"], "scorecard")),
        "effort": b["effort"],
    }).drop("_best0")


def uplift_proxy(lev: DataFrame, churn_loss: float = 712.0) -> DataFrame:
    """Q5: uplift = max(0, p - projected) of the cheapest lever, expected value
    = uplift x churn loss, reason code (needs :func:`cheapest_lever` output)."""
    has = F.col("lever_feature").isNotNull()
    uplift = F.when(has, F.greatest(F.lit(0.0), F.col("_real") - F.col("projected"))).otherwise(F.lit(0.0))
    reason = (F.when(F.col("_dog"), "nao_intrusao").when(~has & (F.col("_from_tier") == "baixo"), "ja_baixo")
              .when(~has, "sem_alavanca").otherwise("ok"))
    return lev.withColumns({
        "uplift": uplift,
        "expected_value": uplift * F.lit(churn_loss),
        "actionable": uplift > 0,
        "reason": reason,
        "recommended_action": F.when(has & ~F.col("_dog"), F.col("human_action")),
    })


def project_anchored(df: DataFrame, overrides: dict[str, Column], real_prob: str = "churn_probability") -> DataFrame:
    """Q1: clamp01(real p + scorecard(new) - scorecard(base)) for a set of
    per-member overrides (columns or literals), with delta in whole points."""
    d = _prepare(df, real_prob)
    vals = {f: F.col(f) for f in ("Avg_class_frequency_current_month", "Contract_period", "Month_to_end_contract",
                                  "Lifetime", "Group_visits", "Avg_additional_charges_total", "Promo_friends",
                                  "Partner")}
    vals.update(overrides)
    vals["ratio_freq_atual_vs_lifetime"] = scorecard_ratio(vals["Avg_class_frequency_current_month"])
    sim_new = fixed(sigmoid(scorecard_logit(contribution_terms(vals))), 5)
    projected = clamp01(F.col("_real") + sim_new - F.col("_sim_base"))
    return d.drop("_ratio3").withColumns({
        "sim_baseline": F.col("_sim_base"),
        "sim_new": sim_new,
        "projected": projected,
        "delta_pp": F.floor((projected - F.col("_real")) * F.lit(100.0) + F.lit(0.5)).cast("int"),
    })


def assign_experiment(df: DataFrame, key: str = "customer_id", salt: str = "uplift-ab") -> DataFrame:
    """Q13: stable treatment / control split by key hash; sleeping dogs are
    excluded from the experiment (arm null)."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("bigint")
    dog = (F.col("Lifetime") > 6) & (dbl("Avg_class_frequency_current_month") < 0.5)
    return df.withColumn("arm", F.when(dog, F.lit(None).cast("string"))
                         .when(h % 2 == 0, "treatment").otherwise("control"))


def uplift_eval(df: DataFrame, score: str = "uplift", outcome: str = "Churn", n_bins: int = 10) -> DataFrame:
    """Q14: churn difference (control - treatment) per predicted-uplift decile
    and cumulative Qini. Deciles come from a hash-free rank on the score via
    ``ntile`` over the bounded per-score histogram, not over member rows."""
    from pyspark.sql.window import Window
    h = (df.filter(F.col("arm").isNotNull())
         .groupBy(F.floor(F.col(score) * F.lit(100000.0) + F.lit(0.5)).alias("s"))
         .agg(F.count_if(F.col("arm") == "treatment").alias("nt"), F.count_if(F.col("arm") == "control").alias("nc"),
              F.sum(F.when(F.col("arm") == "treatment", F.col(outcome))).alias("yt"),
              F.sum(F.when(F.col("arm") == "control", F.col(outcome))).alias("yc")))
    w = Window.orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy()
    c = h.select("*", (F.sum(F.col("nt") + F.col("nc")).over(w)).alias("cum_n"),
                 F.sum(F.col("nt") + F.col("nc")).over(tot).alias("n"))
    c = c.withColumn("decile", F.least(F.lit(n_bins), F.ceil(F.col("cum_n") * F.lit(float(n_bins)) / F.col("n"))).cast("int"))
    g = c.groupBy("decile").agg(*[F.sum(x).alias(x) for x in ("nt", "nc", "yt", "yc")])
    wd = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rate = lambda y, n: F.when(F.col(n) > 0, F.col(y) / F.col(n))
    return g.select("decile", "nt", "nc", (rate("yc", "nc") - rate("yt", "nt")).alias("uplift"),
                    (F.coalesce(F.sum("yc").over(wd) / F.sum("nc").over(wd), F.lit(0.0)) * F.sum("nt").over(wd)
                     - F.coalesce(F.sum("yt").over(wd), F.lit(0))).alias("qini"))


# Lever units for narration, and the closing disclaimer.
LEVER_UNITS = {0: "aulas/sem", 1: None, 2: "meses", 3: "meses"}
NARRATION_DISCLAIMER = "Isto descreve o comportamento do modelo, não causalidade."


def narrate_change(lev: DataFrame, top_label: Column, top_up: Column) -> DataFrame:
    """fixed sentence for a member's cheapest lever: the change, risk
    before -> after in whole percent, the move in p.p., the largest driver
    with its direction, and the disclaimer. Members without a lever get the
    'Sem ajustes' form with an unchanged projection."""
    real, proj = F.col("_real"), F.coalesce(F.col("projected"), F.col("_real"))
    pct = lambda p: F.concat(F.floor(p * 100 + 0.5).cast("bigint").cast("string"), F.lit("%"))
    delta = F.floor((proj - real) * 100 + 0.5).cast("int")
    v = F.col("to_value")
    whole = v == F.floor(v)
    val = F.when(whole, F.floor(v).cast("bigint").cast("string")).otherwise(F.format_string("%.1f", fixed(v, 1)))
    lev_idx = (F.when(F.col("lever_feature") == LEVERS[0][0], 0).when(F.col("lever_feature") == LEVERS[1][0], 1)
               .when(F.col("lever_feature") == LEVERS[2][0], 2).otherwise(3))
    unit = F.create_map(*[x for k, u in LEVER_UNITS.items() if u for x in (F.lit(k), F.lit(u))])[lev_idx]
    val = F.when(unit.isNotNull(), F.concat(val, F.lit(" "), unit)).otherwise(val)
    change = F.when(F.col("lever_feature").isNotNull(),
                    F.concat(F.lit("Ao ajustar "), F.col("lever_label"), F.lit(" para "), val, F.lit(","))) \
        .otherwise(F.lit("Sem ajustes,"))
    move = F.when(delta < 0, F.concat(F.lit("(queda de "), F.abs(delta).cast("string"), F.lit(" p.p.)."))) \
        .when(delta > 0, F.concat(F.lit("(alta de "), delta.cast("string"), F.lit(" p.p.)."))) \
        .otherwise(F.lit("(sem mudança no risco)."))
    driver = F.concat(F.lit("O maior fator é "), top_label, F.lit(", "),
                      F.when(top_up, "empurrando o risco para cima").otherwise("puxando o risco para baixo"), F.lit("."))
    return lev.withColumn("narration", F.concat_ws(
        " ", change, F.concat(F.lit("o modelo move o risco de "), pct(real), F.lit(" para "), pct(proj)), move, driver,
        F.lit(NARRATION_DISCLAIMER)))
