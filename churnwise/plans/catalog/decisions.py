"""Registered scorecard-explanation and decision queries (H2, H3, E1, E3, E4,
W7, D1, D3, D5-D7, D10, F13) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.core import fixed
from ...functions.text import driver_lines
from ...operators import decide, eda
from ...operators.scorecard import SCORECARD_FEATURES, SHORT, rule_scorecard, top_drivers, waterfall_rows
from ...sources.members import member_snapshot, read_table
from ..oracle_sql import fx, with_members
from ..registry import register
from .core import scored_members

# Long form of the nine scorecard contributions, in evaluation order.
CONTRIB_SQL = "contrib AS (" + " UNION ALL ".join(
    f"SELECT customer_id, logit, {i} AS idx, '{f}' AS feature, c_{SHORT[f]} AS shap FROM scored"
    for i, f in enumerate(SCORECARD_FEATURES)) + ")"
RANKED_SQL = ("ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ABS(shap) DESC, idx) AS step "
              "FROM contrib)")


def _with_ranked(body: str) -> str:
    return with_members(f"SELECT * FROM (WITH {CONTRIB_SQL}, {RANKED_SQL} {body})", scored=True)


def _scored_full(spark, sf_dir):
    m = member_snapshot(spark, sf_dir)
    from ...operators.scorecard import linear_scorecard
    return m, linear_scorecard(m, keep=["customer_id", "Churn", "Lifetime", "Contract_period", "Promo_friends",
                                        "Avg_class_frequency_current_month", "Avg_class_frequency_total",
                                        "Avg_additional_charges_total"], with_drivers=True)


@register("w7_top_drivers", _with_ranked(
    "SELECT customer_id, step AS rank, feature, shap AS shap_value FROM ranked WHERE step <= 3"))
def q_top_drivers(spark, sf_dir):
    _, s = _scored_full(spark, sf_dir)
    return (s.select("customer_id", F.posexplode(top_drivers("contributions", 3)).alias("pos", "d"))
            .select("customer_id", (F.col("pos") + 1).alias("rank"), F.col("d.feature").alias("feature"),
                    F.col("d.shap_value").alias("shap_value")))


@register("e4_waterfall_rows", _with_ranked(
    f"SELECT customer_id, step, feature, shap AS contribution, "
    f"{fx('1.05 + SUM(shap) OVER (PARTITION BY customer_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 4)} "
    "AS running_logit, CASE WHEN MAX(ABS(shap)) OVER (PARTITION BY customer_id) = 0 THEN 0.0 "
    "ELSE ABS(shap) / MAX(ABS(shap)) OVER (PARTITION BY customer_id) END AS bar_share FROM ranked"))
def q_waterfall(spark, sf_dir):
    _, s = _scored_full(spark, sf_dir)
    w = waterfall_rows(s)
    return w.withColumn("running_logit", fixed("running_logit", 4))


@register("e1_e3_driver_summary", _with_ranked(
    "SELECT feature, COUNT(*) FILTER (WHERE step = 1) AS top1_members, "
    "COUNT(*) FILTER (WHERE shap >= 0) AS up_members, COUNT(*) FILTER (WHERE shap < 0) AS down_members, "
    f"{fx('AVG(ABS(shap))', 6)} AS mean_abs_contribution FROM ranked GROUP BY feature"))
def q_driver_summary(spark, sf_dir):
    """Per feature: how often it is the top driver, direction split and mean
    |contribution| (A29 on the scorecard attributions)."""
    _, s = _scored_full(spark, sf_dir)
    e = s.select(F.posexplode(top_drivers("contributions", 9)).alias("pos", "d"))
    return e.groupBy(F.col("d.feature").alias("feature")).agg(
        F.count_if(F.col("pos") == 0).alias("top1_members"),
        F.count_if(F.col("d.shap_value") >= 0).alias("up_members"),
        F.count_if(F.col("d.shap_value") < 0).alias("down_members"),
        eda.r(F.avg(F.abs("d.shap_value"))).alias("mean_abs_contribution"))


_D1_SQL = """
SELECT s.customer_id, d.dominant AS dominant_drivers,
  CASE WHEN s.Lifetime > 6 AND s.Avg_class_frequency_current_month < 0.5 THEN 'sleeping_dog'
       WHEN s.Lifetime <= 1 AND s.Avg_class_frequency_current_month < 1.0 THEN 'early_dropper'
       WHEN d.n_eng > 0 OR (s.Avg_class_frequency_total > 0
            AND s.Avg_class_frequency_current_month < 0.7 * s.Avg_class_frequency_total) THEN 'desengajado_conteudo'
       WHEN s.Contract_period <= 1 OR d.has_contract > 0 OR (d.has_charges > 0 AND s.Avg_additional_charges_total > 0)
            THEN 'preco_sensivel'
       ELSE 'concorrente_driven' END AS archetype_model
FROM scored s JOIN (
  SELECT customer_id, STRING_AGG(feature, ',' ORDER BY step) AS dominant,
         COUNT(*) FILTER (WHERE feature IN ('delta_freq', 'ratio_freq_atual_vs_lifetime',
                                             'Avg_class_frequency_current_month')) AS n_eng,
         COUNT(*) FILTER (WHERE feature = 'Contract_period') AS has_contract,
         COUNT(*) FILTER (WHERE feature = 'Avg_additional_charges_total') AS has_charges
  FROM ranked WHERE step <= 3 GROUP BY customer_id) d ON d.customer_id = s.customer_id"""


@register("d1_archetype_model", _with_ranked(_D1_SQL))
def q_archetype_model(spark, sf_dir):
    _, s = _scored_full(spark, sf_dir)
    a = decide.archetype_model(s)
    return a.select("customer_id", F.array_join("dominant_drivers", ",").alias("dominant_drivers"), "archetype_model")


_D4_SQL = f"""
SELECT a.customer_id, a.archetype_model, CASE a.archetype_model
  WHEN 'sleeping_dog' THEN 'Lifetime=' || CAST(s.Lifetime AS VARCHAR) || ' (>6) e freq_atual=' || CAST(s.Avg_class_frequency_current_month AS VARCHAR)
    || ' (<0,5): cliente antigo hoje inativo — não acordar.'
  WHEN 'early_dropper' THEN 'Lifetime=' || CAST(s.Lifetime AS VARCHAR) || ' (<=1) e freq_atual=' || CAST(s.Avg_class_frequency_current_month AS VARCHAR)
    || ' (<1): risco de desistência inicial.'
  WHEN 'desengajado_conteudo' THEN 'Drivers de engajamento dominantes (' || CASE WHEN len(e.eng) > 0 THEN '[' || chr(39) || array_to_string(e.eng, chr(39) || ', ' || chr(39)) || chr(39) || ']' ELSE 'queda de freq' END
    || '); freq caiu de ' || CAST({fx('s.Avg_class_frequency_total', 2)} AS VARCHAR) || ' para ' || CAST({fx('s.Avg_class_frequency_current_month', 2)} AS VARCHAR) || '.'
  WHEN 'preco_sensivel' THEN 'Contrato curto (Contract_period=' || CAST(s.Contract_period AS VARCHAR) || ') e/ou gasto adicional relevante; indicação='
    || CAST(s.Promo_friends AS VARCHAR) || '.'
  ELSE 'Cliente ativo com contrato ok e risco residual sem driver de engajamento — provável atração externa/concorrência.' END AS rationale
FROM ({_D1_SQL}) a JOIN scored s ON s.customer_id = a.customer_id
JOIN (SELECT customer_id, list_filter(string_split(dominant_drivers, ','), lambda x: x IN ('delta_freq', 'ratio_freq_atual_vs_lifetime', 'Avg_class_frequency_current_month')) AS eng
      FROM ({_D1_SQL})) e ON e.customer_id = a.customer_id"""


@register("d4_rationale", _with_ranked(_D4_SQL))
def q_rationale(spark, sf_dir):
    _, s = _scored_full(spark, sf_dir)
    return decide.rationale(decide.archetype_model(s)).select("customer_id", "archetype_model", "rationale")


def _policy_sql():
    rows = ", ".join(f"('{k}', {str(v[0]).upper()}, '{v[1]}', '{v[2]}')" for k, v in decide.ARCHETYPE_POLICY.items())
    return with_members(
        "SELECT s.customer_id, s.archetype, p.allowed AS policy_proactive_allowed, p.lever, p.policy FROM scored s "
        f"JOIN (VALUES {rows}) p(archetype, allowed, lever, policy) ON p.archetype = s.archetype", scored=True)


@register("d3_policy", _policy_sql())
def q_policy(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return decide.policy(s).select("customer_id", "archetype", "policy_proactive_allowed", "lever", "policy")


def _recommend_sql():
    rec_rows = ", ".join(f"('{k}', '{v[0]}', '{', '.join(v[1])}', '{v[2]}', '{v[3]}')"
                         for k, v in decide.RECOMMENDATIONS.items())
    arch_rows = ", ".join(f"('{k}', '{v}')" for k, v in decide.ARCHETYPE_LABELS.items())
    tier_rows = ", ".join(f"('{k}', '{v}')" for k, v in decide.TIER_LABELS.items())
    feat_rows = ", ".join(f"('{k}', '{v}')".replace("'cão que dorme'", "''cão que dorme''")
                          for k, v in decide.FEATURE_LABELS.items())
    return with_members(f"""
SELECT * FROM (WITH {CONTRIB_SQL}, {RANKED_SQL},
 top6 AS (SELECT r.*, a.actionable FROM ranked r JOIN (VALUES
   ('Avg_class_frequency_current_month', TRUE), ('Contract_period', TRUE), ('Month_to_end_contract', TRUE),
   ('Lifetime', FALSE), ('Group_visits', TRUE), ('Avg_additional_charges_total', FALSE), ('Promo_friends', FALSE),
   ('Partner', FALSE), ('ratio_freq_atual_vs_lifetime', TRUE)) a(feature, actionable) ON a.feature = r.feature
   WHERE r.step <= 6),
 fac AS (SELECT t.customer_id, STRING_AGG(COALESCE(fl.label, t.feature), ', ' ORDER BY t.rk) AS factors
   FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY step) AS rk FROM top6 WHERE actionable) t
   LEFT JOIN (VALUES {feat_rows}) fl(feature, label) ON fl.feature = t.feature WHERE t.rk <= 3 GROUP BY t.customer_id)
SELECT s.customer_id, printf('VZ%04d', s.customer_id) AS external_ref, s.archetype = 'sleeping_dog' AS blocked,
  CASE WHEN s.archetype = 'sleeping_dog' THEN '{decide.BLOCKED_REASON.replace("'", "''")}' END AS blocked_reason,
  CASE WHEN s.archetype = 'sleeping_dog' THEN 'Membro ' || printf('VZ%04d', s.customer_id)
       || ': o modelo o classificou como ''' || al.label || '''. Não há ação proativa recomendada.'
  ELSE 'O modelo estimou risco ' || tl.label || ' (' || printf('%.1f', {fx('s.churn_probability * 100', 1)}) || '%) para o membro '
       || printf('VZ%04d', s.customer_id) || ', no arquétipo ''' || al.label
       || '''. Os fatores acionáveis que mais pesaram no cálculo do modelo foram: ' || COALESCE(f.factors, 'frequência de uso')
       || '. Vale lembrar que essa leitura descreve o comportamento do modelo, não uma relação de causa e efeito.' END AS narrative,
  CASE WHEN s.archetype <> 'sleeping_dog' THEN rc.offer END AS offer,
  CASE WHEN s.archetype <> 'sleeping_dog' THEN rc.channels END AS channels,
  CASE WHEN s.archetype <> 'sleeping_dog' THEN rc.copy END AS copy,
  CASE WHEN s.archetype <> 'sleeping_dog' THEN rc.timing END AS timing
FROM scored s
JOIN (VALUES {arch_rows}) al(archetype, label) ON al.archetype = s.archetype
JOIN (VALUES {tier_rows}) tl(tier, label) ON tl.tier = s.risk_tier
LEFT JOIN (VALUES {rec_rows}) rc(archetype, offer, channels, copy, timing) ON rc.archetype = s.archetype
LEFT JOIN fac f ON f.customer_id = s.customer_id)""", scored=True)


@register("d5_recommend", _recommend_sql())
def q_recommend(spark, sf_dir):
    _, s = _scored_full(spark, sf_dir)
    s = s.withColumn("external_ref", F.format_string("VZ%04d", F.col("customer_id")))
    r = decide.recommend(s)
    return r.select("customer_id", "external_ref", "blocked", "blocked_reason", "narrative", "offer",
                    F.array_join("channel", ", ").alias("channels"), "copy", "timing")


_PCT_SQL = "(0?(2[1-9]|[3-9][0-9])|[1-9][0-9]{2})[\\x09-\\x0D \\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]?%"


@register("d6_sanitize_documents", f"""
SELECT doc_id, regexp_replace(text, '{_PCT_SQL}', '20%', 'g') AS offer, length(regexp_replace(text, '{_PCT_SQL}', '20%', 'g')) - length(text) AS delta_chars,
  regexp_replace('Desconto de ' || CAST(n_chars % 130 AS VARCHAR) || chr(160) || '% e ' || CAST(n_chars % 7 AS VARCHAR) || '%', '{_PCT_SQL}', '20%', 'g') AS copy,
  CASE WHEN lang = 'en' THEN 'sms, push' WHEN lang = 'fr' THEN 'e-mail' WHEN lang = 'de' THEN 'whatsapp business' ELSE 'ligacao' END AS channels
FROM documents""")
def q_sanitize_documents(spark, sf_dir):
    """A recommendation made from every document: its whole text as the offer, a copy with two discounts (one behind a
    no-break space) and channels by its language, among them unknown and too many."""
    name = lambda *c: F.array(*[F.lit(x) for x in c])
    lang = F.col("lang")
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("offer"), F.length("text").alias("_n"),
        F.concat(F.lit("Desconto de "), (F.col("n_chars") % 130).cast("string"), F.lit("\u00a0% e "), (F.col("n_chars") % 7).cast("string"), F.lit("%")).alias("copy"),
        F.when(lang == "en", name(" SMS", "fax", "Push", "e-mail")).when(lang == "fr", name("fax")).when(lang == "de", name("WhatsApp Business "))
        .otherwise(name("Ligacao")).alias("channel"))
    s = decide.sanitize_recommendation(d)
    return s.select("doc_id", "offer", (F.length("offer") - F.col("_n")).alias("delta_chars"), "copy", F.array_join("channel", ", ").alias("channels"))


# The labels are written out, not imported.
_LINES_SQL = """
SELECT customer_id, string_agg('- ' || label || ' = ' || value || ' (SHAP ' || printf('%.3f', shap3) || ', ' || dir || ', ' || act || ')', chr(10) ORDER BY step) AS lines FROM (
  SELECT r.customer_id, r.step, l.label, FLOOR(r.shap * 1000.0 + 0.5) / 1000.0 AS shap3, CASE WHEN r.raw >= 0 THEN 'aumenta o risco' ELSE 'reduz o risco' END AS dir,
    CASE WHEN l.act THEN 'acionável' ELSE 'não-acionável' END AS act,
    CASE WHEN r.v = FLOOR(r.v) THEN CAST(CAST(r.v AS BIGINT) AS VARCHAR) ELSE CAST(r.v AS VARCHAR) END AS value
  FROM driven r JOIN (VALUES {labels}) l(feature, label, act) ON l.feature = r.feature WHERE r.step <= 5) GROUP BY customer_id"""


def _lines_sql():
    from ...operators.scorecard import RATIO_WEIGHT, REFERENCE_MEMBER, SCORECARD_WEIGHTS
    rows = SCORECARD_WEIGHTS + [("ratio_freq_atual_vs_lifetime", RATIO_WEIGHT, True)]
    labels = ", ".join(f"('{f}', '{decide.FEATURE_LABELS[f]}', {str(bool(act)).upper()})" for f, _, act in rows)
    value = lambda f: "ratio3" if f == "ratio_freq_atual_vs_lifetime" else fx(f"CAST({f} AS DOUBLE)", 2)
    base = lambda f: 0.95 if f == "ratio_freq_atual_vs_lifetime" else float(REFERENCE_MEMBER[f])
    raw = lambda f, w: f"{w!r} * (CAST({'ratio3' if f == 'ratio_freq_atual_vs_lifetime' else f} AS DOUBLE) - {base(f)!r})"
    driven = "driven AS (" + " UNION ALL ".join(
        f"SELECT r.customer_id, r.step, r.feature, r.shap, {value(f)} AS v, {raw(f, w)} AS raw FROM ranked r JOIN scored s ON s.customer_id = r.customer_id WHERE r.feature = '{f}'"
        for f, w, _ in rows) + ")"
    return with_members(f"SELECT * FROM (WITH {CONTRIB_SQL}, {RANKED_SQL}, {driven} {_LINES_SQL.replace('{labels}', labels)})", scored=True)


@register("f18_driver_lines", _lines_sql())
def q_driver_lines(spark, sf_dir):
    """The five strongest drivers of every member as text lines."""
    _, s = _scored_full(spark, sf_dir)
    return s.select("customer_id", driver_lines("top_drivers", decide.FEATURE_LABELS).alias("lines"))


@register("d7_intervention_status", with_members(
    "SELECT risk_tier, CASE WHEN archetype = 'sleeping_dog' THEN 'bloqueada' ELSE 'aplicada' END AS status, "
    "COUNT(*) AS members FROM scored GROUP BY ALL", scored=True))
def q_intervention_status(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    return (s.withColumn("status", decide.intervention_status("archetype", "proactive_allowed"))
            .groupBy("risk_tier", "status").agg(F.count(F.lit(1)).alias("members")))


_H2_SQL = """SELECT customer_id, risk_points,
  CASE WHEN risk_points >= 5 THEN 'Alto Risco' WHEN risk_points >= 3 THEN 'Risco Médio' ELSE 'Baixo Risco' END AS risk_label
FROM (SELECT customer_id, Churn, CAST(
  (CASE WHEN Contract_period = 1 THEN 3 WHEN Contract_period = 6 THEN 1 ELSE 0 END)
  + (CASE WHEN Lifetime <= 1 THEN 3 WHEN Lifetime <= 3 THEN 2 WHEN Lifetime <= 6 THEN 1 ELSE 0 END)
  + (CASE WHEN Avg_class_frequency_current_month = 0 THEN 2
          WHEN Avg_class_frequency_total > 0 AND Avg_class_frequency_current_month / Avg_class_frequency_total < 0.5 THEN 2
          ELSE 0 END)
  + (CASE WHEN Month_to_end_contract <= 1 THEN 1 ELSE 0 END)
  - (CASE WHEN Group_visits = 1 THEN 1 ELSE 0 END) - (CASE WHEN Promo_friends = 1 THEN 1 ELSE 0 END)
  - (CASE WHEN Partner = 1 THEN 1 ELSE 0 END) - (CASE WHEN Near_Location = 1 THEN 1 ELSE 0 END) AS INTEGER) AS risk_points
  FROM members)"""


@register("h2_rule_scorecard", with_members(_H2_SQL))
def q_rule_scorecard(spark, sf_dir):
    return rule_scorecard(member_snapshot(spark, sf_dir)).select("customer_id", "risk_points", "risk_label")


@register("h3_rule_segments", with_members(
    f"SELECT l.label, COUNT(h.customer_id) AS count, CASE WHEN COUNT(h.customer_id) > 0 THEN "
    f"{fx('SUM(CAST(m.Churn AS DOUBLE)) / COUNT(h.customer_id)', 4)} END AS churn_rate FROM "
    "(VALUES ('Alto Risco'), ('Risco Médio'), ('Baixo Risco')) l(label) "
    f"LEFT JOIN ({_H2_SQL}) h ON h.risk_label = l.label LEFT JOIN members m ON m.customer_id = h.customer_id "
    "GROUP BY l.label"))
def q_rule_segments(spark, sf_dir):
    """H3: count and churn rate per band; an empty band keeps a null rate."""
    h = rule_scorecard(member_snapshot(spark, sf_dir))
    g = h.groupBy(F.col("risk_label").alias("_l")).agg(F.count(F.lit(1)).alias("n"),
                                                        F.sum(F.col("Churn").cast("double")).alias("c"))
    labels = spark.createDataFrame([("Alto Risco",), ("Risco Médio",), ("Baixo Risco",)], "label string")
    j = labels.join(F.broadcast(g), labels.label == g._l, "left")
    return j.select("label", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
                    F.when(F.col("n") > 0, fixed(F.col("c") / F.col("n"), 4)).alias("churn_rate"))


@register("d10_executive_summary", with_members("""
SELECT n, base_rate, concat_ws(chr(10) || chr(10),
 'Você desenhou uma estratégia de retenção orientada por dados.',
 'O problema tem tamanho: numa base de ' || CAST(n AS VARCHAR) || ' membros analisados, a taxa-base de cancelamento observada é de '
 || CAST(CAST(FLOOR(base_rate * 100 + 0.5) AS BIGINT) AS VARCHAR) || '% — alta o bastante para justificar agir, mas não tão alta que baste '
 || '''chutar''' || '. É exatamente onde um modelo de risco compensa.',
 'Como o modelo ajuda: ele estima o risco de cada membro e, com a explicação local (SHAP), mostra quais variáveis pesaram naquele caso e quais a operação consegue mudar — uma leitura do comportamento do modelo, não de causa e efeito do mundo real.',
 'A decisão de ação é custo-consciente: cada recomendação respeita orçamento e canais, e há casos em que a melhor decisão é NÃO intervir — o perfil ''cão que dorme'' (vínculo longo, uso quase zero) fica fora das campanhas proativas por política de não-intrusão.',
 'No nível do sistema, o corte de decisão é escolhido pelo ROI — equilibrando churns capturados e contatos desperdiçados — e não apenas pelo recall. Você percorreu: mapa de risco; decisão de ação. Fechando o ciclo, cada membro retido preserva receita: é assim que o risco do modelo vira valor de negócio.') AS summary
FROM (SELECT COUNT(*) AS n, COALESCE(SUM(CAST(Churn AS DOUBLE)) FILTER (WHERE Churn IN (0, 1)) / COUNT(*) FILTER (WHERE Churn IN (0, 1)), 0.0) AS base_rate FROM members)"""))
def q_executive_summary(spark, sf_dir):
    _, s = scored_members(spark, sf_dir)
    steps = F.array(F.lit("mapa de risco"), F.lit("decisão de ação"))
    return decide.executive_summary(eda.score_facts(s).select("n", "base_rate", steps.alias("highlights")))
