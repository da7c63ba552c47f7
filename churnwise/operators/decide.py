"""Decisions (D1-D7, D10): archetypes, policy, recommendations, guardrails.

All rules are column expressions over scored members; lookups are literal
maps (a few entries), so nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import col, dbl, fixed
from ..functions.text import cap_discount, clean_channels

# Archetype policy (proactive flag, lever, policy text).
ARCHETYPE_POLICY = {
    "preco_sensivel": (True, "migracao_contrato_anual",
                       "Oferta de plano anual com desconto dentro do teto; destacar economia vs mensal."),
    "desengajado_conteudo": (True, "reengajamento_conteudo",
                             "Reengajar por aulas/desafios em grupo; nudge de frequência; trilha personalizada."),
    "early_dropper": (True, "onboarding_reforcado",
                      "Onboarding próximo nas primeiras semanas; metas iniciais; check-in humano."),
    "sleeping_dog": (False, "nenhuma_acao_proativa",
                     "NÃO intervir proativamente (guardrail ADR-0008). Apenas reagir se o cliente buscar."),
    "concorrente_driven": (True, "reforco_de_valor",
                           "Reforço de valor/benefício de parceria (convênio) e comunidade; evitar guerra de preço."),
}
ENGAGEMENT_DRIVERS = ["delta_freq", "ratio_freq_atual_vs_lifetime", "Avg_class_frequency_current_month"]

# Display labels.
TIER_LABELS = {"baixo": "Baixo", "medio": "Médio", "alto": "Alto", "critico": "Crítico"}
ARCHETYPE_LABELS = {
    "preco_sensivel": "Preço-sensível",
    "desengajado_conteudo": "Desengajado de conteúdo",
    "early_dropper": "Early dropper",
    "sleeping_dog": "Cão que dorme",
    "concorrente_driven": "Atraído por concorrente",
}
FEATURE_LABELS = {
    "gender": "Gênero",
    "Near_Location": "Mora perto da unidade",
    "Partner": "Convênio empresarial",
    "Promo_friends": "Veio por indicação",
    "Phone": "Telefone cadastrado",
    "Contract_period": "Período de contrato (meses)",
    "Group_visits": "Participa de desafios em grupo",
    "Age": "Idade",
    "Avg_additional_charges_total": "Gasto médio em adicionais",
    "Month_to_end_contract": "Meses até o fim do contrato",
    "Lifetime": "Tempo de assinatura (meses)",
    "Avg_class_frequency_total": "Frequência média (histórico)",
    "Avg_class_frequency_current_month": "Frequência média (mês atual)",
    "ratio_freq_atual_vs_lifetime": "Razão freq. atual / histórica",
    "flag_early_user": "Usuário recém-chegado",
    "flag_sleeping_dog": "Perfil 'cão que dorme'",
    "delta_freq": "Variação de frequência",
}

# Deterministic recommendation per archetype (offer, channels, copy, timing).
MAX_DISCOUNT_PCT = 20
RECOMMENDATIONS = {
    "early_dropper": ("Sessão de onboarding guiada + 1 aula experimental sem custo", ["whatsapp", "e-mail"],
                      "Vimos que você começou agora! Que tal uma aula experimental para encontrar o que combina com você?",
                      "Próximas 48h"),
    "desengajado_conteudo": ("Convite para 2 desafios em grupo da próxima semana", ["push", "e-mail"],
                             "Sentimos sua falta nas aulas. Preparamos desafios novos que podem reacender sua rotina.",
                             "Início da próxima semana"),
    "preco_sensivel": (f"Upgrade para plano semestral com {MAX_DISCOUNT_PCT}% no primeiro ciclo", ["e-mail", "whatsapp"],
                       "Um plano um pouco mais longo sai mais em conta por mês — montamos uma condição especial para você.",
                       "Antes do fim do contrato atual"),
    "concorrente_driven": ("Benefício exclusivo de fidelidade + acesso antecipado a novas aulas", ["e-mail"],
                           "Queremos que você fique com a gente: liberamos um benefício exclusivo de fidelidade para você.",
                           "Esta semana"),
}
BLOCKED_REASON = "Perfil 'cão que dorme': excluído de campanhas proativas pela política de não-intrusão."


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Literal dictionary lookup (a map literal, no join)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    v = m[key]
    return v if default is None else F.coalesce(v, F.lit(default))


def dominant_features(drivers: Column | str, k: int = 3) -> Column:
    """Top-k feature names by |shap_value| (stable on ties)."""
    from .scorecard import top_drivers
    return F.transform(top_drivers(drivers, k), lambda d: d.feature)


def archetype_model(df: DataFrame, drivers: str = "contributions") -> DataFrame:
    """Model archetype from raw features and the member's dominant drivers:
    sleeping dog; early (lifetime <= 1 and freq < 1); engagement driver in the
    top 3 or freq < 0.7 x historical; contract <= 1 or contract / charges
    driver; otherwise competitor-driven. Adds ``dominant_drivers``."""
    dom = dominant_features(drivers, 3)
    life, cur, tot = col("Lifetime"), dbl("Avg_class_frequency_current_month"), dbl("Avg_class_frequency_total")
    contract, charges = col("Contract_period"), dbl("Avg_additional_charges_total")
    eng = F.array(*[F.lit(x) for x in ENGAGEMENT_DRIVERS])
    arch = (F.when((life > 6) & (cur < 0.5), "sleeping_dog")
            .when((life <= 1) & (cur < 1.0), "early_dropper")
            .when(F.arrays_overlap(F.col("dominant_drivers"), eng) | ((tot > 0) & (cur < F.lit(0.7) * tot)),
                  "desengajado_conteudo")
            .when((contract <= 1) | F.array_contains("dominant_drivers", "Contract_period")
                  | (F.array_contains("dominant_drivers", "Avg_additional_charges_total") & (charges > 0)),
                  "preco_sensivel")
            .otherwise("concorrente_driven"))
    return df.withColumn("dominant_drivers", dom).withColumn("archetype_model", arch)


def policy(df: DataFrame, arch: str = "archetype") -> DataFrame:
    """D3: proactive flag, lever and policy text per archetype."""
    a = F.col(arch)
    return df.withColumns({
        "policy_proactive_allowed": lookup({k: v[0] for k, v in ARCHETYPE_POLICY.items()}, a),
        "lever": lookup({k: v[1] for k, v in ARCHETYPE_POLICY.items()}, a),
        "policy": lookup({k: v[2] for k, v in ARCHETYPE_POLICY.items()}, a),
    })


def py_num(c: Column) -> Column:
    """Python-like text of a number: integral doubles keep '.0'."""
    return F.when(dbl(c) == F.floor(dbl(c)), F.format_string("%.1f", dbl(c))).otherwise(dbl(c).cast("string"))


def rationale(df: DataFrame, arch: str = "archetype_model") -> DataFrame:
    """Text with the values that fired the D1 rule."""
    a = F.col(arch)
    life = F.col("Lifetime").cast("string")
    cur, tot = dbl("Avg_class_frequency_current_month"), dbl("Avg_class_frequency_total")
    eng = F.filter("dominant_drivers", lambda d: F.array_contains(F.array(*[F.lit(x) for x in ENGAGEMENT_DRIVERS]), d))
    eng_txt = F.when(F.size(eng) > 0, F.concat(F.lit("['"), F.array_join(eng, "', '"), F.lit("']"))) \
        .otherwise(F.lit("queda de freq"))
    txt = (F.when(a == "sleeping_dog", F.concat(F.lit("Lifetime="), life, F.lit(" (>6) e freq_atual="), py_num(cur),
                                                  F.lit(" (<0,5): cliente antigo hoje inativo — não acordar.")))
           .when(a == "early_dropper", F.concat(F.lit("Lifetime="), life, F.lit(" (<=1) e freq_atual="), py_num(cur),
                                                F.lit(" (<1): risco de desistência inicial.")))
           .when(a == "desengajado_conteudo", F.concat(
               F.lit("Drivers de engajamento dominantes ("), eng_txt, F.lit("); freq caiu de "),
               py_num(fixed(tot, 2)), F.lit(" para "), py_num(fixed(cur, 2)), F.lit(".")))
           .when(a == "preco_sensivel", F.concat(
               F.lit("Contrato curto (Contract_period="), F.col("Contract_period").cast("string"),
               F.lit(") e/ou gasto adicional relevante; indicação="), F.col("Promo_friends").cast("string"), F.lit(".")))
           .otherwise(F.lit("Cliente ativo com contrato ok e risco residual sem driver de engajamento — "
                            "provável atração externa/concorrência.")))
    return df.withColumn("rationale", txt)


def pct_text(p: Column, digits: int = 1) -> Column:
    """F12 pct: (p x 100) with ``digits`` decimals and a % sign."""
    return F.concat(F.format_string(f"%.{digits}f", fixed(dbl(p) * 100, digits)), F.lit("%"))


def recommend(df: DataFrame, ref: str = "external_ref", drivers: str = "top_drivers") -> DataFrame:
    """Deterministic recommendation. Blocked members (sleeping dog or not
    proactive) get a reason, a non-intrusion narrative and null offer."""
    a = F.col("archetype")
    blocked = (a == "sleeping_dog") | (F.col("proactive_allowed") == F.lit(False))
    arch_l = lookup(ARCHETYPE_LABELS, a)
    tier_l = lookup(TIER_LABELS, F.col("risk_tier"))
    pct = F.format_string("%.1f", fixed(dbl("churn_probability") * 100, 1))
    act = F.slice(F.filter(drivers, lambda d: d.actionable), 1, 3)
    labels = F.create_map(*[x for k, v in FEATURE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    factors = F.array_join(F.transform(act, lambda d: F.coalesce(labels[d.feature], d.feature)), ", ")
    factors = F.when(F.size(act) > 0, factors).otherwise(F.lit("frequência de uso"))
    rec_key = F.when(a.isin(*RECOMMENDATIONS.keys()), a).otherwise(F.lit("concorrente_driven"))
    offer = lookup({k: v[0] for k, v in RECOMMENDATIONS.items()}, rec_key)
    chans = F.create_map(*[x for k, v in RECOMMENDATIONS.items()
                           for x in (F.lit(k), F.array(*[F.lit(c) for c in v[1]]))])[rec_key]
    narrative = F.when(blocked, F.concat(
        F.lit("Membro "), F.col(ref), F.lit(": o modelo o classificou como '"), arch_l,
        F.lit("'. Não há ação proativa recomendada."))).otherwise(F.concat(
        F.lit("O modelo estimou risco "), tier_l, F.lit(" ("), pct, F.lit("%) para o membro "), F.col(ref),
        F.lit(", no arquétipo '"), arch_l, F.lit("'. Os fatores acionáveis que mais pesaram no cálculo do modelo foram: "),
        factors, F.lit(". Vale lembrar que essa leitura descreve o comportamento do modelo, não uma relação de causa e efeito.")))
    return df.withColumns({
        "blocked": blocked,
        "blocked_reason": F.when(blocked, F.lit(BLOCKED_REASON)),
        "narrative": narrative,
        "offer": F.when(~blocked, offer),
        "channel": F.when(~blocked, chans),
        "copy": F.when(~blocked, lookup({k: v[2] for k, v in RECOMMENDATIONS.items()}, rec_key)),
        "timing": F.when(~blocked, lookup({k: v[3] for k, v in RECOMMENDATIONS.items()}, rec_key)),
    })


def sanitize_recommendation(df: DataFrame, offer: str = "offer", copy: str = "copy", channel: str = "channel") -> DataFrame:
    """Discount cap on offer / copy text and channel cleaning, for any
    recommendation table including externally generated text."""
    return df.withColumns({
        offer: cap_discount(F.coalesce(F.col(offer), F.lit(""))),
        copy: cap_discount(F.coalesce(F.col(copy), F.lit(""))),
        channel: clean_channels(F.col(channel)),
    })


def intervention_status(archetype: Column | str, allowed: Column | str) -> Column:
    """Bloqueada for sleeping dogs or disallowed members, else aplicada."""
    return F.when((col(archetype) == "sleeping_dog") | (col(allowed) == F.lit(False)), "bloqueada").otherwise("aplicada")


# The paragraphs of the executive summary, in order. {n}, {pct} and
# {steps} are filled in.
SUMMARY_PARAGRAPHS = (
    "Você desenhou uma estratégia de retenção orientada por dados.",
    "O problema tem tamanho: numa base de {n} membros analisados, a taxa-base de cancelamento observada é de {pct} — "
    "alta o bastante para justificar agir, mas não tão alta que baste 'chutar'. É exatamente onde um modelo de risco "
    "compensa.",
    "Como o modelo ajuda: ele estima o risco de cada membro e, com a explicação local (SHAP), mostra quais variáveis "
    "pesaram naquele caso e quais a operação consegue mudar — uma leitura do comportamento do modelo, não de causa e "
    "efeito do mundo real.",
    "A decisão de ação é custo-consciente: cada recomendação respeita orçamento e canais, e há casos em que a melhor "
    "decisão é NÃO intervir — o perfil 'cão que dorme' (vínculo longo, uso quase zero) fica fora das campanhas "
    "proativas por política de não-intrusão.",
    "No nível do sistema, o corte de decisão é escolhido pelo ROI — equilibrando churns capturados e contatos "
    "desperdiçados — e não apenas pelo recall. {steps}Fechando o ciclo, cada membro retido preserva receita: é assim "
    "que o risco do modelo vira valor de negócio.",
)


def executive_summary(facts: DataFrame, highlights: str = "highlights") -> DataFrame:
    """One deterministic text of five paragraphs from n, base rate
    and the highlights (array of strings; none adds no sentence)."""
    pct = F.concat(F.floor(dbl("base_rate") * 100 + 0.5).cast("bigint").cast("string"), F.lit("%"))
    steps = F.when(F.size(highlights) > 0, F.concat(F.lit("Você percorreu: "), F.array_join(highlights, "; "), F.lit(". "))) \
        .otherwise(F.lit(""))
    text = F.lit("\n\n".join(SUMMARY_PARAGRAPHS))
    for name, value in (("{n}", F.col("n").cast("string")), ("{pct}", pct), ("{steps}", steps)):
        text = F.replace(text, F.lit(name), value)
    return facts.select("n", "base_rate", text.alias("summary"))
