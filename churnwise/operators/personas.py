"""Personas (D9): a template per segment risk label joined to the observed
churn of that segment. The template table is a few literal rows (broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import dbl, fixed

# Persona templates per algorithm family and risk label
# (name, setup, conflict, resolution, decision, limit).
TEMPLATES = {
    "kmeans": {
        "Alto Risco": (
            "Desistente em Risco",
            "Cliente com histórico recente de queda na frequência e contrato próximo do vencimento.",
            "Perdeu o hábito de treinar e não encontra razão suficiente para renovar.",
            "Segmento com maior taxa de churn observada. Alvo prioritário de retenção ativa.",
            "Contato preventivo, oferta de reativação, mapeamento de barreiras.",
            "Não é possível inferir o motivo exato da saída sem pesquisa qualitativa."),
        "Risco Médio-Alto": (
            "Cliente Oscilante",
            "Engajamento irregular. Frequenta, mas com intensidade variável.",
            "Sem forte vínculo com a academia. Pode sair se houver atrito ou alternativa.",
            "Segmento intermediário com churn acima da média. Merece atenção preventiva.",
            "Incentivar aulas em grupo, desafios e metas de curto prazo.",
            "Oscilação pode ser sazonal, não necessariamente sinal de saída."),
        "Risco Médio-Baixo": (
            "Frequentador Regular",
            "Usa a academia com regularidade. Contrato estável.",
            "Risco moderado, influenciado principalmente pelo prazo do contrato.",
            "Base saudável. Foco em manter engajamento e facilitar renovação.",
            "Comunicação proativa antes do vencimento. Oferta de fidelidade.",
            "Dados de comportamento não capturam motivações externas como mudança de cidade."),
        "Baixo Risco": (
            "Cliente Fiel",
            "Alta frequência, longa relação com a academia, vínculo social estabelecido.",
            "Risco baixo, mas não nulo. Eventos externos podem impactar.",
            "Segmento mais valioso. Preservar e usar como referência de engajamento.",
            "Programa de fidelidade, benefícios exclusivos, convite para indicação.",
            "Clientes leais podem sair por razões não capturadas na base."),
        "Muito Baixo Risco": (
            "Cliente Âncora",
            "Perfil com todos os fatores protetivos ativos e alta fidelidade.",
            "Risco mínimo, mas base valiosa que deve ser ativamente cultivada.",
            "Representam o padrão ideal de cliente. Usar como benchmark.",
            "Programa de embaixadores, benefícios premium, depoimentos.",
            "Perfil raro pode não ser escalável como estratégia de aquisição."),
    },
    "supervised": {
        "Alto Risco": (
            "Desistente em Risco",
            "Score de risco elevado. Combinação de fatores comportamentais desfavoráveis.",
            "Alta probabilidade de não renovar. Sinais de distanciamento identificados.",
            "Grupo prioritário. Intervenção de retenção tem maior impacto aqui.",
            "Abordagem proativa: ligação, oferta personalizada, incentivo de curto prazo.",
            "Alta probabilidade não é certeza. Falsos positivos existem no modelo."),
        "Risco Médio": (
            "Cliente na Encruzilhada",
            "Score intermediário. Pode ir para qualquer direção.",
            "Ainda engajado, mas com sinais mistos. Período crítico de decisão.",
            "Investimento preventivo de médio prazo. ROI moderado esperado.",
            "Comunicação personalizada. Incentivo à participação em comunidade.",
            "Intervalo de risco amplo pode incluir perfis muito distintos entre si."),
        "Baixo Risco": (
            "Cliente Fiel",
            "Perfil consistente com retenção. Frequência e engajamento elevados.",
            "Risco baixo, mas não pode ser ignorado em escala.",
            "Preservar. Custo de retenção baixo, valor ao longo do tempo alto.",
            "Programa de fidelidade. Usar como referência de padrão de sucesso.",
            "Snapshot mensal não captura variações sazonais ou eventos externos."),
    },
    "baseline": {
        "Alto Risco": (
            "Alerta por Regra de Negócio",
            "Perfil identificado por múltiplos critérios de risco interpretáveis.",
            "Contrato curto + baixa frequência + lifetime recente = combinação crítica.",
            "A baseline converge com os modelos estatísticos neste grupo.",
            "Mesmo sem modelo ML, a lógica de negócio aponta este grupo como prioritário.",
            "Regras simples podem classificar erroneamente clientes atípicos."),
        "Risco Médio": (
            "Monitoramento Preventivo",
            "Alguns critérios de risco presentes, compensados por fatores protetivos.",
            "Equilíbrio instável. Uma mudança de comportamento pode deslocar para alto risco.",
            "A baseline recomenda vigilância sem intervenção imediata de alto custo.",
            "Manter monitoramento. Acionar se frequência cair abaixo do limiar.",
            "Regras binárias não capturam nuances de engajamento individual."),
        "Baixo Risco": (
            "Base Segura por Regra",
            "Múltiplos fatores protetivos presentes: grupo, indicação, empresa, proximidade.",
            "Risco baixo no momento, mas base valiosa que deve ser preservada.",
            "A lógica de negócio confirma o que os modelos indicam: este grupo é saudável.",
            "Investir em experiência. Usar para ancorar programas de indicação.",
            "Regras não refletem variações entre contratos de mesma duração."),
    },
}
FIELDS = ["name", "setup", "conflict", "resolution", "decision", "limit"]


def template_family(algorithm: str) -> str:
    if algorithm == "kmeans":
        return "kmeans"
    if algorithm == "business_rules_baseline":
        return "baseline"
    return "supervised"


def template_table(spark: SparkSession, family: str) -> DataFrame:
    rows = [(label, *vals) for label, vals in TEMPLATES[family].items()]
    return spark.createDataFrame(rows, "template_label string, " + ", ".join(f"{f} string" for f in FIELDS))


def personas(segments: DataFrame, algorithm: str, label: str = "label") -> DataFrame:
    """One persona per segment (label, count, churn_rate): its template
    (falling back to the 'Baixo Risco' one) and the observed-churn evidence."""
    fam = template_family(algorithm)
    t = F.broadcast(template_table(segments.sparkSession, fam))
    j = segments.join(t, segments[label] == t.template_label, "left")
    fb = TEMPLATES[fam]["Baixo Risco"]
    rate = dbl("churn_rate")
    evidence = F.when(F.col("churn_rate").isNull(), F.lit("Churn observado não calculado para este segmento.")) \
        .otherwise(F.concat(F.format_string("%.1f", fixed(rate * 100, 1)), F.lit("% de churn observado neste segmento")))
    return j.select(F.col(label).alias("segment_label"), "count", "churn_rate",
                    *[F.coalesce(F.col(f), F.lit(v)).alias(f) for f, v in zip(FIELDS, fb)],
                    evidence.alias("evidence"))
