"""Registered text and persona queries (F19, F20, W9, F21, D9) over whole
texts. The DuckDB twins restate every pattern for RE2 (no look-around, no
back-references): look-aheads become captured groups, the emphasis
back-reference becomes an ordered alternation, and the 'space after
punctuation' look-ahead becomes two consuming passes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ...functions.core import fixed
from ...functions.text import chunk_normalized, normalize_text
from ...operators.personas import TEMPLATES, personas
from ...sources.members import read_table, spread_scan
from ..oracle_sql import fx, with_members
from ..registry import register
from .core import scored_members
from .decisions import _H2_SQL

# RE2 forms of the speech normalisation steps (same order as the Spark chain).
SQL_STEPS = [
    (r"```[\s\S]*?```", " "),
    (r"`([^`]+)`", r"\1"),
    (r"!\[([^\]]*)\]\([^)]*\)", r"\1"),
    (r"\[([^\]]+)\]\([^)]*\)", r"\1"),
    (r"https?://[^\s)]+", ""),
    (r"\bwww\.[^\s)]+", ""),
    (r"(?m)^\s{0,3}#{1,6}\s*", ""),
    (r"(?m)^\s{0,3}>\s?", ""),
    (r"(?m)^\s*[-*+•]\s+", ""),
    (r"(?m)^\s*\d+[.)]\s+", ""),
    (r"\*\*(.*?)\*\*|\*(.*?)\*|__(.*?)__|_(.*?)_|~~(.*?)~~", r"\1\2\3\4\5"),
    (r"R\$\s?([\d.,]+)", r"\1 reais"),
    (r"%", " por cento"),
    (r"&", " e "),
    (r"\s*[—–]\s*", ", "),
    (r"\s*/\s*", " "),
    (r"[=<>|^~*#]+", " "),
    (r"\.{3,}", "…"),
    (r"(?i)\bp\.?\s?ex\.?\b", "por exemplo"),
    (r"(?i)\bex\.:", "por exemplo:"),
    (r"(?i)\betc\.?\b", "etcétera"),
    (r"(?i)\bvs\.?\b", "versus"),
    (r"(?i)\bn[ºo]\.?\s?(\d)", r"número \1"),
    (r"(?i)\bart\.\s?(\d)", r"artigo \1"),
    (r"\bDra\.\s", "Doutora "),
    (r"\bDr\.\s", "Doutor "),
    (r"\bSr\.\s", "Senhor "),
    (r"\bSra\.\s", "Senhora "),
    (r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2190}-\x{21FF}\x{2B00}-\x{2BFF}\x{FE0F}]", ""),
    (r"[ \t]{2,}", " "),
    (r"[ \t]*\n{2,}[ \t]*", ". "),
    (r"[ \t]*\n[ \t]*", ". "),
    (r"(?:\.\s*){2,}", ". "),
    (r"\s+([,.;:!?…])", r"\1"),
    (r"([,;:])(\S)", r"\1 \2"),
    (r"([,;:])(\S)", r"\1 \2"),
    (r"\s{2,}", " "),
]


def normalize_sql(expr: str) -> str:
    t = f"COALESCE({expr}, '')"
    for pat, rep in SQL_STEPS:
        t = f"regexp_replace({t}, '{pat}', '{rep}', 'g')"
    t = f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
    return (f"(CASE WHEN {t} = '' THEN '' WHEN regexp_matches({t}, '[.!?…]$') THEN {t} "
            f"ELSE {t} || '.' END)")


@register("f19_normalize_conversations",
          f"SELECT conv_id, turn, {normalize_sql('text')} AS speech FROM conversations")
def q_normalize_conversations(spark, sf_dir):
    c = spread_scan(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return c.select("conv_id", "turn", normalize_text("text").alias("speech"))


@register("f19_normalize_documents",
          f"SELECT doc_id, length({normalize_sql('text')}) AS speech_chars, "
          f"md5({normalize_sql('text')}) AS speech_md5 FROM documents")
def q_normalize_documents(spark, sf_dir):
    """Whole documents (up to tens of thousands of characters each)."""
    d = spread_scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", normalize_text("text").alias("s"))
    return d.select("doc_id", F.length("s").alias("speech_chars"), F.md5("s").alias("speech_md5"))


CHUNK_SQL = f"""
SELECT * FROM (WITH RECURSIVE
 norm AS (SELECT conv_id, turn, {normalize_sql('text')} AS clean FROM conversations),
 lists AS (SELECT conv_id, turn, clean, CASE WHEN len(regexp_extract_all(clean, '[^.!?…]+[.!?…]*')) > 0
           THEN regexp_extract_all(clean, '[^.!?…]+[.!?…]*') ELSE [clean] END AS l FROM norm WHERE length(clean) > 600),
 sents AS (SELECT conv_id, turn, UNNEST(l) AS s, UNNEST(generate_series(1, len(l))) AS i FROM lists),
 r AS (SELECT conv_id, turn, i, s AS cur, 0 AS k, CAST(NULL AS VARCHAR) AS out FROM sents WHERE i = 1
       UNION ALL
       SELECT r.conv_id, r.turn, r.i + 1,
              CASE WHEN length(r.cur || s.s) > 600 AND r.cur <> '' THEN s.s ELSE r.cur || s.s END,
              CASE WHEN length(r.cur || s.s) > 600 AND r.cur <> '' THEN r.k + 1 ELSE r.k END,
              CASE WHEN length(r.cur || s.s) > 600 AND r.cur <> '' THEN trim(r.cur) END
       FROM r JOIN sents s ON s.conv_id = r.conv_id AND s.turn = r.turn AND s.i = r.i + 1),
 emitted AS (SELECT conv_id, turn, k - 1 AS chunk_index, out AS chunk FROM r WHERE out IS NOT NULL
             UNION ALL
             SELECT conv_id, turn, k, trim(cur) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id, turn
                   ORDER BY i DESC) AS rn FROM r) WHERE rn = 1 AND trim(cur) <> '')
 SELECT * FROM emitted
 UNION ALL
 SELECT conv_id, turn, 0, clean FROM norm WHERE clean <> '' AND length(clean) <= 600)"""


@register("f20_chunk_conversations", CHUNK_SQL)
def q_chunk(spark, sf_dir):
    c = spread_scan(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    c = c.select("conv_id", "turn", normalize_text("text").alias("clean"))
    ch = c.select("conv_id", "turn", F.posexplode(chunk_normalized("clean", 600)).alias("chunk_index", "chunk"))
    return ch


@register("w9_last_turns", """
SELECT conv_id, turn, role, substring(text, 1, 1500) AS content FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations
  WHERE role IN ('user', 'assistant')) WHERE rn <= 12""")
def q_last_turns(spark, sf_dir):
    """Last 12 user/assistant messages per conversation, 1500 characters each.
    The rank filter becomes a window group limit: each task keeps only its
    top 12 per conversation before the shuffle, so a huge conversation does
    not travel whole."""
    c = read_table(spark, sf_dir, "conversations").filter(F.col("role").isin("user", "assistant"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return (c.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 12)
            .select("conv_id", "turn", "role", F.substring("text", 1, 1500).alias("content")))


@register("f21_event_props", """
SELECT event_type, COUNT(*) AS events, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
       COUNT(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS missing_k FROM events GROUP BY event_type""")
def q_event_props(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_type",
                                                    F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("k").cast("bigint").alias("k_total"),
                                       F.count_if(F.col("k").isNull()).alias("missing_k"))


def _persona_sql(family: str, seg_sql: str) -> str:
    rows = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (lab,) + vals) + ")"
                     for lab, vals in TEMPLATES[family].items())
    fb = TEMPLATES[family]["Baixo Risco"]
    cols = ", ".join(f"COALESCE(t.f{i}, '{v}') AS {n}" for i, (n, v) in
                     enumerate(zip(["name", "setup", "conflict", "resolution", "decision", "limit"], fb)))
    return (f"SELECT s.label AS segment_label, s.count, s.churn_rate, {cols}, "
            "CASE WHEN s.churn_rate IS NULL THEN 'Churn observado não calculado para este segmento.' "
            f"ELSE printf('%.1f', {fx('s.churn_rate * 100', 1)}) || '% de churn observado neste segmento' END AS evidence "
            f"FROM ({seg_sql}) s LEFT JOIN (VALUES {rows}) t(label, f0, f1, f2, f3, f4, f5) ON t.label = s.label")


_H3_SEG = ("SELECT l.label, COUNT(h.customer_id) AS count, CASE WHEN COUNT(h.customer_id) > 0 THEN "
           f"{fx('SUM(CAST(m.Churn AS DOUBLE)) / COUNT(h.customer_id)', 4)} END AS churn_rate FROM "
           "(VALUES ('Alto Risco'), ('Risco Médio'), ('Baixo Risco')) l(label) "
           f"LEFT JOIN ({_H2_SQL}) h ON h.risk_label = l.label LEFT JOIN members m ON m.customer_id = h.customer_id "
           "GROUP BY l.label")


@register("d9_personas_rule_segments", with_members(_persona_sql("baseline", _H3_SEG)))
def q_personas(spark, sf_dir):
    """Personas for the rule-baseline segments (H3)."""
    from .decisions import q_rule_segments
    seg = q_rule_segments(spark, sf_dir)
    return personas(seg, "business_rules_baseline")


#: tier -> segment label; one label that no template has
_TIER_LABELS = {"kmeans": {"critico": "Alto Risco", "alto": "Risco Médio-Alto", "medio": "Risco Médio-Baixo", "baixo": "Baixo Risco"},
                "supervised": {"critico": "Alto Risco", "alto": "Risco Médio", "medio": "Outro", "baixo": "Baixo Risco"}}


def _tier_seg_sql(family: str) -> str:
    labels = ", ".join(f"('{t}', '{x}')" for t, x in _TIER_LABELS[family].items())
    return (f"SELECT l.label, COUNT(*) AS count, {fx('SUM(CAST(s.Churn AS DOUBLE)) / COUNT(*)', 4)} AS churn_rate "
            f"FROM scored s JOIN (VALUES {labels}) l(tier, label) ON l.tier = s.risk_tier GROUP BY l.label")


def _tier_personas(spark, sf_dir, family, algorithm):
    _, s = scored_members(spark, sf_dir)
    label = F.create_map(*[F.lit(x) for kv in _TIER_LABELS[family].items() for x in kv])[F.col("risk_tier")]
    seg = s.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("count"), fixed(F.avg(F.col("Churn").cast("double")), 4).alias("churn_rate"))
    return personas(seg, algorithm)


@register("d9_personas_kmeans", with_members(_persona_sql("kmeans", _tier_seg_sql("kmeans")), scored=True))
def q_personas_kmeans(spark, sf_dir):
    """Personas of the clusters' family, for segments by risk tier."""
    return _tier_personas(spark, sf_dir, "kmeans", "kmeans")


@register("d9_personas_supervised", with_members(_persona_sql("supervised", _tier_seg_sql("supervised")), scored=True))
def q_personas_supervised(spark, sf_dir):
    """Personas of the supervised models' family, for segments by risk tier; one falls back to another's template."""
    return _tier_personas(spark, sf_dir, "supervised", "random_forest")
