"""Text column expressions (F12-F22): guardrails on recommendation text,
channel cleaning, JSON extraction, driver lines and speech normalisation.

All are Spark SQL expressions (Java regex via ``regexp_replace``); the whole
text is processed, never a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col, dbl, fixed

# Allowed contact channels and limits.
ALLOWED_CHANNELS = ["e-mail", "whatsapp", "push", "ligacao", "sms"]
MAX_CHANNELS = 2
MAX_DISCOUNT_PCT = 20

# What a blank is in the reference's patterns (the no-break and the wide ones too).
BLANK = r"[\x09-\x0D \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
# A percentage written with 1-3 digits, read as the leftmost-longest match that a
# scan for 1-3 digits, a blank or none and the sign takes, restricted to values above 20.
CAP_PATTERN = rf"(0?(2[1-9]|[3-9][0-9])|[1-9][0-9]{{2}}){BLANK}?%"


def cap_discount(text: Column | str) -> Column:
    """any percentage above 20 in the text becomes '20%'."""
    return F.regexp_replace(col(text), CAP_PATTERN, f"{MAX_DISCOUNT_PCT}%")


def clean_channels(arr: Column | str) -> Column:
    """lower/trim, keep channels that contain or are contained in an
    allowed one, at most 2, default ['e-mail']."""
    allowed = F.array(*[F.lit(a) for a in ALLOWED_CHANNELS])
    norm = F.transform(F.coalesce(col(arr), F.array().cast("array<string>")), lambda c: F.trim(F.lower(c)))
    kept = F.filter(norm, lambda c: F.exists(allowed, lambda a: (F.instr(c, a) > 0) | (F.instr(a, c) > 0)))
    kept = F.slice(kept, 1, MAX_CHANNELS)
    return F.when(F.size(kept) == 0, F.array(F.lit("e-mail"))).otherwise(kept)


def join_channels(arr: Column | str) -> Column:
    """channel array to comma-separated text."""
    return F.array_join(col(arr), ", ")


def extract_json(text: Column | str, schema: str) -> Column:
    """F16: parse the substring from the first '{' to the last '}' with a fixed
    schema; null when there is no object or it does not parse."""
    body = F.regexp_extract(col(text), r"(?s)\{.*\}", 0)
    return F.when(body != "", F.from_json(body, schema, {"mode": "PERMISSIVE"}))


def fmt_pct(p: Column | str, digits: int = 1) -> Column:
    """0.1234 -> '12.3%'."""
    return F.concat(F.format_string(f"%.{digits}f", fixed(dbl(p) * 100, digits)), F.lit("%"))


def fmt_brl(v: Column | str) -> Column:
    """'R$ 1.234' (pt-BR grouping, no decimals)."""
    n = F.format_number(F.floor(dbl(v) + 0.5), 0)
    return F.concat(F.lit("R$ "), F.translate(n, ",", "."))


def fmt_compact(v: Column | str) -> Column:
    """compact notation with one decimal: 12400 -> '12,4 mil'."""
    x = dbl(v)
    one = lambda y: F.regexp_replace(F.translate(F.format_string("%.1f", fixed(y, 1)), ".", ","), ",0$", "")
    return (F.when(F.abs(x) >= 1e9, F.concat(one(x / 1e9), F.lit(" bi")))
            .when(F.abs(x) >= 1e6, F.concat(one(x / 1e6), F.lit(" mi")))
            .when(F.abs(x) >= 1e3, F.concat(one(x / 1e3), F.lit(" mil")))
            .otherwise(one(x)))


def driver_lines(drivers: Column | str, labels: dict[str, str], k: int = 5) -> Column:
    """top-k drivers as text lines; whole values without decimals."""
    number = lambda v: F.when(v == F.floor(v), v.cast("bigint").cast("string")).otherwise(v.cast("string"))
    lab = F.create_map(*[x for a, b in labels.items() for x in (F.lit(a), F.lit(b))])
    lines = F.transform(F.slice(col(drivers), 1, k), lambda d: F.concat(
        F.lit("- "), F.coalesce(lab[d.feature], d.feature), F.lit(" = "), number(d.value),
        F.lit(" (SHAP "), F.format_string("%.3f", fixed(d.shap_value, 3)), F.lit(", "),
        F.when(d.direction == "up", "aumenta o risco").otherwise("reduz o risco"), F.lit(", "),
        F.when(d.actionable, "acionável").otherwise("não-acionável"), F.lit(")")))
    return F.array_join(lines, "\n")


def features_from_json(text: Column | str, schema) -> Column:
    """snapshot JSON to a typed struct."""
    return F.from_json(col(text), schema)


# ---------------------------------------------------------------------------
# Speech normalisation (pt-BR). Patterns use (?d) so that only \n
# ends a line, as in the SQL twin.
# ---------------------------------------------------------------------------
# JavaScript's \b is ASCII-only; Java 17's is Unicode-aware (an accented
# letter counts as a word character). Spell the ASCII boundary out for Java.
_W = "[A-Za-z0-9_]"
ASCII_BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"


def _at_word(letters: str) -> str:
    """``\b`` and these letters. The letters come first, so that most positions are passed by one comparison; that no word
    character stands before them is asked where they match."""
    return f"{letters}(?<!{_W}{letters})"


# Abbreviation expansions, in application order.
ABBREVIATIONS = [
    (rf"(?i){_at_word('p')}\.?\s?ex\.?\b", "por exemplo"),
    (rf"(?i){_at_word('ex')}\.:", "por exemplo:"),
    (rf"(?i){_at_word('etc')}\.?\b", "etcétera"),
    (rf"(?i){_at_word('vs')}\.?\b", "versus"),
    (rf"(?i){_at_word('n')}[ºo]\.?\s?(?=\d)", "número "),
    (rf"(?i){_at_word('art')}\.\s?(?=\d)", "artigo "),
    (rf"{_at_word('Dra')}\.\s", "Doutora "),
    (rf"{_at_word('Dr')}\.\s", "Doutor "),
    (rf"{_at_word('Sr')}\.\s", "Senhor "),
    (rf"{_at_word('Sra')}\.\s", "Senhora "),
]

# The steps of the speech normalisation and their order. Loops are
# possessive and start at the beginning of a run only, so that each step takes
# linear time.
SPEECH_STEPS = [
    (r"```[\s\S]*?```", " "),
    (r"`([^`]+)`", "$1"),
    # A text without "](" is taken whole by the first alternative, so no bracket is tried one by one.
    (r"(?s)\A(?!.*?\]\()(.++)|!\[([^\]]*+)\]\([^)]*+\)", "$1$2"),
    (r"(?s)\A(?!.*?\]\()(.++)|\[([^\]]++)\]\([^)]*+\)", "$1$2"),
    (r"https?://[^\s)]+", ""),
    (rf"{_at_word('www')}\.[^\s)]+", ""),
    (r"(?md)^\s{0,3}#{1,6}\s*", ""),
    (r"(?md)^\s{0,3}>\s?", ""),
    # The second alternative passes over a run of blank lines at once.
    (r"(?md)^\s*+[-*+•]\s++|^(\s++)", "$1"),
    (r"(?md)^\s*+\d++[.)]\s++|^(\s++)", "$1"),
    (r"(?d)(?=[*_~])(\*\*|\*|__|_|~~)(.*?)\1", "$2"),
    (r"R\$\s?([\d.,]+)", "$1 reais"),
    (r"%", " por cento"),
    (r"&", " e "),
    (r"(?:(?<!\s)\s++)?+[—–]\s*+", ", "),
    (r"(?:(?<!\s)\s++)?+/\s*+", " "),
    (r"[=<>|^~*#]+", " "),
    (r"\.{3,}", "…"),
] + ABBREVIATIONS + [
    (r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2190}-\x{21FF}\x{2B00}-\x{2BFF}\x{FE0F}]", ""),
    (r"[ \t]{2,}", " "),
    (r"[ \t]*\n{2,}[ \t]*", ". "),
    (r"[ \t]*\n[ \t]*", ". "),
    (r"\.\s*+\.[.\s]*+", ". "),
    (r"(?<!\s)\s++([,.;:!?…])", "$1"),
    (r"([,;:])(?=\S)", "$1 "),
    (r"\s{2,}", " "),
]


def _java(pattern: str) -> str:
    return pattern.replace(r"\b", ASCII_BOUNDARY)


def normalize_text(text: Column | str) -> Column:
    """strip code, links, URLs, headings, lists, emphasis; expand
    currency, percent and abbreviations; drop emoji; tidy spacing; end with
    terminal punctuation. Null or empty text gives ''."""
    t = F.coalesce(col(text), F.lit(""))
    for pat, rep in SPEECH_STEPS:
        t = F.regexp_replace(t, _java(pat), rep)
    t = F.regexp_replace(t, r"\s(?:(?<=\A\s)\s*+|(?<!\s\s)\s*+\z)", "")
    # One more step instead of a CASE, which would evaluate the whole chain once per branch.
    return F.regexp_replace(t, r"([^.!?…])\z", "$1.")


def chunk_text(text: Column | str, max_chars: int = 600) -> Column:
    """F20 on raw text: normalise, then pack. The lambda's variable holds the
    normalised text, so the regex chain runs once per row."""
    return F.transform(F.array(normalize_text(text)), lambda t: chunk_normalized(t, max_chars))[0]


def chunk_normalized(clean: Column | str, max_chars: int = 600) -> Column:
    """normalised text packed greedily into blocks of whole sentences of
    at most ``max_chars`` (a single longer sentence stays whole). Returns an
    array; ``posexplode`` gives one row per block. One ``aggregate`` over the
    sentence array, per row, no UDF."""
    clean = col(clean)
    sents = F.regexp_extract_all(clean, F.lit(r"([^.!?…]+[.!?…]*)"), 1)
    sents = F.when(F.size(sents) > 0, sents).otherwise(F.array(clean))
    init = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc, s):
        flush = (F.length(F.concat(acc.cur, s)) > max_chars) & (acc.cur != "")
        return F.struct(
            F.when(flush, F.concat(acc.done, F.array(F.trim(acc.cur)))).otherwise(acc.done).alias("done"),
            F.when(flush, s).otherwise(F.concat(acc.cur, s)).alias("cur"))

    packed = F.aggregate(sents, init, step,
                         lambda acc: F.when(F.trim(acc.cur) != "", F.concat(acc.done, F.array(F.trim(acc.cur))))
                         .otherwise(acc.done))
    return (F.when(clean == "", F.array().cast("array<string>"))
            .when(F.length(clean) <= max_chars, F.array(clean))
            .otherwise(packed))
