"""Text guardrails and formatting (F12-F16, F19, F20) on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from churnwise.functions import text as T

CAP_CASES = [("10% off", "10% off"), ("25% e 100 %", "20% e 20%"), ("021%", "20%"), ("20%", "20%"),
             ("1050%", "120%"), ("99 %", "20%")]


def test_cap_discount(spark):
    df = spark.createDataFrame([(a,) for a, _ in CAP_CASES], "t string")
    got = [r[0] for r in df.select(T.cap_discount("t")).collect()]
    assert got == [b for _, b in CAP_CASES]


def test_clean_channels(spark):
    df = spark.createDataFrame([(["  WhatsApp ", "fax", "Push", "sms"],), (["fax"],), (None,)], "c array<string>")
    got = [r[0] for r in df.select(T.clean_channels("c")).collect()]
    assert got == [["whatsapp", "push"], ["e-mail"], ["e-mail"]]


def test_extract_json(spark):
    df = spark.createDataFrame([('ok {"narrative": "x", "n": 2} tail',), ("no json",), ("{bad",)], "t string")
    got = df.select(T.extract_json("t", "narrative string, n int").alias("j")).collect()
    assert got[0].j.narrative == "x" and got[0].j.n == 2
    assert got[1].j is None and got[2].j is None


def test_formats(spark):
    r = spark.range(1).select(T.fmt_pct(F.lit(0.1234)).alias("p"), T.fmt_brl(F.lit(1234.4)).alias("b"),
                              T.fmt_compact(F.lit(12400)).alias("c")).first()
    assert (r.p, r.b, r.c) == ("12.3%", "R$ 1.234", "12,4 mil")


def test_normalize_text(spark):
    src = ("## Título\n\n- item **forte** e `code` em [link](http://x.y) R$ 40,00 & 35%...\n"
           "Veja p. ex. o nº 5 etc")
    out = spark.createDataFrame([(src,)], "t string").select(T.normalize_text("t")).first()[0]
    # as the reference's patterns do: a space follows every comma, and the
    # trailing \b of 'p. ex.' leaves the final period in place
    assert out == ("Título. item forte e code em link 40, 00 reais e 35 por cento…. "
                   "Veja por exemplo. o número 5 etcétera.")


def test_chunk_text(spark):
    s = " ".join(f"Frase numero {i} com algum texto." for i in range(60))
    chunks = spark.createDataFrame([(s,)], "t string").select(T.chunk_text("t", 100)).first()[0]
    assert all(len(c) <= 100 for c in chunks) and " ".join(chunks) == s


def test_long_runs_take_linear_time(spark):
    n = 100_000
    rows = [". " * n, " " * n, "[a" * n, "![" * n, "\n" * n, "-" * n, " —" * n, "a  " * n, "1. \n" * n, "/ " * n]
    out = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
           .select("i", T.normalize_text("t").alias("s")).orderBy("i").select("s").collect()]
    assert out[0] == "." and out[1] == "" and out[2] == rows[2] + "." and out[4] == "." and out[7].startswith("a a a")


def test_linear_patterns_equal_the_plain_ones(spark):
    """Each rewritten step against its plain form, on random short texts."""
    import random
    plain = {r"(?s)\A(?!.*?\]\()(.++)|!\[([^\]]*+)\]\([^)]*+\)": (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
             r"(?s)\A(?!.*?\]\()(.++)|\[([^\]]++)\]\([^)]*+\)": (r"\[([^\]]+)\]\([^)]*\)", "$1"),
             r"(?md)^\s*+[-*+•]\s++|^(\s++)": (r"(?md)^\s*[-*+•]\s+", ""),
             r"(?md)^\s*+\d++[.)]\s++|^(\s++)": (r"(?md)^\s*\d+[.)]\s+", ""),
             r"(?:(?<!\s)\s++)?+[—–]\s*+": (r"\s*[—–]\s*", ", "),
             r"(?:(?<!\s)\s++)?+/\s*+": (r"\s*/\s*", " "),
             r"\.\s*+\.[.\s]*+": (r"(?:\.\s*){2,}", ". "),
             r"(?<!\s)\s++([,.;:!?…])": (r"\s+([,.;:!?…])", "$1")}
    steps = dict(T.SPEECH_STEPS)
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(["a", "[", "]", "(", ")", "!", " ", "  ", "\n", "-", "*", "1", ".", ")", "—", "/", ",", "\t", "]("])
                     for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for new, (old, rep) in plain.items():
        bad = df.where(F.regexp_replace("t", new, steps[new]) != F.regexp_replace("t", old, rep)).collect()
        assert not bad, (new, bad[:3])
