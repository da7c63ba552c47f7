"""Personal data: base patterns, and terms that give a protected entity away.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each
distinct value is a protected entity. Over the whole corpus the words around
its mentions are counted, ``window`` of them on each side, of whatever length
and in whatever characters; a term ``t`` discloses the entity ``e`` by

    I(t; e) / -log2 P(e)  =  1 - log2 P(e | t) / log2 P(e),

the share of the bits needed to name ``e`` that ``t`` supplies, with P(e | t)
taken over all occurrences of ``t`` in the corpus and P(e) over all mentions.
Equal texts count once in all of these, so copies neither make nor hide
evidence. Terms at or above ``generalise`` are replaced by a placeholder, at or
above ``remove`` taken out. To be evidence, mentions must be independent: in
``support`` different texts that differ within ``AROUND * window`` words of the
mention, or with ``support`` different pairs of words next to the term (across
the mention, if that is next to it). More mentions of a kind never count
against a term. Near copies that differ close to the mention are different.

Null and empty texts have no spans. Texts are read whole, with patterns that
take linear time, and told apart by 64-bit hashes. Repeated rows each give a row.
Columns named ``spans`` are replaced, others pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import Recent, alnum_words, slices, stored, table, texts, tidy, with_columns

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
                                 T.StructField("end", T.IntegerType(), False)]), False)
SPAN_ARROW = pa.list_(pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)]))
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "removed": ""}
#: Terms looked for in one pass; more go into further passes, so that what tasks hold stays bounded.
BLOCK = 200_000
#: The surroundings that tell mentions apart are so many windows wide on each side.
AROUND = 4
#: Bits of the filter of texts that occur more than once (a multiple of 32768).
BITS = 1 << 26


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: the name before it begins as far left as it may."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        name = at
        while name > free and (text[name - 1] in "._%+-" or text[name - 1].isascii() and text[name - 1].isalnum()):
            name -= 1
        free = at + 1  # a later name can't reach back over this @
        if name < at and (m := DOMAIN.match(text, at + 1)):
            out.append((name, m.end()))
            free = m.end()
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def term_spans(text: str, terms: dict[str, str], base: list[tuple[int, int, int]]) -> list[tuple[int, str, int]]:
    """Occurrences of ``terms`` outside the base spans."""
    starts, out = [s for s, _, _ in base], []
    for m in WORD.finditer(text):
        kind = terms.get(m.group().translate(LOWER))
        if kind:
            i = bisect_right(starts, m.start())
            if not any(e > m.start() for _, _, e in base[max(0, i - 4):i]) and (i == len(base) or base[i][0] >= m.end()):
                out.append((m.start(), kind, m.end()))
    return out


def hashed(docs: DataFrame, text: str) -> DataFrame:
    """``text`` and ``h``, which equal texts share."""
    return docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("h"))


def mentions(docs: DataFrame, text: str, window: int) -> DataFrame:
    """For each text, entity and word near its mentions: ``near`` (the words on both sides of the term), ``around``
    (the surroundings of one of the mentions) and the number of times. A row without a term counts the mentions."""
    names = ["h", "entity", "term", "near", "around", "n"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    digest = lambda words: xxhash.xxh3_64_intdigest(" ".join(words).encode()) >> 1

    def run(batches):
        for b in slices(batches, "text"):
            rows = []
            for raw, h in zip(texts(b.column("text")), b.column("h").to_pylist()):
                t = raw.decode("utf-8", "replace")
                spans = base_spans(t)
                if not spans:
                    continue
                found, first = Counter(), {}
                places = [m.span() for m in WORD.finditer(t)]
                starts, ends = [a for a, _ in places], [z for _, z in places]
                for start, kind, end in spans:
                    e = f"{KINDS[kind]}:" + re.sub("[ ()-]", "", t[start:end]).translate(LOWER)
                    found[e, None, None] += 1
                    i, j = bisect_left(starts, start), bisect_right(ends, end)
                    left = [t[a:min(z, start)].translate(LOWER) for a, z in places[max(0, i - AROUND * window):i]]
                    right = [t[max(a, end):z].translate(LOWER) for a, z in places[j:j + AROUND * window]]
                    around = digest([*left, "*", *right])
                    words, at = left + right, len(left)
                    for k in range(max(0, at - window), min(len(words), at + window)):
                        w = words[k]
                        found[e, w, digest([*words[max(0, k - 1):k], "*", *words[k + 1:k + 2]])] += 1
                        first[e, w] = min(around, first.get((e, w), around))
                rows += [(h, e, w, near, first.get((e, w)), n) for (e, w, near), n in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

    return hashed(docs, text).mapInArrow(tidy(run), "h long, entity string, term string, near long, around long, n long")


def blocks(terms: DataFrame) -> list[dict[str, str]]:
    """``term``, ``kind`` in blocks of at most BLOCK terms, one in the driver's hands at a time."""
    block: dict[str, str] = {}
    for r in terms.toLocalIterator():
        block[r["term"]] = r["kind"]
        if len(block) >= BLOCK:
            yield block
            block = {}
    if block:
        yield block


def copied(docs: DataFrame, text: str) -> np.ndarray:
    """A filter of fixed size: bit ``h % BITS`` is set for every text that more than one row has, and maybe for others."""
    again = hashed(docs, text).groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").select((F.pmod("h", F.lit(BITS)) + 1).alias("x"))
    out = np.zeros((BITS >> 15, 4096), np.uint8)
    for r in again.groupBy(F.bitmap_bucket_number("x").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).toLocalIterator():
        out[r["k"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def counted(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame | None:
    """``term``, ``n``: occurrences of each term in all different texts. Tasks add up what only one row has; the counts
    of a text that may have copies go out under its hash, so that they meet and count once."""
    out, spark, again = None, docs.sparkSession, None
    for block in blocks(terms.select("term", F.lit("").alias("kind"))):
        again = again or spark.sparkContext.broadcast(copied(docs, text))
        shared = spark.sparkContext.broadcast({t.encode() for t in block})

        def run(batches, shared=shared, again=again):
            total, wanted, bits, seen = Counter(), shared.value, again.value, Recent(lambda ks: [(k, None) for k in ks])
            rows = lambda n: pa.RecordBatch.from_arrays([pa.array([h for h, _ in n], pa.int64()), pa.array([k.decode() for _, k in n], pa.string()),
                                                         pa.array(list(n.values()), pa.int64())], ["h", "term", "n"])
            for b in slices(batches, "text"):
                own = {}
                for t, h in zip(texts(b.column("text")), b.column("h").to_pylist()):
                    x = h % BITS
                    if not bits[x >> 3] >> (x & 7) & 1:
                        total.update(filter(wanted.__contains__, alnum_words(t)))
                    elif h not in seen.now and h not in seen.old:
                        seen.of({h})
                        own.update({(h, k): n for k, n in Counter(filter(wanted.__contains__, alnum_words(t))).items()})
                yield rows(own)
            yield rows({(None, k): n for k, n in total.items()})

        n = hashed(docs, text).mapInArrow(tidy(run), "h long, term string, n long").groupBy("h", "term").agg(F.sum("n").alias("all"), F.max("n").alias("one"))
        n = n.groupBy("term").agg(F.sum(F.when(F.col("h").isNull(), F.col("all")).otherwise(F.col("one"))).alias("n"))
        out = n if out is None else out.union(n)
    return out


def disclosing(docs: DataFrame, text: str = "text", window: int = 6, support: int = 3, generalise: float = 0.8,
               remove: float = 0.95) -> DataFrame | None:
    """Terms that disclose a protected entity: ``term``, ``kind`` ("term": to generalise, "removed": to take out),
    ``disclosure``. None where no term has enough independent evidence."""
    seen = stored(mentions(docs, text, window).groupBy("h", "entity", "term", "near", "around").agg(F.max("n").alias("n")), "pii-mentions")
    pairs = (seen.where("term is not null").groupBy("entity", "term")
             .agg(F.sum("n").alias("n_te"), F.count_distinct("around").alias("arounds"), F.count_distinct("near").alias("nears"))
             .where(F.greatest("arounds", "nears") >= support).select("entity", "term", "n_te"))
    sums = seen.where("term is null").groupBy("entity").agg(F.sum("n").alias("n_e"))
    total = sums.agg(F.sum("n_e")).first()[0] or 0
    share = lambda n: 1 - F.log2(F.least(F.lit(1.0), F.col("n_te") / n)) / F.log2(F.col("n_e") / F.lit(float(total + 1)))
    # a term occurs at least once in each text that has it near a mention: what is too rare for that need not be counted
    near = seen.where("term is not null").groupBy("term").agg(F.count_distinct("h").alias("texts"))
    pairs = stored(pairs.join(sums, "entity").join(near, "term").where(share(F.col("texts")) >= generalise), "pii-pairs")
    n = counted(docs, text, pairs.select("term").distinct())
    if n is None:
        return None
    terms = (pairs.join(n, "term").groupBy("term").agg(F.max(share(F.greatest("n", "texts"))).alias("disclosure"))
             .where(F.col("disclosure") >= generalise)
             .select("term", F.when(F.col("disclosure") >= remove, "removed").otherwise("term").alias("kind"), "disclosure"))
    return stored(terms, "pii-terms")


def find(docs: DataFrame, terms: DataFrame | None = None, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add ``spans`` (or as named): base spans and occurrences of ``terms``, by start and then kind, in code points."""
    out, spark = docs, docs.sparkSession
    for i, block in enumerate(list_or_empty(terms)):
        shared = spark.sparkContext.broadcast(block) if block else None
        schema = with_columns(out.schema, [T.StructField(spans, SPAN, False)])
        kept = [f.name for f in schema if f.name != spans]

        def run(batches, shared=shared, first=i == 0, kept=kept):
            wanted = shared.value if shared else {}
            quick = {t.encode() for t in wanted}
            for b in slices(batches, text):
                rows = []
                old = [[]] * b.num_rows if first else b.column(spans).to_pylist()
                for raw, had in zip(texts(b.column(text)), old):
                    t = raw.decode("utf-8", "replace")
                    base = base_spans(t)
                    found = [(s, KINDS[k], e) for s, k, e in base] if first else [(x["start"], x["kind"], x["end"]) for x in had]
                    if quick and not quick.isdisjoint(alnum_words(raw)):
                        found += term_spans(t, wanted, base)
                    order = (*KINDS, "term", "removed")
                    rows.append([{"kind": k, "start": s, "end": e} for s, k, e in sorted(found, key=lambda x: (x[0], order.index(x[1]), x[2]))])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(rows, SPAN_ARROW)], [*kept, spans])

        out = out.mapInArrow(tidy(run), schema)
    return out


def list_or_empty(terms: DataFrame | None):
    """The blocks of terms, or one empty block, so that base spans are always looked for."""
    some = False
    for block in blocks(terms) if terms is not None else ():
        some = True
        yield block
    if not some:
        yield {}


def redact(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace each span by its kind's placeholder (terms to remove by nothing). Overlapping spans: the earliest wins."""
    kept = found.columns

    def run(batches):
        for b in slices(batches, text):
            out = []
            for raw, here in zip(b.column(text).to_pylist(), b.column(spans).to_pylist()):
                if here and raw:
                    parts, at = [], 0
                    for s in here:
                        if s["start"] >= at:
                            parts += raw[at:s["start"]], PLACEHOLDER[s["kind"]]
                            at = s["end"]
                        elif s["end"] > at:
                            at = s["end"]  # covered by the placeholder before it
                    raw = "".join([*parts, raw[at:]])
                out.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text else b.column(c) for c in kept], kept)

    return found.mapInArrow(tidy(run), found.schema)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; all rows and columns stay."""
    own = "spans__"
    while own in docs.columns:
        own += "_"
    return redact(find(docs, disclosing(docs, text), text, own), text, own).select(docs.columns)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of base spans, the digest of their places, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, disclosing(docs)).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
