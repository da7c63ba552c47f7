"""Filter interaction audit with wide packed counters.

Five filters are applied to every document; which of them it fails is a mask of five bits, and with its two labels a
code of seven. What happens to a document at each of the 5 steps of each of the 120 orders follows from its code alone,
so every code is mapped to one big integer whose 64-bit fields hold all 600 step outcomes times ``COUNTERS``. The
integers are added up per part, each times the number of documents that have its code; a field never reaches its
neighbour, as no count reaches 2^64. Unpacking the sum gives all steps of a part at once.

Failure conditions (words: maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive):
A under 50 words; B 100 * distinct words < 65 * words; C 100 * ``[A-Z]`` > 5 * code points; D holds any ``[#$%&*|]``;
E identical to the text of any smaller doc_id of the table, removed or not.

Texts are read once, whole, into narrow rows (digest, bits A to D, part, doc_id), which are stored. E needs the smallest
doc_id of each digest (a partial minimum) and an equi-join on (digest, doc_id), so a text with any number of copies is
dealt out by doc_id; labels meet the rows by ``skew.left_join``. A task that adds up parts holds one integer (24 KB) and
the 128 of the codes.

A null text is empty: it fails A alone (B to D compare 0 with 0), and E if a smaller doc_id's is null or empty too. A
null doc_id is neither smaller than any nor has a smaller one, and has no label. Rows that repeat a doc_id count each;
of these, equal texts do not make each other fail E. Several labels of a doc_id count as one that holds if any does; a
null label does not. Null and empty parts are one. An empty table gives no rows. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import runs, slices, stored, table, texts
from .skew import left_join

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(o, i + 1) for o in ORDERS for i in range(len(FILTERS))]
COUNTERS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
FIELD = 8  # bytes
GOOD, TOXIC = 1 << 5, 1 << 6
CODES = 1 << 7

_UPPER, _MARKS, _TAILS = bytes(range(0x41, 0x5B)), b"#$%&*|", bytes(range(0x80, 0xC0))
FACTS = "doc_id long, part string, digest binary, bits int"
AUDIT = ("part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTERS)
         + ", unique_fails long, shapley long")


def bits(text: bytes) -> int:
    """Bits 0 to 3 for the filters A to D that a UTF-8 text fails."""
    words = text.split()
    n, size = len(words), len(text)
    upper = size - len(text.translate(None, _UPPER))
    points = size - (0 if text.isascii() else size - len(text.translate(None, _TAILS)))
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * upper > 5 * points) << 2
            | (len(text.translate(None, _MARKS)) < size) << 3)


def outcome(code: int, order: str, step: int) -> tuple[int, ...]:
    """COUNTERS of one document of ``code`` at a step: 0 or 1 each."""
    fails = lambda letter: code >> FILTERS.index(letter) & 1
    before = any(map(fails, order[:step - 1]))
    here = fails(order[step - 1])
    removed = here and not before
    return (int(not before and not here), int(removed), int(here and before),
            int(removed and bool(code & GOOD)), int(removed and bool(code & TOXIC)))


def packed(code: int) -> int:
    """The big integer of a code: a field for every step and counter, in the order of STEPS and COUNTERS."""
    fields = [x for order, step in STEPS for x in outcome(code, order, step)]
    return int.from_bytes(np.array(fields, "<u8").tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """Fields of a sum of packed integers: steps x counters."""
    raw = total.to_bytes(len(STEPS) * len(COUNTERS) * FIELD, "little")
    return np.frombuffer(raw, "<u8").astype(np.int64).reshape(len(STEPS), len(COUNTERS))


def facts(docs: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """Per row: doc_id, part, digest of its text and the bits of A to D (FACTS)."""
    def run(batches):
        for b in slices(batches, "text"):
            here = texts(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array([hashlib.sha256(t).digest() for t in here], pa.binary()),
                 pa.array([bits(t) for t in here], pa.int32())], ["doc_id", "part", "digest", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(run, FACTS)


def coded(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Numbers of documents by ``part`` and ``code``, from stored FACTS."""
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")) * GOOD
         + F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")) * TOXIC).alias("flags")).where("doc_id is not null")
    same = rows.groupBy("digest", "doc_id", "part", "bits").agg(F.count("*").alias("n"))  # repeated rows become one
    known = stored(left_join(stored(same, "audit-rows"), flags, "doc_id").withColumn("code", F.col("bits") + F.coalesce("flags", F.lit(0)))
                   .select("digest", "doc_id", "part", "code", "n"), "audit-coded")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")
    per = lambda df, sign: df.groupBy("part", "code").agg(F.sum(F.col("n") * sign).alias("n"))
    unique = per(known.where("doc_id is null").unionByName(known.join(first, ["digest", "doc_id"], "left_semi")), 1)
    copies = per(known, 1).unionByName(unique.withColumn("n", -F.col("n")))  # all but those that have no smaller one
    return (copies.withColumn("code", F.col("code") + 16).unionByName(unique)
            .groupBy("part", "code").agg(F.sum("n").alias("n")))


def audit(counts: DataFrame) -> DataFrame:
    """All steps of every part (AUDIT) from ``part``, ``code``, ``n``; parts whose counts are all zero have rows too."""
    def run(batches):
        wide = [packed(c) for c in range(CODES)]
        alone = {letter: [c for c in range(CODES) if c & 31 == 1 << i] for i, letter in enumerate(FILTERS)}
        letters = np.array([o[s - 1] for o, s in STEPS])
        for (part,), t in runs(batches, ["part"]):
            total, number = 0, [0] * CODES
            for code, n in zip(t.column("code").to_pylist(), t.column("n").to_pylist()):
                total += wide[code] * n
                number[code] += n
            fields = unpacked(total)
            removed = fields[:, COUNTERS.index("removed")]
            by_letter = {x: (sum(number[c] for c in alone[x]), int(removed[letters == x].sum())) for x in FILTERS}
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(STEPS)), pa.array([o for o, _ in STEPS]), pa.array([s for _, s in STEPS], pa.int32()),
                 *(pa.array(fields[:, i]) for i in range(len(COUNTERS))),
                 *(pa.array([by_letter[x][i] for x in letters], pa.int64()) for i in (0, 1))],
                [x.split()[0] for x in AUDIT.split(", ")])

    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(run, AUDIT)


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part, order and step: what the step's filter keeps, removes, would have removed, and loses."""
    rows = stored(facts(table(spark, sf_dir, "documents")), "audit-facts")
    return audit(coded(rows, table(spark, sf_dir, "labels")))


_FAILS = {"A": "n < 50", "B": "100 * d < 65 * n", "C": "100 * up > 5 * points", "D": "marks", "E": "copy"}
_L = [f"p.l{i}" for i in range(1, 6)]
_BIT = "(m.mask >> (ascii({}) - 65)) & 1"

#: The same in SQL.
SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
 w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, length(text) AS points,
              length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS up, regexp_matches(text, '[#$%&*|]') AS marks,
              coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS copy FROM t),
 f AS (SELECT doc_id, part, points, up, marks, copy, len(words) AS n, len(list_distinct(words)) AS d FROM w),
 g AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
 m AS (SELECT part, {' + '.join(f'CAST({c} AS INTEGER) * {1 << i}' for i, c in enumerate(_FAILS.values()))} AS mask, COUNT(*) AS n,
              COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic FROM f LEFT JOIN g USING (doc_id) GROUP BY ALL),
 l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
 p AS (SELECT a.x AS l1, b.x AS l2, c.x AS l3, d.x AS l4, e.x AS l5 FROM l a, l b, l c, l d, l e
       WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
 s AS (SELECT m.part, {' || '.join(_L)} AS filter_order, k.step, m.mask, m.n, m.good, m.toxic,
              [{', '.join(_L)}][k.step] AS letter, {_BIT.format(f"[{', '.join(_L)}][k.step]")} AS here,
              {' + '.join(f'CASE WHEN k.step > {i} THEN {_BIT.format(x)} ELSE 0 END' for i, x in enumerate(_L, 1))} AS before
       FROM m, p, (SELECT unnest([1, 2, 3, 4, 5]) AS step) k),
 o AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
              CAST(coalesce(SUM(n) FILTER (WHERE here = 0 AND before = 0), 0) AS BIGINT) AS kept,
              CAST(coalesce(SUM(n) FILTER (WHERE here = 1 AND before = 0), 0) AS BIGINT) AS removed,
              CAST(coalesce(SUM(n) FILTER (WHERE here = 1 AND before > 0), 0) AS BIGINT) AS redundant,
              CAST(coalesce(SUM(n) FILTER (WHERE mask = 1 << (ascii(letter) - 65)), 0) AS BIGINT) AS unique_fails,
              CAST(coalesce(SUM(good) FILTER (WHERE here = 1 AND before = 0), 0) AS BIGINT) AS good_lost,
              CAST(coalesce(SUM(toxic) FILTER (WHERE here = 1 AND before = 0), 0) AS BIGINT) AS toxic_lost
       FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM o
"""
