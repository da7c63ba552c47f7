"""License scan: fuzzy search for short notices.

Texts are reduced to their words, joined by single spaces. A notice with at
most k edits keeps at least one of its k + 1 pieces unchanged (pigeonhole), so
exact occurrences of the pieces, found by one automaton of all notices in one
pass, locate all candidates; around each the regex library's bounded-error
matching verifies the notice and gives its span and number of edits. Matches
must begin and end where words do. Time grows in proportion to the text.

Base labels are exact phrases. ``score`` is 1 for a text with a base phrase,
else 1 minus the share of edited characters in its closest notice, 0 without
any. Null and empty texts have no words. Repeated rows each give a row. Texts
are read whole. Columns named like the output are replaced, others pass
through.
"""

from __future__ import annotations

import functools

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import alnum_words, slices, table, texts, with_columns

#: Phrases of the base and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of the method: words, label, edits allowed.
NOTICES = (
    ("all rights reserved", "reserved", 2),
    ("bsd 3 clause license", "bsd", 2),
    ("creative commons attribution", "cc-by", 3),
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("licensed under cc by", "cc-by", 2),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("mozilla public license", "mpl", 2),
    ("permission is hereby granted free of charge", "mit", 4),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("this work is licensed under the", "license", 3),
    ("under the mit license", "mit", 2),
)
#: A table of notices may have so many.
MOST_NOTICES = 100_000
MATCH = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                      T.StructField("last_word", T.LongType()), T.StructField("edits", T.IntegerType())])
ADDED = [T.StructField(n, t) for n, t in (
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
    ("base_labels", T.ArrayType(T.StringType())), ("labels", T.ArrayType(T.StringType())), ("matches", T.ArrayType(MATCH)), ("score", T.DoubleType()))]
ARROW = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])), pa.float64()]


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """The notice cut into k + 1 pieces of like length, each with its place."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Notices:
    """Notices (words, label, edits) with one automaton of all their pieces and of the base phrases."""

    def __init__(self, notices=NOTICES, phrases: dict[str, str] = PHRASES):
        self.rows = [(n, label, k, regex.compile(rf"(?<![^ ])(?:{regex.escape(n)}){{e<={k}}}(?![^ ])", regex.BESTMATCH)) for n, label, k in notices]
        self.phrases = dict(phrases)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(notices):
            for offset, piece in pieces(n, k):
                if not piece:
                    raise ValueError(f"{n!r} is too short for {k} edits")
                seeds.setdefault(piece, []).append((i, offset))
        for p in self.phrases:  # with the blanks around it
            seeds.setdefault(f" {p} ", []).append((-1, 0))
        self.automaton = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.automaton.add_word(piece, (piece, where))
        if seeds:
            self.automaton.make_automaton()

    def find(self, line: str) -> tuple[list[tuple[str, int]], dict[int, dict[tuple[int, int], int]]]:
        """Places of base phrases (phrase, start of its first word) and, per notice, its spans with their edits. ``line``:
        words joined by single blanks, a character a byte. Every seed's surroundings are looked at once."""
        base, spans, looked = [], {}, set()
        if not len(self.automaton):
            return base, spans
        for last, (piece, where) in self.automaton.iter(f" {line} "):
            at = last - len(piece)  # in ``line``, which begins one character later
            for i, offset in where:
                if i < 0:
                    base.append((piece[1:-1], at + 1))
                    continue
                notice, _, k, pattern = self.rows[i]
                a, z = max(0, at - offset - k), min(len(line), at - offset + len(notice) + k)
                # widen to the borders of words; a word that goes on for longer can't be part of a match
                before, after = line.rfind(" ", max(0, a - 64), a), line.find(" ", z, z + 64)
                a = before + 1 if before >= 0 else max(0, a - 64)
                z = after if after >= 0 else min(len(line), z + 64)
                if (i, a, z) in looked:
                    continue
                looked.add((i, a, z))
                m = pattern.search(line[a:z])
                if m and (a + m.start() == 0 or line[a + m.start() - 1] == " ") and (a + m.end() == len(line) or line[a + m.end()] == " "):
                    spans.setdefault(i, {})[a + m.start(), a + m.end()] = sum(m.fuzzy_counts)
        return base, spans


@functools.lru_cache(1)
def compiled() -> Notices:
    return Notices()


def fuzzy(line: bytes, notices: Notices | None = None) -> list[tuple[str, int, int, int, float]]:
    """(label, start, end, edits, likeness) of the notices in words joined by blanks; places in bytes."""
    known = notices or compiled()
    _, spans = known.find(line.decode("latin-1"))
    return _likeness(known, spans)


def _likeness(known: Notices, spans) -> list[tuple[str, int, int, int, float]]:
    return [(known.rows[i][1], s, e, edits, 1 - edits / len(known.rows[i][0])) for i in sorted(spans) for (s, e), edits in sorted(spans[i].items())]


def scan_text(text: bytes, notices: Notices | None = None):
    """One value for each of ADDED."""
    known = notices or compiled()
    words = alnum_words(text)
    line = b" ".join(words)
    found, spans = known.find(line.decode("latin-1"))
    near = _likeness(known, spans)
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20) if found or near else None
    word = lambda at: int(np.searchsorted(blanks, at))  # blanks before a place: the number of its word
    base = {known.phrases[p] for p, _ in found}
    starts = [word(at) for _, at in found]
    matches = [{"label": b, "first_word": word(s), "last_word": word(e), "edits": n} for b, s, e, n, _ in near]
    score = 1.0 if base else max((x[4] for x in near), default=0.0)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | {x[0] for x in near}), matches, score


def read_notices(table: DataFrame, most: int = MOST_NOTICES) -> Notices:
    """Notices from a table (notice, label, edits): ASCII words in lower case, joined by single blanks. They become one
    automaton in every task, so a table of more than ``most`` is refused rather than cut."""
    rows = table.select("notice", "label", F.col("edits").cast("int")).where("notice is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} notices")
    return Notices([(" ".join(w.decode() for w in alnum_words(n.encode())), label, k or 0) for n, label, k in sorted(map(tuple, rows), key=str)])


def scan(docs: DataFrame, text: str = "text", notices: DataFrame | None = None) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels, matches (fuzzy spans in words) and score.
    ``notices``: a table for ``read_notices`` instead of NOTICES."""
    shared = docs.sparkSession.sparkContext.broadcast([(n, label, k) for n, label, k, _ in read_notices(notices).rows]) if notices is not None else None
    schema = with_columns(docs.schema, ADDED)
    kept = schema.names[:-len(ADDED)]

    def run(batches):
        known = Notices(shared.value) if shared else compiled()
        for b in slices(batches, text):
            rows = zip(*[scan_text(t, known) for t in texts(b.column(text))])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(x, k) for x, k in zip(rows, ARROW))], schema.names)

    return docs.mapInArrow(run, schema)


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: base phrases, their places and labels, all labels and the score."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")
