"""License scan: base phrases against word lists, fuzzy spans against an edit-distance table."""

import random
import string

from pyspark.sql import functions as F

from churnwise.llm import op7_license as L
from churnwise.llm.common import alnum_words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_base_equals_word_lists():
    rnd = random.Random(2)
    for _ in range(300):
        t = " ".join(rnd.choice(["CC", "by", "cc-by", "general", "Public", "license", "all", "rights", "reserved.", "é", "x"]) for _ in range(rnd.randint(0, 40)))
        w = [x.decode() for x in alnum_words(t.encode())]
        starts, labels = [], set()
        for p, label in L.PHRASES.items():
            p = p.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        got = L.scan_text(t.encode())
        assert got[:5] == (len(w), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels))
        assert set(got[5]) >= labels and 0 <= got[7] <= 1 and (got[7] == 1.0 or not labels)


def test_edited_notices_are_found():
    rnd = random.Random(4)
    for notice, label, k in L.NOTICES:
        for _ in range(40):
            t = list(notice)
            for _ in range(rnd.randint(0, k)):
                i = rnd.randrange(1, len(t) - 1)
                what = rnd.choice("rdi")
                if what == "d":
                    del t[i]
                elif what == "r":
                    t[i] = rnd.choice(string.ascii_lowercase)
                else:
                    t.insert(i, rnd.choice(string.ascii_lowercase))
            t = b" ".join(alnum_words("".join(t).encode()))
            assert distance(notice, t.decode()) > k or label in {x[0] for x in L.fuzzy(b"foo bar " + t + b" baz qux")}, (notice, t)


def test_reported_spans_are_within_the_bound():
    line = b"x released under the mti license y al rights reservd z"
    for label, s, e, edits, like in L.fuzzy(line):
        notice, _, k = min((n for n in L.NOTICES if n[1] == label), key=lambda n: distance(n[0], line[s:e].decode()))
        assert distance(notice, line[s:e].decode()) <= edits <= k and 0 < like <= 1
    assert {x[0] for x in L.fuzzy(line)} == {"mit", "reserved"}
    assert L.fuzzy(b"nothing of the kind stands here at all") == []


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "cc by"), (3, "cc by"), (4, "CC BY " * 50_000), (5, "ghts r" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("SCORE", F.lit("x")).withColumn("matches", F.lit(None))
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    assert L.scan(docs).count() == 6 and got[1].n_words == 0 and got[2].score == 0 and got[4].n_base == 50_000 and got[4].last_word == 99_998
    assert L.scan(docs.where("false")).count() == 0


def test_time_grows_with_the_text():
    import time
    base, near = b"cc by " * 1_000_000, b"under the mti license of " * 40_000

    def took(text):
        start = time.process_time()
        out = L.scan_text(text)
        return time.process_time() - start, out

    t, out = took(base)
    assert out[1] == 1_000_000 and out[3] == 1_999_998 and t < 60
    t, out = took(near)
    assert len(out[6]) == 40_000 and out[6][-1]["first_word"] == 5 * 39_999 and t < 60


def test_notices_from_a_table(spark):
    import pytest
    table = spark.createDataFrame([("Do as you please, public licence", "wtf", 3), ("all rights reserved", "mine", 1), (None, "x", 1)], "notice string, label string, edits int")
    docs = spark.createDataFrame([(1, "Do az you pleas public licence"), (2, "All Rights Reserverd"), (3, "under the mit license"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(docs, notices=table).collect()}
    assert got[1].labels == ["wtf"] and got[1].matches[0].edits == 2 and got[2].labels == ["mine"] and got[3].labels == [] == got[4].labels
    many = L.read_notices(spark.range(3000).selectExpr("concat('permission number ', id, ' is granted to all') AS notice", "concat('l', id) AS label", "2 AS edits"))
    assert {x[0] for x in L.fuzzy(b"so permissoin number 1234 is granted to all here", many)} >= {"l1234"}
    with pytest.raises(ValueError):
        L.read_notices(table, most=1)
    with pytest.raises(ValueError):
        L.Notices([("ab", "x", 5)])
