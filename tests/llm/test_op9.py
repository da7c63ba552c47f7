"""Personal data: base patterns against plain regular expressions, disclosure, redaction, odd rows."""

import random
import re

from pyspark.sql import functions as F

from churnwise.llm import op9_pii as P


def brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        odd = sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])
        if 12 <= len(d) <= 19 and odd % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(5)
    for _ in range(4000):
        t = "".join(rnd.choice(["a", "Z", "1", "25", "4111 1111", "0", ".", "@", "@b.c", "-", " ", "+1", "(", "é", "%", "1.2.3.4", "\n", "+49 555-1234567"])
                    for _ in range(rnd.randint(0, 25)))
        assert P.base_spans(t) == brute(t), t


def test_long_texts_take_linear_time():
    for t in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1 " * 700_000, "a@" * 1_000_000):
        P.base_spans(t)


def test_disclosing_term_and_copies(spark):
    # "zorblax" always stands near one address, in different surroundings; "copyword" only in copies of one text
    rows = [(i, f"w{i} x{i} met zorblax y{i} at boss@corp.example.com z{i} and the rest {i}") for i in range(6)]
    rows += [(100 + i, "see copyword here mail pal@home.example.org now") for i in range(6)]
    rows += [(200 + i, f"the rest of {i} and nothing") for i in range(300)] + [(900, None), (901, ""), (902, "zorblax again"), (902, "zorblax again")]
    rows += [(1000 + i, f"q{i} user{i}@mail.example.net r{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("TERM", F.lit(1))
    terms = {r["term"]: r["kind"] for r in P.disclosing(docs).collect()}
    assert "zorblax" in terms and "copyword" not in terms and "the" not in terms and "rest" not in terms
    got = {r["doc_id"]: r["text"] for r in P.sanitise(docs.drop("spans")).collect()}
    assert got[900] is None and got[901] == "" and "zorblax" not in got[902] and "[EMAIL]" in got[0] and got[210] == "the rest of 10 and nothing"
    assert P.find(docs).where("doc_id = 902").count() == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.disclosing(docs) is None and P.sanitise(docs).count() == 0


def test_query_equals_brute_force(spark):
    import hashlib
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in P.op9_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and any(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got.values())
    for d in docs:
        base = brute(d.text or "")
        line = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        r = got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_copies_neither_hide_nor_make_evidence(spark):
    # "zorblax": ten texts, and many copies of one of them; others repeat it far from any mention, in copies
    rows = [f"w{i} x{i} met zorblax y{i} at boss@corp.example.com z{i} and so on" for i in range(10)]
    rows += [rows[0]] * 40 + ["zorblax stands alone in this text of many copies"] * 50
    # always the same words before the mention, in different texts
    rows += [f"{i} text{i} by Alice Jones <alice@corp.example.com> v{i} u{i}" for i in range(12)]
    # an everyday word: three different texts near an address, many copies of another, and forty texts without one
    rows += [f"a{i} b{i} today c{i} pal@home.example.org d{i}" for i in range(3)] + ["see today here mail pal@home.example.org now"] * 400
    rows += [f"e{i} today f{i}" for i in range(40)] + [f"q{i} user{i}@mail.example.net r{i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    terms = {r["term"]: r["kind"] for r in P.disclosing(docs).collect()}
    assert "zorblax" in terms and terms.get("jones") == "removed" and "today" not in terms
    assert not {"see", "here", "mail", "now"} & set(terms)


def test_occurrences_in_different_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "BITS", 1 << 15)
    rows = [f"one two{i % 7} two{i % 7} one" for i in range(60)] + ["one"] * 9 + [f"one {i}" for i in range(20)] + [None, None, "", ""]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    terms = spark.createDataFrame([("one",), ("two3",)], "term string")
    assert {r.term: r.n for r in P.counted(docs, "text", terms).collect()} == {"one": 2 * 7 + 1 + 20, "two3": 2}


def test_window_holds_all_words(spark):
    long = "filler " * 60
    near = lambda text: {r.term for r in P.mentions(spark.createDataFrame([(text,)], "text string"), "text", 6).where("term is not null").collect()}
    assert near("Alice alice@x.example.com") == {"alice"}
    assert near(long + "a1 b2 c3 d4 e5 f6 alice@x.example.com g7 h8 i9 j1 k2 l3 m4") == {"a1", "b2", "c3", "d4", "e5", "f6", "g7", "h8", "i9", "j1", "k2", "l3"}
    assert near("0 " + " ".join(f"w{i}" + "x" * 90 for i in range(6)) + " alice@x.example.com 李伟 4471") == {f"w{i}" + "x" * 90 for i in range(6)} | {"李伟", "4471"}


def test_first_short_and_numeric_words_disclose(spark):
    rows = [f"Zorblax boss@corp.example.com w{i} x{i}" for i in range(8)] + [f"w{i} Li 李伟 y{i} b77@corp.example.com 4471 z{i}" for i in range(8)]
    rows += [f"q{i} user{i}@mail.example.net r{i}" for i in range(40)] + [f"s{i} 17 of t{i}" for i in range(40)]
    rows += [f"u{i} 17 of v{i} pal@home.example.org" for i in range(3)]
    terms = {r["term"] for r in P.disclosing(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert {"zorblax", "li", "李伟", "4471"} <= terms and not {"17", "of"} & terms
