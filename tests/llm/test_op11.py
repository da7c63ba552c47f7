"""Merkle manifest against a direct construction; the two sweeps; odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from churnwise.llm import op11_merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    n = r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more
    out = ""
    for v in (r["doc_id"], r["source"], r["lang"], n, r["text"]):
        v = None if v is None else str(v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return sha(out)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    for level in tree[:-1]:
        yield i & 1, level[i ^ 1] if (i ^ 1) < len(level) else None
        i >>= 1


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(b"" if r["lang"] is None else b"=" + r["lang"].encode(), []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups)
    trees = {n: levels([leaf(r) for r in groups[n]]) for n in names}
    top = levels([trees[n][-1][0] for n in names]) if names else []
    for k, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            steps = [*way(trees[n], i), *way(top, k)]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            v = leaf(r, int(bad))
            for second, s in steps:
                v = sha(v) if s is None else sha(s, v) if second else sha(v, s)
            yield (r["doc_id"], leaf(r), trees[n][-1][0], top[-1][0], sha(*(s for _, s in steps if s)), v, v == top[-1][0])


def run(spark, rows, height):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("DIGEST", F.lit(1)).withColumn("grp", F.lit("clash")).withColumn("seg", F.lit(2))
    leaves = docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("ref"), M.leaf([F.col(c) for c in M.FIELDS]).alias("digest"),
                         F.when(M.tampered(), M.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in M.FIELDS])).alias("found"))
    done = M.checked(M.manifest(leaves, height))
    return [tuple(r) for r in done.select("ref", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root",
                                          F.col("folded_root") == F.col("root")).collect()]


def some(n, lang, start=0):
    return [dict(doc_id=start + i, text=f"text {i}", lang=lang, source=f"s{i % 3}", n_chars=i) for i in range(n)]


@pytest.mark.parametrize("height", [1, 2, 12])
def test_equals_direct_construction(spark, height):
    rows = some(37, "en") + some(16, "de", 100) + some(1, None, 200) + some(17, "", 300) + some(3, "é", 400)
    rows += [dict(doc_id=None, text=None, lang=None, source=None, n_chars=None), dict(doc_id=7, text=None, lang="en", source=None, n_chars=None),
             dict(doc_id=3, text="other", lang="en", source="x", n_chars=5), dict(doc_id=3, text="other", lang="en", source="x", n_chars=5),
             dict(doc_id=500, text="日本 " * 400_000, lang="de", source="long", n_chars=1), dict(doc_id=-4, text="", lang="é", source="", n_chars=0)]
    rows += [dict(doc_id=9, text="same", lang="fr", source="s", n_chars=4)] * 40  # equal rows, more than a segment
    got, want = run(spark, rows, height), list(brute(rows))
    key = lambda t: tuple(map(str, t))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[6] for r in got} == {True, False}


def test_one_leaf_and_no_leaf(spark):
    one = some(1, "en", 1)
    assert run(spark, one, 12) == list(brute(one))
    assert run(spark, [], 12) == []


def test_any_change_breaks_the_proof(spark):
    rows = some(20, "en")
    p = M.manifest(spark.createDataFrame([("en", r["doc_id"], leaf(r), None) for r in rows], "grp string, ref long, digest string, found string"), 2).collect()
    for r in p:
        assert M.fold(r.leaf, r.siblings, r.sides) == r.root
        assert M.fold(sha(r.leaf), r.siblings, r.sides) != r.root
        if r.siblings:
            assert M.fold(r.leaf, r.siblings[64:] + r.siblings[:64], r.sides) != r.root or len(r.siblings) == 64
            assert M.fold(r.leaf, r.siblings.translate(str.maketrans("0123456789abcdef", "123456789abcdef0")), r.sides) != r.root


def test_queue_stays_small():
    up, most = M.Upward(20), 0
    for i in range(5000):
        for _ in up.leaf(str(i)):
            pass
        most = max(most, len(up.queue))
    assert most <= 2 * 20


def test_labels_are_topological():
    for level in range(6):
        for index in range(20):
            label = M.label_of(level, index)
            assert M.place(label) == (level, index) and label < M.label_of(level + 1, index >> 1)


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = M.op11_merkle(spark, sf)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({M.SQL})").fetchall())
