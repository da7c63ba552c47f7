"""One table of nulls, empties, repeats, clashing columns and texts of megabytes, through every operator on texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnwise.llm import op1_jaccard, op2_rans, op3_quality, op4_suffix, op5_warc, op7_license, op8_lm, op9_pii, op10_bpe
from churnwise.llm.common import new_path, stored

CLASH = ["score", "STATS", "keys", "n", "Items", "ids", "block", "spans", "n_words", "digest", "fold", "held_out", "labels", "matches", "stats2"]


def long_text(seed, words=400_000):
    rnd = random.Random(seed)
    pool = [f"w{i}" for i in range(5000)] + ["é", "Über", "1.2.3.4", "a@b.org"]
    return " ".join(rnd.choice(pool) for _ in range(words))


@pytest.fixture(scope="module")
def table(spark):
    one = long_text(1)
    near = one.replace("w17 ", "other ", 20)
    rows = [(1, one), (2, near), (3, None), (4, ""), (5, "short text"), (5, "short text"), (None, "no id"), (6, "x" * 3_000_000), (7, " " * 2_000_000), (8, "all rights reserved " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit("clash") if i % 2 else F.lit(None).cast("int"))
    return rows, stored(df, "long").repartition(3, "doc_id")


def test_jaccard(table):
    rows, df = table
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op1_jaccard.similar(df).collect()), key=str)
    sets = [(i, len({tuple(w[k:k + min(3, len(w))]) for k in range(len(w) - min(3, len(w)) + 1)}) if (w := (t or "").lower().split()) else 0) for i, t in rows]
    assert got == sorted(((i, n, {2: 1}.get(i, i)) for i, n in sets), key=str)


def test_token_files_and_bpe(spark, table):
    rows, df = table
    enc = {(r.doc_id, r.text): list(r.ids) for r in op10_bpe.encode(df.select("doc_id", "text", "score")).collect()}
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(op10_bpe.vocabulary())
    for (i, t), ids in enc.items():
        assert ids == lib.encode(t or "", add_special_tokens=False).ids
    query = op2_rans.op2_rans
    folder = new_path(spark, "long-docs")
    df.select("doc_id", "text", "score", "n").write.parquet(f"{folder}/documents.parquet")
    got = query(spark, folder).collect()
    crc = {(i, t): zlib.crc32(np.array([*ids, 1], "<u4").tobytes()) for (i, t), ids in enc.items()}
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(enc[i, t]) + 1, crc[i, t]) for i, t in rows)


def test_quality(spark, table):
    _, df = table
    labels = spark.createDataFrame([(1, 1), (8, 0), (6, 0)], "doc_id long, quality int")
    assert op3_quality.keep_good(df, labels).columns == df.columns
    assert op3_quality.features(df).count() == 10


def test_suffixes(spark, table):
    rows, df = table
    words = rows[0][1].split()
    bench = spark.createDataFrame([(1, " ".join(words[200_000:200_040])), (2, " ".join(words[-10:])), (3, None), (4, "short text")], "item_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_hit, list(r["items"])) for r in op4_suffix.match(df, bench).collect()}
    by_id = {i: v for (i, _), v in got.items()}
    assert by_id[1][1] == ["1", "2"] and by_id[1][0] >= 50 and by_id[5] == (2, ["4"]) and by_id[3] == by_id[7] == (0, [])


def test_archives(spark, table):
    rows, df = table
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("http://a/").alias("url"), F.col("text").alias("html"), "digest", "n")
    got = op5_warc.read(op5_warc.write(pages, new_path(spark, "long-warc"))).collect()
    want = sorted((str(i), len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want


def test_licenses(table):
    _, df = table
    got = {r.doc_id: r for r in op7_license.scan(df).collect()}
    assert got[8].n_base == 100_000 and got[8].last_word == 299_997 and got[1].n_words > 400_000 and got[3].n_words == 0


def test_language_model(table):
    rows, df = table
    got = op8_lm.score(df).collect()
    assert len(got) == len(rows) and all(np.isfinite([r.score, r.base_score]).all() for r in got)
    assert {r.doc_id: r.n_tokens for r in got}[1] == 400_001


def test_personal_data(table):
    rows, df = table
    got = {r.doc_id: r for r in op9_pii.find(df, op9_pii.disclosing(df)).collect()}
    base = op9_pii.base_spans(rows[0][1])
    assert len(base) > 50 and sum(s.kind in op9_pii.KINDS for s in got[1].spans) == len(base) and got[3].spans == []
    clean = op9_pii.sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(rows)


def test_the_pipeline_takes_clashing_columns_and_empty_tables(spark, table):
    _, df = table
    docs = df.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    folder = new_path(spark, "long-pipeline")
    spark.createDataFrame([(1, 1, 0), (5, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for start in (docs, docs.where("false")):
        now = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            now = stored(stage(spark, now, folder), f"long-{name}")
            if i < 4:
                assert now.columns == start.columns, name
        assert (now.count() > 0) == (start is docs)
