"""The corpus pipeline on the small tables: every stage against a plain version of its decision."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from churnwise.llm import op3_quality, op9_pii
from churnwise.llm.common import alnum_words, stored
from churnwise.llm.op10_bpe import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into each stage, and what comes out of the last."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(90_001, None), (90_002, ""), (90_003, "A plain sentence, with words that nobody repeats elsewhere in this table."),
             (90_004, "A plain sentence, with words that nobody repeats elsewhere in this table."), (None, "No id stands here, but some words do.")]
    more = spark.createDataFrame(extra, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = docs.unionByName(more.select(docs.columns))
    out = [docs]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_names(steps):
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "decontaminate", "personal_data", "tokens"]
    assert all(df.columns == steps[0].columns and df.dtypes == steps[0].dtypes for df in steps[1:-1])


def test_quality_keeps_clean_documents(spark, steps):
    got = rows(steps[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and i in rows(steps[0])]
    assert sum(i in got for i in good) >= 0.95 * len(good)
    stats = op3_quality.features(steps[0].select("doc_id", "text")).select("doc_id", "stats")
    model = op3_quality.fit(op3_quality.training_rows(stats, spark.read.parquet(f"{SF}/labels.parquet")))
    want = {r.doc_id for r in op3_quality.apply(stats, model).where(f"score >= {op3_quality.THRESHOLD}").collect()}
    assert set(got) == want


def test_one_document_of_each_group(steps):
    before, after = rows(steps[1]), rows(steps[2])
    sets = {}
    for i, r in before.items():
        w = (r.text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - min(5, len(w)) + 1)) if w else frozenset()
    up = {i: i for i in sets if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in up:
        for b in up:
            if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert set(after) - {None} == {i for i in up if root(i) == i}
    assert (None in after) == (None in before)


def test_benchmark_documents_go(spark, steps):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = alnum_words((r.text or "").encode())
        windows.update(tuple(w[i:i + 10]) for i in range(max(0, len(w) - 9))) if len(w) >= 10 else windows.add(tuple(w))
    windows.discard(())
    sizes = {len(x) for x in windows}

    def dirty(text):
        w = alnum_words((text or "").encode())
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    before, after = rows(steps[2]), rows(steps[3])
    assert set(after) == {i for i, r in before.items() if not dirty(r.text)} and len(after) < len(before)


def test_personal_data_is_replaced(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(before) == set(after)
    changed = 0
    for i, r in before.items():
        t = after[i].text
        assert after[i].n_chars == (len(t) if t is not None else None)
        if r.text and not op9_pii.base_spans(r.text):
            continue
        if r.text:
            changed += t != r.text
            assert not re.search(r"[\w.]+@[\w-]+\.[\w.]+", t) and not any(v[1] < 2 for v in op9_pii.base_spans(t))
    assert changed


def test_tokens_equal_the_library(steps):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary())
    texts, got = rows(steps[4]), rows(steps[5])
    assert set(texts) == set(got)
    for i, r in got.items():
        assert list(r.ids) == lib.encode(texts[i].text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_is_the_stages_in_order(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = P.run(spark, SF)
    assert got.columns == steps[-1].columns and 0 < got.count() < docs.count()
