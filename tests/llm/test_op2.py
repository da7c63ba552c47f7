"""rANS token files: exact round trips, random access, damage, order, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwise.llm import op2_rans as R
from churnwise.llm.common import new_path
from churnwise.llm.op10_bpe import vocabulary


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 5000, 300_000])
@pytest.mark.parametrize("kind", ["zipf", "one", "uniform"])
def test_block_round_trip(n, kind):
    rnd = np.random.default_rng(n)
    ids = {"zipf": np.minimum(rnd.zipf(1.3, n), 49_000), "one": np.full(n, 7), "uniform": rnd.integers(0, 49_408, n)}[kind].astype(np.uint16)
    t = R.Table.of(np.bincount(ids, minlength=R.SYMBOLS))
    assert int(t.freq.sum()) == 1 << t.bits and (t.freq[np.unique(ids)] > 0).all()
    counts = np.array([n], np.uint32)
    data = R.pack([5], counts, ids, t)
    block = R.Block(data, t)
    assert (block.ids() == ids).all()
    for a in (0, n // 3, max(0, n - 3)):
        assert (block.some(a, 50) == ids[a:a + 50]).all()
    if n > 1000:
        entropy = -(np.bincount(ids)[np.unique(ids)] / n * np.log2(np.bincount(ids)[np.unique(ids)] / n)).sum()
        stream = 4 * len(block.stream)
        assert stream <= n * entropy / 8 * 1.02 + 8 * block.lanes
        for at in (len(data) - 3, len(data) // 2):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises((ValueError, IndexError, MemoryError)):
                R.Block(bytes(bad), t).ids()


def test_files_equal_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(R, "FILE_TOKENS", 3000)
    monkeypatch.setattr(R, "BLOCK_TOKENS", 700)
    lib = Tokenizer.from_file(vocabulary())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-5, None), (10**9, ""), (-7, "twice"), (-7, "twice"), (-7, "other"), (None, "no id")], "doc_id long, text string")
    docs = docs.union(odd)
    ids = R.tokenised(docs.withColumn("TIE", F.lit(1)).select("doc_id", "text"))
    t = R.Table.of(R.count_ids(ids))
    manifest = R.write(ids, t, new_path(spark, "t"))
    assert manifest.select("path").distinct().count() > 3 and manifest.count() > manifest.select("path").distinct().count()
    got = R.read(manifest, t).collect()
    want = []
    for r in docs.collect():
        x = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r.doc_id, len(x), zlib.crc32(x.tobytes())))
    assert sorted(want, key=str) == sorted(((g.doc_id, g.n_tokens, g.ids_crc32) for g in got), key=str)
    got.sort(key=lambda g: g.start)
    assert [g.doc_id for g in got] == sorted((g.doc_id for g in got), key=lambda i: (i is not None, i))
    assert [g.start for g in got] == np.cumsum([0, *(g.n_tokens for g in got)])[:-1].tolist()


def test_empty_table(spark):
    ids = R.tokenised(spark.createDataFrame([], "doc_id long, text string"))
    t = R.Table.of(R.count_ids(ids))
    assert R.read(R.write(ids, t, new_path(spark, "t")), t).count() == 0
