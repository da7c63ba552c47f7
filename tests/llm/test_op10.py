"""BPE against the tokenizers library: ids, decoded texts, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnwise.llm import op10_bpe as B

ODD = ["", " ", "Hello's  wörld éÉ 123 ab<|endoftext|>x İ ΑΣ ＡＢ é don'T I'LL 'Ss", "\x1c a\x1db  x 　y\x85z ²³½ Ⅷ ٣",
       "🎉👍🏽 é́ 中文字符 한국어 ﬁ", "a" * 3000, "é" * 2000 + "!?" * 500, "<|startoftext|><|endoftext|", "ß ẞ ǅ Σς",
       "J̌ Å İ ÀÉ AB<|ENDOFTEXT|>", "a. b, c.. d., e.\n f. \n\n g, h.\t 7. 8, é. é, x.) y.", "a.", "..", "b,", "\0 \x7f"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.vocabulary())


def test_ids_and_texts_equal_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(ODD)] + [(None, None), (7, "twice"), (7, "twice")], "doc_id long, text string")
    docs = docs.union(odd).withColumn("IDS", F.lit("clash"))
    rows = B.decode(B.encode(docs, decoded="at_once")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == r.at_once == library.decode(ids, skip_special_tokens=False)
    assert B.encode(docs.where("false")).count() == 0


def test_small_memo_gives_the_same(library):
    enc = B.Encoder(B.vocabulary(), most=3)
    for t in ODD * 2:
        assert np.frombuffer(enc.encode([t.encode()])[0], "<i4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_cuts_are_certain(library):
    enc = B.Encoder(B.vocabulary())
    inside = {(a, b) for t in library.get_vocab() if t.isascii() and not t.startswith("<|")
              for a, b in zip(t.removesuffix("</w>"), t.removesuffix("</w>")[1:])}
    assert all(enc.inside[ord(a), ord(b)] for a, b in inside) and not enc.inside[:, 0x20].any()


def test_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [320, 10**8])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in B.decode(rows).collect()}
    assert got[1] == got[2] == "" and " " not in got[3] and got[3]


def test_a_chunk_is_looked_up_once_a_slice(library, monkeypatch):
    enc, seen = B.Encoder(B.vocabulary()), []
    of = enc.chunks.of

    def counted(keys):
        look = of(keys)
        return lambda k: seen.append(k) or look(k)

    monkeypatch.setattr(enc.chunks, "of", counted)
    docs = ["one two, three. " * 1000, "", "Two  one\n" * 500, " ", "three"]
    for t, ids in zip(docs, enc.encode([t.encode() for t in docs])):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(seen) == len(set(seen)) == 5


def test_many_texts_at_once_equal_the_library(library):
    enc = B.Encoder(B.vocabulary())
    texts = [*ODD, "", *reversed(ODD), "end.", ". start", "\x0b\x0c", "x,"]
    ids, ends = enc.flat([t.encode() for t in texts])
    for t, a, b in zip(texts, [0, *ends.tolist()], ends.tolist()):
        assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids
    for none in ([], [b""]):
        ids, ends = enc.flat(none)
        assert len(ids) == 0 and ends.tolist() == [0] * len(none)
