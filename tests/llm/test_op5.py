"""WARC archives: round trip, revisits, damaged files, odd rows."""

import glob
import hashlib
import io
import struct

import pytest
from pyspark.sql import functions as F

from churnwise.llm import op5_warc as W
from churnwise.llm.common import new_path


def test_round_trip_and_revisits(spark):
    big = "<p>" + "x" * 200
    rows = [(5, "u", big), (3, None, big), (9, "a b\r\nWARC-Type: x", big), (1, "v", "small"), (2, "w", "small"), (4, "z", None), (6, "z", ""),
            (None, "n", big), (7, "é", "é" * 50), (8, "é", "é" * 50), (10, "r", "é" * 49), (11, "r", "é" * 49), (3, None, big), (12, "h", "a\r\n\r\nb" * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("SIZE", F.lit(1))
    got = W.read(W.write(pages, new_path(spark, "t"))).collect()
    assert len(got) == len(rows)
    first = {big: 3, "é" * 50: 7, "a\r\n\r\nb" * 40: 12}
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and i != first[h]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)


def test_dictionary_and_one_frame_per_record(spark):
    html = [f"<html><head><title>page {i}</title></head><body class='main wide'><p>words {i * 7919} and so on {i % 13}</p></body></html>" * 3 for i in range(600)]
    folder = new_path(spark, "t")
    manifest = W.write(spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit("u")), folder)
    assert W.read(manifest).where("record_type = 'response'").count() == 600
    data = open(manifest.first()["path"].removeprefix("file:"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0 and struct.unpack("<I", data[8:12])[0] == 0xEC30A437
    n = sum(1 for _ in W.records(io.BytesIO(data)))
    assert n == manifest.first()["records"] and data.count(struct.pack("<I", 0xFD2FB528)) >= n


def test_damage_is_found():
    import zstandard as zstd
    good = W.record(1, "u", b"x" * 300, hashlib.sha256(b"x" * 300).hexdigest(), None)
    pack = lambda r: W.dictionary_frame(b"") + zstd.ZstdCompressor().compress(r)
    assert [W.parse(r)[0] for r in W.records(io.BytesIO(pack(good)))] == [1]
    for bad in (good[:-1], good.replace(b"Content-Length: 3", b"Content-Length: 4"), good.replace(b"xxx", b"xyx", 1), good.replace(b"WARC/1.1", b"WARC/0.9"), b"junk"):
        with pytest.raises((ValueError, KeyError)):
            [W.parse(r) for r in W.records(io.BytesIO(pack(bad)))]
    for bad in (pack(good)[:-3], pack(good)[8:], b"", pack(good)[:10]):
        with pytest.raises((ValueError, zstd.ZstdError)):
            [W.parse(r) for r in W.records(io.BytesIO(bad))]


def test_empty_table(spark):
    assert W.read(W.write(spark.createDataFrame([], "page_id long, url string, html string"), new_path(spark, "t"))).count() == 0


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(W.SQL).fetchall()
    assert sorted(want) == sorted(tuple(r) for r in W.op5_warc(spark, sf).collect())
