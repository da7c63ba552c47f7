"""WARC archives with Zstandard: a dictionary in the leading skippable frame, one frame for each record.

Writing: every page gives a record. Of records with equal payloads of at least
``SMALLEST`` bytes the one with the smallest page_id is a response, the others
are revisits that refer to it; smaller payloads are always responses. Digests
and their smallest page_id are found with partial aggregation, and only small
rows (id, digest) are joined for that, so a payload that a third of all pages
share moves no payload twice. Every task writes one archive under a name of its own; the
manifest, a table in the shared folder, names the archives of the attempts
that counted, so a repeated task does no harm.

Reading: every archive is streamed, its dictionary taken from the leading
frame, and each record's frame, version line, lengths, trailer and digest are
checked; anything wrong raises ``ValueError``.

A null html is an empty payload; a null url gives no target URI. Rows without
a page_id are records too, a revisit if an equal payload has an id; a repeated
page_id gives a record each, all responses if it is the smallest of its
payload. The dictionary is trained on at most ``SAMPLE_PAGES`` payloads (the
first 64 KiB of each); where that fails, as in small tables, there is none. A
long payload is one record of one frame, held whole by the task that writes or
reads it. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import file_system, new_path, slices, stored, table

SMALLEST, SAMPLE_PAGES, DICT_BYTES, LEVEL = 100, 400, 64 << 10, 3
#: Fixed values of the formats.
SKIPPABLE, DICT_MAGIC = 0x184D2A5D, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record; ``refers``: the page_id of the response that a revisit refers to."""
    kind = "response" if refers is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers, digest)}", f"Refers-To-Page-ID: {refers}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The fields of a record, for RECORD; checks everything that it states."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size, kind = int(fields["Content-Length"]), fields["WARC-Type"]
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block has {len(rest) - 4} bytes, not {size}")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/1.1 "):
        raise ValueError(f"{fields['WARC-Record-ID']}: no HTTP header")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response":
        if length != len(payload) or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one stated")
    elif kind != "revisit" or payload or fields.get("WARC-Profile") != PROFILE or "Refers-To-Page-ID" not in fields:
        raise ValueError(f"{fields['WARC-Record-ID']}: not a valid {kind} record")
    number = lambda k: int(fields[k]) if k in fields else None
    return number("Page-ID"), length, digest, kind, number("Refers-To-Page-ID"), fields.get("WARC-Target-URI")


def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(data)) + data


def records(stream):
    """The decompressed records of an archive, one after the other; reads a mebibyte at a time."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != SKIPPABLE:
        raise ValueError("no leading skippable frame with a dictionary")
    size = struct.unpack("<II", head)[1]
    data = stream.read(size)
    if len(data) != size or data and struct.unpack("<I", data[:4])[0] != DICT_MAGIC:
        raise ValueError("the leading frame holds no dictionary")
    reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(data)) if data else zstd.ZstdDecompressor()
    held = stream.read(1 << 20)
    while held:
        frame, out = reader.decompressobj(), []
        while True:
            out.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else stream.read(1 << 20)
            if frame.eof:
                break
            if not held:
                raise ValueError("the last record's frame is cut off")
        yield b"".join(out)
        held = held or stream.read(1 << 20)


def train(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of the payloads."""
    sample = pages.where("html is not null").orderBy(F.xxhash64("page_id")).select(F.substring("html", 1, 65536)).limit(SAMPLE_PAGES)
    data = [r[0].encode() for r in sample.toLocalIterator()]
    try:
        return zstd.train_dictionary(DICT_BYTES, data).as_bytes() if data else b""
    except zstd.ZstdError:
        return b""


def referred(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the pages whose records are revisits; ``pages`` has page_id, digest, size."""
    first = (pages.where(f"size >= {SMALLEST}").groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
             .where("n > 1 and refers_to is not null").select("digest", "refers_to"))
    return (pages.select("page_id", "digest").join(first, "digest").where("page_id is null or page_id <> refers_to").distinct())


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder``; returns the manifest, a stored table."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
    again = referred(pages).withColumnRenamed("page_id", "id").withColumnRenamed("digest", "same")
    rows = pages.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("same")), "left")
    shared = spark.sparkContext.broadcast(train(pages))

    def run(batches):
        data = shared.value
        writer = zstd.ZstdCompressor(LEVEL, dict_data=zstd.ZstdCompressionDict(data), write_checksum=True) if data else zstd.ZstdCompressor(LEVEL, write_checksum=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.zst"
        out, n = None, 0
        for b in slices(batches, "html"):
            if out is None:
                fs, path = file_system(folder)
                fs.create_dir(path)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
                out.write(dictionary_frame(data))
            for i, url, html, digest, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                out.write(writer.compress(record(i, url, html.encode(), digest, refers)))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return stored(rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, MANIFEST), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """The records of the archives that ``manifest`` names (RECORD)."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches):
        for b in batches:
            for path, n in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                fs, where = file_system(path)
                rows, seen = [], 0
                with fs.open_input_stream(where, compression=None) as stream:
                    for raw in records(stream):
                        rows.append(parse(raw))
                        seen += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)
                            rows = []
                if seen != n:
                    raise ValueError(f"{path}: {seen} records, not {n}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return manifest.repartition(max(1, manifest.count()), "path").mapInArrow(run, RECORD)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, read back from the archives: size and digest of its payload, its record's type and what it refers to."""
    manifest = write(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same in SQL.
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, octet_length(encode(html)) AS size, sha256(html) AS digest FROM p),
     f AS (SELECT digest, min(page_id) AS first FROM d GROUP BY digest)
SELECT d.page_id, CAST(d.size AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.size >= {SMALLEST} AND d.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.size >= {SMALLEST} AND d.page_id <> f.first THEN f.first END AS refers_to
FROM d JOIN f USING (digest)
"""
