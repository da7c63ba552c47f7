"""Token-id files coded with range asymmetric numeral systems (rANS).

One table of frequencies, counted over all tokens of the corpus, is shared by
all files. A file holds blocks of whole documents in ascending order. Every
block is coded on its own: its ids are dealt to ``lanes`` interleaved coders
that advance together (one numpy step for all lanes) and write to one stream
of 32-bit words. Checkpoints within a block (place in the stream and all
lanes' states) let a reader start in its middle; checksums of the block
and of its ids are verified on reading. Blocks are read in parallel.

Layout, little-endian: file = MAGIC, bits, crc32 of the table, number of
blocks, their sizes; then the blocks, each = header, document ids, flags of
null ids, token counts, checkpoints, lanes' states at the start, stream.

Documents are dealt by ranges of doc_id, nulls first; equal ids are ordered by
length and beginning of their texts, so an id with very many rows is dealt to several ranges.
Null and empty texts have the end id only. Repeated rows each are a document.
A long text is one document of one block, whatever its length. Ids of 65,536 or
more raise ``ValueError``. Other columns are not read, whatever their names.
Files are written by tasks under names of their own; the manifest, a stored
table, names those that counted, so repeated tasks do no harm.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import file_system, new_path, slices, stored, table, texts
from .op10_bpe import DEFAULT, encoder

END = 1
#: Tokens in a block and in a file, about; lanes; steps between checkpoints; bits of the frequencies' sum.
BLOCK_TOKENS, FILE_TOKENS, LANES, EVERY, BITS = 1 << 20, 1 << 22, 8192, 64, 20
MAGIC = b"RANSIDS1"
FILE_HEAD, BLOCK_HEAD = struct.Struct("<8sIII"), struct.Struct("<IQIIIII")
LOW = np.uint64(1 << 31)
SYMBOLS = 1 << 16
MANIFEST = "path string, part int, number int, block int, offset long, size long, docs long, tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass
class Table:
    """Frequencies with a sum of 2 ** bits; every id that occurs has at least 1."""

    freq: np.ndarray
    bits: int = BITS

    def __post_init__(self):
        self.first = np.append(0, np.cumsum(self.freq)[:-1]).astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = BITS) -> Table:
        total, size = counts.sum(), 1 << bits
        if total == 0:
            counts, total = np.eye(1, len(counts), END, dtype=np.int64)[0], 1
        freq = np.where(counts > 0, np.maximum(1, counts * float(size) / total).astype(np.int64), 0)
        while (over := int(freq.sum()) - size) != 0:  # even out on the largest
            order = np.argsort(-freq, kind="stable")[:max(1, len(freq) // 16)]
            share = np.sign(over) * np.minimum(np.maximum(freq[order] // 8, 1), abs(over))
            share = np.where(freq[order] - share >= 1, share, 0)
            share[np.abs(np.cumsum(share)) > abs(over)] = 0
            freq[order] -= share
        return cls(freq, bits)


def encode_block(ids: np.ndarray, t: Table, lanes: int = LANES, every: int = EVERY) -> tuple[int, list, np.ndarray, bytes]:
    """(lanes, checkpoints as (step, place, states), first states, stream) of a block's ids."""
    n = len(ids)
    lanes = max(1, min(lanes, 1 << max(0, (n // 64).bit_length())))
    steps = -(-n // lanes)
    bits, shift = np.uint64(t.bits), np.uint64(63 - t.bits)
    state, chunks, marks = np.full(lanes, LOW), [], []
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes:(step + 1) * lanes]
        f, c, x = t.freq[part], t.first[part], state[:len(part)]
        full = x >= f << shift
        chunks.append(x[full].astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[:len(part)] = (q << bits) + (x - q * f) + c
        if step and step % every == 0:
            marks.append((step, state.copy()))
    sizes = np.cumsum([0, *(len(c) for c in reversed(chunks))])
    return lanes, [(s, int(sizes[s]), x) for s, x in reversed(marks)], state, b"".join(c.tobytes() for c in reversed(chunks))


def decode_steps(stream: np.ndarray, n: int, t: Table, lanes: int, state: np.ndarray, place: int = 0, step: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids of the steps from ``step`` up to ``stop``, with the states and the place in the stream at ``step``."""
    steps = -(-n // lanes)
    stop = steps if stop is None else min(stop, steps)
    out, x = np.empty(max(0, stop - step) * lanes, np.uint32), state.copy()
    bits, mask = np.uint64(t.bits), np.uint64((1 << t.bits) - 1)
    at = 0
    for k in range(step, stop):
        w = min(lanes, n - k * lanes)
        y = x[:w]
        slot = y & mask
        s = t.symbol[slot]
        y = t.freq[s] * (y >> bits) + slot - t.first[s]
        low = y < LOW
        m = int(np.count_nonzero(low))
        if m:
            y[low] = y[low] << np.uint64(32) | stream[place:place + m]
            place += m
        x[:w] = y
        out[at:at + w] = s
        at += w
    return out[:at]


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, t: Table) -> bytes:
    """A block of the file format."""
    lanes, marks, state, stream = encode_block(ids, t)
    body = b"".join([np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), counts.astype("<u4").tobytes(),
                     *(struct.pack("<II", s, p) + x.astype("<u8").tobytes() for s, p, x in marks), state.astype("<u8").tobytes(), stream])
    return BLOCK_HEAD.pack(len(doc_ids), len(ids), lanes, len(stream) // 4, len(marks), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def file_head(t: Table, blocks: list[bytes]) -> bytes:
    return FILE_HEAD.pack(MAGIC, t.bits, t.crc, len(blocks)) + struct.pack(f"<{len(blocks)}Q", *map(len, blocks))


def check_head(f, t: Table) -> None:
    magic, bits, crc, _ = FILE_HEAD.unpack(f.read_at(FILE_HEAD.size, 0))
    if magic != MAGIC or bits != t.bits or crc != t.crc:
        raise ValueError("not a file of this table of frequencies")


class Block:
    """A block of the file format, read; ``ids`` decodes it, ``some`` a part of it."""

    def __init__(self, data: bytes, t: Table):
        docs, self.n, self.lanes, words, marks, self.crc, crc = BLOCK_HEAD.unpack_from(data)
        at = BLOCK_HEAD.size
        if zlib.crc32(data[at:]) != crc:
            raise ValueError("a block is damaged")
        take = lambda kind, n: np.frombuffer(data, kind, n, at)
        ids = take("<i8", docs)
        at += 8 * docs
        self.doc_ids = [None if null else i for i, null in zip(ids.tolist(), data[at:at + docs])]
        at += docs
        self.counts = take("<u4", docs)
        at += 4 * docs
        self.marks = []
        for _ in range(marks):
            step, place = struct.unpack_from("<II", data, at)
            at += 8
            self.marks.append((step, place, take("<u8", self.lanes).astype(np.uint64)))
            at += 8 * self.lanes
        self.marks.insert(0, (0, 0, take("<u8", self.lanes).astype(np.uint64)))
        at += 8 * self.lanes
        self.stream, self.table = take("<u4", words).astype(np.uint64), t
        if len(data) != at + 4 * words:
            raise ValueError("a block has another length than stated")

    def ids(self) -> np.ndarray:
        out = decode_steps(self.stream, self.n, self.table, self.lanes, self.marks[0][2])
        if zlib.crc32(out.astype("<u4").tobytes()) != self.crc or int(self.counts.sum()) != self.n:
            raise ValueError("a block's ids are not those written")
        return out

    def some(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start`` on, decoded from the last checkpoint before."""
        step, place, state = [m for m in self.marks if m[0] * self.lanes <= start][-1]
        out = decode_steps(self.stream, self.n, self.table, self.lanes, state, place, step, -(-(start + n) // self.lanes))
        return out[start - step * self.lanes:][:n]


def tokenised(docs: DataFrame, vocab: str = DEFAULT) -> DataFrame:
    """Token ids in ascending doc_id order: rows of about FILE_TOKENS ids, and a row of counts for each task.
    part, number: their order; doc_ids; counts; ids (unsigned 16-bit); tally (counts of ids, else null)."""
    # a text's bytes are moved once; rows of one id are told apart by their texts' length and beginning
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64(F.length("text"), F.substring("text", 1, 64)))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    names = ["part", "number", "doc_ids", "counts", "ids", "tally"]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        enc, part, number = encoder(vocab), TaskContext.get().partitionId(), 0
        tally = np.zeros(SYMBOLS, np.int64)
        doc_ids, counts, ids, size = [], [], [], 0
        end = np.array([END], "<u2")

        def row(*values):
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for b in slices(batches, "text"):
            all_ids, ends = enc.flat(texts(b.column("text")))
            if len(all_ids) and int(all_ids.max()) >= SYMBOLS:
                raise ValueError("token ids beyond 16 bits")
            all_ids, at = all_ids.astype("<u2"), 0
            for i, to in zip(b.column("doc_id").to_pylist(), ends.tolist()):
                n = to - at
                doc_ids.append(i), counts.append(n + 1), ids.append(all_ids[at:to]), ids.append(end)
                at = to
                size += n + 1
                if size >= FILE_TOKENS:
                    flat = np.concatenate(ids)
                    tally += np.bincount(flat, minlength=SYMBOLS)
                    yield row(part, number, doc_ids, np.array(counts, "<u4").tobytes(), flat.tobytes(), None)
                    doc_ids, counts, ids, size, number = [], [], [], 0, number + 1
        if doc_ids:
            flat = np.concatenate(ids)
            tally += np.bincount(flat, minlength=SYMBOLS)
            yield row(part, number, doc_ids, np.array(counts, "<u4").tobytes(), flat.tobytes(), None)
        yield row(part, -1, None, None, None, tally.tobytes())

    return stored(rows.select("doc_id", "text").mapInArrow(run, "part int, number int, doc_ids array<long>, counts binary, ids binary, tally binary"), "rans-ids")


def count_ids(ids: DataFrame) -> np.ndarray:
    """Counts of all ids: the tasks' counts are added in groups (the square root of their number), then on the driver."""
    rows = ids.where("number = -1").select("part", "tally")
    groups = max(1, math.isqrt(rows.count()))

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(SYMBOLS, np.int64)
        for x in t.column("tally"):
            total += np.frombuffer(x.as_py(), np.int64)
        return pa.table({"tally": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select((F.col("part") % groups).alias("g"), "tally").groupBy("g").applyInArrow(add, "tally binary")
    return sum((np.frombuffer(r[0], np.int64) for r in parts.collect()), np.zeros(SYMBOLS, np.int64))


def write(ids: DataFrame, t: Table, folder: str) -> DataFrame:
    """Write the rows of ``ids`` as files, one each; returns the manifest with a row for each block."""
    shared = ids.sparkSession.sparkContext.broadcast(t)

    def run(batches):
        for batch in batches:
            t = shared.value
            for r in range(batch.num_rows):
                part, number, doc_ids, counts, data = (batch.column(c)[r].as_py() for c in ("part", "number", "doc_ids", "counts", "ids"))
                counts, flat = np.frombuffer(counts, "<u4"), np.frombuffer(data, "<u2")
                ends = np.cumsum(counts, dtype=np.int64)
                cuts = np.flatnonzero(np.diff(np.append(-1, (ends - 1) // BLOCK_TOKENS)))  # first document of each block
                cuts = [*cuts.tolist(), len(counts)]
                blocks, info = [], []
                for a, b in zip(cuts, cuts[1:]):
                    x, y = int(ends[a] - counts[a]), int(ends[b - 1])
                    blocks.append(pack(doc_ids[a:b], counts[a:b], flat[x:y], t))
                    info.append((b - a, y - x))
                head = file_head(t, blocks)
                fs, where = file_system(folder)
                fs.create_dir(where)
                name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex[:12]}.rans"
                with fs.open_output_stream(f"{where}/{name}", compression=None) as out:
                    out.write(head + b"".join(blocks))
                offset, rows = len(head), []
                for k, (block, (docs, tokens)) in enumerate(zip(blocks, info)):
                    rows.append((f"{folder}/{name}", part, number, k, offset, len(block), docs, tokens))
                    offset += len(block)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 4])],
                                                 [x.split()[0] for x in MANIFEST.split(", ")])

    return stored(ids.where("number >= 0").mapInArrow(run, MANIFEST), "rans-manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids in all blocks before. Totals are summed over parts, then within each."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("all_before"))
    within = Window.partitionBy("part").orderBy("number", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = manifest.withColumn("part_before", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return blocks.join(parts, "part").withColumn("base", F.col("all_before") + F.col("part_before"))


def read(manifest: DataFrame, t: Table) -> DataFrame:
    """The documents of all blocks: their place among all ids, number of ids and checksum."""
    shared = manifest.sparkSession.sparkContext.broadcast(t)
    kinds = [pa.int64()] * 4

    def run(batches):
        for batch in batches:
            t = shared.value
            for r in batch.to_pylist():
                fs, where = file_system(r["path"])
                with fs.open_input_file(where) as f:
                    check_head(f, t)
                    block = Block(f.read_at(r["size"], r["offset"]), t)
                data = block.ids().astype("<u4").tobytes()
                ends = np.cumsum(block.counts, dtype=np.int64)
                starts = ends - block.counts
                crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [block.doc_ids, starts + r["base"], block.counts.astype(np.int64), crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in DOCUMENT.split(", ")])

    return placed(manifest).repartition(max(1, manifest.count() // 4), "path", "block").mapInArrow(run, DOCUMENT)


def op2_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, read back from the files: its place among all ids, their number and checksum."""
    ids = tokenised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    t = Table.of(count_ids(ids))
    return read(write(ids, t, new_path(spark, "rans")), t)
