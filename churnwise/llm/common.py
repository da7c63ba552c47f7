"""Helpers shared by the text and vector operators of this subpackage.

Words are cut and mapped with the byte methods of Python (``split``,
``translate``), which run at memory speed on whole texts, and every per-word
result is kept in a memo of bounded size, so a task needs memory for one
Arrow batch and one memo only.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

#: Texts are handled in slices of about so many bytes within a task.
SLICE_BYTES = 4 << 20

_ALNUM = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in bytes(range(256)).lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    return text.lower().split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.translate(_ALNUM).split()


@functools.lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library keeps its own counsel
        return None


def give_back() -> None:
    """Return freed memory to the machine: a Python worker lives on for other tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def tidy(run):
    """``run``, a function of Arrow batches, and at the end of each task what it has freed goes back to the machine."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def texts(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``most`` bytes of ``column``, whole rows each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
        block = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


class Memo(dict):
    """A dict that computes missing values and starts anew beyond ``most`` entries."""

    def __init__(self, fn, most: int = 300_000):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.fn(key)
        return value


class Recent:
    """A memo filled many keys at a time: ``fn`` takes a list of keys and returns (key, value) pairs. It keeps the last
    two generations of about ``most`` keys, so frequent keys stay. ``step`` keys are computed at a time."""

    def __init__(self, fn, most: int = 300_000, step: int = 50_000):
        self.fn, self.most, self.step = fn, most, step
        self.now, self.old = {}, {}

    def of(self, keys: set):
        """Compute what is missing of ``keys``; returns the function that looks one up."""
        todo = keys.difference(self.now)  # the dict itself: its view would be walked whole
        if self.now and len(self.now) + len(todo) > self.most:
            self.old, self.now = self.now, {}
            todo = keys
        known = todo & self.old.keys()
        self.now.update(zip(known, map(self.old.__getitem__, known)))
        todo = list(todo - known)
        for i in range(0, len(todo), self.step):
            self.now.update(self.fn(todo[i:i + self.step]))
        return self.now.__getitem__


def word_memo() -> Memo:
    """Word -> stable 64-bit hash."""
    return Memo(xxhash.xxh3_64_intdigest)


def hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the distinct n-word shingles, sorted; a shorter text is one shingle, an empty one none."""
    if len(h) == 0:
        return np.empty(0, np.uint64)
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, 0x9E3779B97F4A7C15 * n & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(n):
        out = mix(out + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def lists(parts: list[bytes], kind: pa.DataType, width: int) -> pa.Array:
    """A list column from each row's raw little-endian values."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // width for p in parts], out=offsets[1:])
    values = pa.Array.from_buffers(kind, int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder named by ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends there, and a lost
    executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal ``keys`` in batches sorted by them."""
    held, key = [], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            here = tuple(batch.column(k)[a].as_py() for k in keys)
            if held and here != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def partition_sum(rows: DataFrame, part, size: int) -> np.ndarray:
    """Sum of ``part(batch)``, a vector of ``size`` numbers, over all Arrow batches: within each partition, then within
    groups of partitions (the square root of their number), then over the groups on the driver."""
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += part(b)
        yield pa.RecordBatch.from_pydict({"g": pa.array([TaskContext.get().partitionId() % groups], pa.int32()),
                                          "total": pa.array([total.tobytes()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in t.column("total"):
            total += np.frombuffer(x.as_py())
        return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "g int, total binary").groupBy("g").applyInArrow(add, "total binary")
    return sum((np.frombuffer(r[0]) for r in parts.collect()), np.zeros(size))


def with_columns(schema: T.StructType, added: list[T.StructField]) -> T.StructType:
    """``schema`` followed by ``added``; columns of the same name (in any case) give way to the added ones."""
    names = {f.name.lower() for f in added}
    return T.StructType([*(f for f in schema if f.name.lower() not in names), *added])


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Within, Arrow batches hold at most ``n`` rows: for jobs whose rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: columns ``a``, ``b`` (long), one row or more for each link, in
    any direction. Returns ``id``, ``component`` (the smallest id reachable)
    for every id that occurs in a link. Each step is a partial-aggregated
    minimum and a join; the state is written to the shared folder after every
    round, and nothing but two counts and a sum reaches the driver.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), f"{name}-links")
    state = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = stored(small, f"{name}-round")
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()


#: Bits of ``id_filter``.
FILTER_BITS = 1 << 27


def filter_bit(column) -> Column:
    """The place of a value in ``id_filter``."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size: the bit ``filter_bit`` is set for every value of ``column``, and maybe for others."""
    at = ids.select((filter_bit(column) + 1).alias("x"))
    out = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for r in at.groupBy(F.bitmap_bucket_number("x").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).toLocalIterator():
        out[r["k"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def in_filter(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def file_system(uri: str):
    """The file system of a URI and the path in it, for files that are not tables (archives, token files)."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)
