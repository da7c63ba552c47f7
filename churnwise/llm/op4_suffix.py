"""Benchmark decontamination with suffix arrays over the training texts.

Each task turns its documents, a shard of a few megabytes at a time, into word
numbers and sorts the shard's suffixes by their first ``depth`` words. Every
suffix of every benchmark item is then looked up by binary search in every
shard; equal ranges are the occurrences. Occurrences on one diagonal join into
longest verbatim matches with their places. Only suffixes that begin with two
words that stand together in some item are sorted: no other can be found.

The benchmark is the stated query set. It is read in blocks of at most
``BLOCK_BYTES`` of text, each broadcast on its own, so neither the driver nor a
task ever holds more than a block, and one pass over the documents suffices.

A window is ``depth`` consecutive words of an item; a shorter item is one
window; an item without words (or null) has none. Null and empty documents
have no words. Repeated documents each give a row. Rows of the benchmark with
one item_id count as one item; occurrences of items without an id hit words but
are not listed. Texts of any length are read whole. Columns named like the
output are replaced, others pass through.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import alnum_words, slices, table, texts, tidy, with_columns

DEPTH = 10
BLOCK_BYTES = 2 << 20
MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_start", T.IntegerType()),
                      T.StructField("doc_start", T.LongType()), T.StructField("length", T.LongType())])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
         T.StructField("items", T.ArrayType(T.StringType())), T.StructField("matches", T.ArrayType(MATCH))]
MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int64()), ("length", pa.int64())]))


def keys(windows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort alike."""
    return np.ascontiguousarray(windows.astype(">u4")).view(f"S{4 * windows.shape[1]}").ravel()


class Block:
    """The suffixes of some benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], depth: int):
        self.depth, self.vocab, coded = depth, {}, []
        for item_id, text in items:
            codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in alnum_words(text)]
            if codes:
                coded.append((item_id, codes))
        self.ids = [i for i, _ in coded]
        rows, self.item, self.start, self.size = [], [], [], []
        for k, (_, codes) in enumerate(coded):
            for j in range(max(1, len(codes) - depth + 1)):
                row = codes[j:j + depth]
                rows.append(row + [0] * (depth - len(row)))
                self.item.append(k), self.start.append(j), self.size.append(len(row))
        self.item, self.start, self.size = (np.array(x, np.int64) for x in (self.item, self.start, self.size))
        windows = np.array(rows, np.uint32).reshape(len(rows), depth)
        self.low = keys(windows)
        filled = windows.copy()
        filled[np.arange(depth) >= self.size[:, None]] = 0xFFFFFFFF
        self.high = keys(filled)
        self.first = np.zeros(len(self.vocab) + 1, bool)  # words that are an item of their own
        self.first[windows[self.size == 1, 0]] = True
        two = windows[self.size > 1]
        self.pairs = np.unique(two[:, 0].astype(np.uint64) << np.uint64(32) | two[:, min(1, depth - 1)]) if depth > 1 else np.empty(0, np.uint64)

    def search(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Build the shard's suffix array and look every suffix up: (window number, place) of all occurrences.
        ``words``: the shard's words; None stands between documents."""
        code = np.fromiter(map(self.vocab.get, words, repeat(0)), np.uint32, len(words))
        code = np.append(code, np.zeros(self.depth, np.uint32))
        pair = code[:-1].astype(np.uint64) << np.uint64(32) | code[1:]
        begin = self.first[code[:-1]]
        some = np.flatnonzero((code[:-1] > 0) & (code[1:] > 0))
        if len(self.pairs) and len(some):
            at = np.minimum(np.searchsorted(self.pairs, pair[some]), len(self.pairs) - 1)
            begin[some[self.pairs[at] == pair[some]]] = True
        place = np.flatnonzero(begin[:len(words)])
        suffix = keys(np.lib.stride_tricks.sliding_window_view(code, self.depth)[place])
        order = np.argsort(suffix, kind="stable")
        suffix, place = suffix[order], place[order]
        lo = np.searchsorted(suffix, self.low, "left")
        n = np.maximum(np.searchsorted(suffix, self.high, "right") - lo, 0)
        window = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        return window, place[np.repeat(lo, n) + within]


def read_blocks(benchmark: DataFrame, depth: int, block_bytes: int = BLOCK_BYTES):
    items, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string"), F.col("text")).toLocalIterator():
        items.append((r[0], (r[1] or "").encode()))
        size += len(items[-1][1])
        if size >= block_bytes:
            yield Block(items, depth)
            items, size = [], 0
    if items:
        yield Block(items, depth)


def match(docs: DataFrame, benchmark: DataFrame, text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add n_words, n_hit (words inside an occurrence of a window), items (ids of the items that occur, sorted) and
    matches (the longest verbatim matches: item_id, item_start, doc_start, length in words)."""
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(b) for b in read_blocks(benchmark, depth, block_bytes)]
    schema = with_columns(docs.schema, ADDED)
    kept = schema.names[:-len(ADDED)]

    def run(batches):
        for b in slices(batches, text):
            words, offsets = [], [0]
            for t in texts(b.column(text)):
                words += alnum_words(t)
                words.append(None)
                offsets.append(len(words))
            ends = np.array(offsets)
            hit = np.zeros(len(words) + 1, np.int64)
            items, matches = [set() for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
            for s in shared:
                block = s.value
                window, place = block.search(words)
                if not len(window):
                    continue
                size = block.size[window]
                np.add.at(hit, place, 1)
                np.add.at(hit, place + size, -1)
                item, start = block.item[window], block.start[window]
                order = np.lexsort((start, place - start, item))
                item, start, place, size = item[order], start[order], place[order], size[order]
                new = np.append(True, (item[1:] != item[:-1]) | (place[1:] - start[1:] != place[:-1] - start[:-1]) | (start[1:] != start[:-1] + 1))
                heads = np.flatnonzero(new)
                length = np.diff(np.append(heads, len(new))) - 1 + size[heads]
                doc = np.searchsorted(ends, place[heads], "right") - 1
                for d, k, j, p, n in zip(doc.tolist(), item[heads].tolist(), start[heads].tolist(), (place[heads] - ends[doc]).tolist(), length.tolist()):
                    if block.ids[k] is not None:
                        items[d].add(block.ids[k])
                    matches[d].append({"item_id": block.ids[k], "item_start": j, "doc_start": p, "length": n})
            total = np.append(0, np.cumsum(np.cumsum(hit[:-1]) > 0))
            n_words = np.diff(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(n_words), pa.array(total[ends[1:]] - total[ends[:-1]]),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(matches, MATCH_ARROW)], schema.names)

    return docs.mapInArrow(tidy(run), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """The documents that hold no window of any benchmark item."""
    return match(docs, benchmark, text, depth).where("n_hit = 0").select(docs.columns)


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words hit, items that occur and whether it is contaminated."""
    found = match(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
