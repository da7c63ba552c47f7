"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of a word: after the word before
it, by itself, and uniform:

    P(w | h) = L2 c(h, w) / c(h) + L1 c(w) / N + L0 / (V + 1),

with a set of weights (L2, L1, L0) for each bucket of context frequency, the
power of two of c(h). The weights are learnt by expectation maximisation: the
counts of a deleted fold of the training documents are events, estimated from
the counts of the rest. All counts are of all training documents.

Counts take this way, so that nothing grows with the corpus in one place:

1. documents become blocks of about ``BLOCK_TOKENS`` tokens: their distinct
   words and the sequence of word numbers;
2. each block asks for the counts of its distinct words and word pairs: sorted
   64-bit keys in ``2 ** k`` ranges, where every range adds up the counts of all
   blocks and answers each block in its own order;
3. blocks and answers are stored in tables bucketed by block, so that they meet
   without moving again: once for the events of the fold, counted in a grid of
   probabilities (quarters of powers of two) that EM works on, and once to score.

The start of a text counts as its end's successor. Null and empty texts have
the end only. A null doc_id is held out. Repeated rows are documents each.
Without training documents all counts are 0 and the model is uniform. A long
text is part of one block, which ends with it. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import hashes, mix, runs, slices, space_words, table, texts, word_memo

BLOCK_TOKENS, RANGE_KEYS, FOLD, ROUNDS = 1_000_000, 1_000_000, 1, 60
#: Key of the end of a text, which no word has.
END = np.uint64(0x454E44)
#: Quarters of powers of two that a probability of the grid may have; one more stands for 0.
GRID, NONE = 4, 255


def squeeze(x: np.ndarray) -> bytes:
    """Small unsigned numbers, byte planes compressed."""
    return zstd.ZstdCompressor(1).compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def spread(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstd.ZstdDecompressor().decompress(data), np.uint8)
    return raw.reshape(4, -1).T.copy().view("<u4").ravel()


def pack_blocks(docs: DataFrame, text: str, held_out: str, fold: str) -> DataFrame:
    """block, doc_ids, lens, flags (1 held out, 2 deleted fold), words (hashes, most frequent first), seq (numbers of
    words), n_keys (distinct words and pairs, about), n_train and n_fold (tokens in training and in the deleted fold)."""
    names = ["block", "doc_ids", "lens", "flags", "words", "seq", "n_keys", "n_train", "n_fold"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        memo, part, number = word_memo(), TaskContext.get().partitionId(), 0
        ids, flags, parts, size = [], [], [], 0

        def flush():
            h = np.concatenate(parts)
            words, seq, n = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            lens = np.array([len(x) for x in parts])
            flag = np.frombuffer(bytes(flags), np.uint8)
            train, gone = int(lens[(flag & 1) == 0].sum()), int(lens[flag == 2].sum())
            values = ((part << 32) + number, ids, lens.astype("<u4").tobytes(), bytes(flags), words[order].tobytes(), squeeze(rank[seq]), len(words) + len(h), train, gone)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for b in slices(batches, text):
            for i, t, out, gone in zip(b.column("doc_id").to_pylist(), texts(b.column(text)), b.column(held_out).to_pylist(), b.column(fold).to_pylist()):
                h = hashes(space_words(t), memo)
                parts.append(np.append(np.where(h == END, END + np.uint64(1), h), END))
                ids.append(i), flags.append(1 if out else 2 if gone else 0)
                size += len(h) + 1
                if size >= BLOCK_TOKENS:
                    yield flush()
                    ids, flags, parts, size, number = [], [], [], 0, number + 1
        if parts:
            yield flush()

    return docs.mapInArrow(run, "block long, doc_ids array<long>, lens binary, flags binary, words binary, seq binary, n_keys long, n_train long, n_fold long")


class Block:
    """A block's tokens, its distinct words and pairs, and their keys."""

    def __init__(self, row: dict):
        self.lens = np.frombuffer(row["lens"], "<u4").astype(np.int64)
        self.flags = np.frombuffer(row["flags"], np.uint8)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.seq = spread(row["seq"]).astype(np.int64)
        self.ends = np.cumsum(self.lens)
        end = int(np.flatnonzero(self.words == END)[0])
        before = np.empty_like(self.seq)
        before[1:] = self.seq[:-1]
        before[np.append(0, self.ends[:-1])] = end
        pairs, self.pair = np.unique(before * len(self.words) + self.seq, return_inverse=True)
        self.first, self.second = pairs // len(self.words), pairs % len(self.words)
        # the lowest bit tells words from pairs
        one = mix(self.words) & ~np.uint64(1)
        two = mix(mix(self.words[self.first]) * np.uint64(3) + self.words[self.second]) | np.uint64(1)
        self.keys = np.concatenate([one, two])
        self.order = np.argsort(self.keys, kind="stable")

    def counts(self, flag: int | None) -> np.ndarray:
        """Counts of words and pairs, in this order, of the documents with ``flag`` (None: all in training)."""
        use = np.repeat((self.flags & 1) == 0 if flag is None else self.flags == flag, self.lens)
        return np.concatenate([np.bincount(self.seq[use], minlength=len(self.words)), np.bincount(self.pair[use], minlength=len(self.first))])

    def answered(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts of words and pairs: all in training, and in the deleted fold."""
        out = []
        for c in ("train", "fold"):
            x = np.empty(len(self.keys), np.int64)
            x[self.order] = np.concatenate([spread(a[c]) for a in sorted(answers, key=lambda a: a["range"])])
            out.append(x)
        return out[0], out[1]


def asked(blocks: DataFrame, bits: int) -> DataFrame:
    """range, block, keys, train, fold: the keys of each block, cut into ranges of the key space, and its own counts. A
    range without keys of a block has no row, so there are no more rows than keys."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                b = Block(row)
                keys, train, fold = b.keys[b.order], b.counts(None)[b.order], b.counts(2)[b.order]
                cuts = [*np.searchsorted(keys >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64)).tolist(), len(keys)] if bits else [0, len(keys)]
                rows = [(k, row["block"], keys[a:z].tobytes(), squeeze(train[a:z]), squeeze(fold[a:z])) for k, (a, z) in enumerate(zip(cuts, cuts[1:])) if a < z]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])],
                                                 ["range", "block", "keys", "train", "fold"])

    return blocks.select("block", "lens", "flags", "words", "seq").mapInArrow(run, "range int, block long, keys binary, train binary, fold binary")


def added(requests: DataFrame) -> DataFrame:
    """block, range, train, fold: corpus counts in each block's order; rows with block -1 count distinct training
    words (in ``words``)."""
    def run(batches):
        for (k,), t in runs(batches, ["range"]):
            keys = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("keys")]
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = {}
            for c in ("train", "fold"):
                own = np.concatenate([spread(x.as_py()) for x in t.column(c)])
                total[c] = np.bincount(at, own, len(distinct)).astype(np.int64)
            words = int(((distinct & np.uint64(1) == 0) & (total["train"] > 0)).sum())
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([k], pa.int32()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), pa.array([words], pa.int64())], names)
            start = 0
            for block, own in zip(t.column("block").to_pylist(), keys):
                i = at[start:start + len(own)]
                start += len(own)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([k], pa.int32()), pa.array([squeeze(total["train"][i])], pa.binary()),
                                                  pa.array([squeeze(total["fold"][i])], pa.binary()), pa.array([0], pa.int64())], names)

    names = ["block", "range", "train", "fold", "words"]
    return requests.repartition("range").sortWithinPartitions("range").mapInArrow(run, "block long, range int, train binary, fold binary, words long")


def level(count: np.ndarray) -> np.ndarray:
    """Bucket of context frequency: 0 for unseen, else 1 more than the power of two."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def cell(p: np.ndarray) -> np.ndarray:
    """A probability's place in the grid."""
    return np.where(p > 0, np.minimum(np.round(-GRID * np.log2(np.maximum(p, 1e-300))), NONE - 1), NONE).astype(np.int64)


def estimates(b: Block, train: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of a block: bucket of its context, likelihood after it and by itself."""
    words, pairs = train[:len(b.words)], train[len(b.words):]
    context = words[b.first]
    return level(context), pairs / np.maximum(context, 1), words[b.second] / max(n, 1)


def joined_rows(batches):
    """Blocks with their answers."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
            b = Block(row)
            yield row, b, *b.answered(row["answers"])


def events(both: DataFrame, n_rest: int) -> DataFrame:
    """level, p2, p1 (places in the grid), n: events of the deleted fold, estimated from the rest."""
    def run(batches):
        for _, b, train, fold in joined_rows(batches):
            n = b.counts(2)[len(b.words):]
            some = np.flatnonzero(n)
            k, p2, p1 = (x[some] for x in estimates(b, train - fold, n_rest))
            key, at = np.unique((k << 16) + (cell(p2) << 8) + cell(p1), return_inverse=True)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(key, pa.int64()), "n": pa.array(np.bincount(at, n[some], len(key)).astype(np.int64))})

    return both.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def weights(cells: list, v: int) -> np.ndarray:
    """Mixture weights (L2, L1, L0) for each bucket, by expectation maximisation on the grid of events. A bucket without
    events takes those of the nearest bucket below. Unseen contexts have no L2."""
    out = np.tile([0.4, 0.5, 0.1], (64, 1))
    out[0] = 0, 0.9, 0.1
    at = np.array([c for c, _ in cells], np.int64)
    n = np.array([x for _, x in cells], float)
    back = lambda q: np.where(q == NONE, 0.0, 2.0 ** (-q / GRID))
    seen = []
    for k in range(64):
        own = at >> 16 == k
        if n[own].sum() > 0:
            p = np.stack([back(at[own] >> 8 & 255), back(at[own] & 255), np.full(own.sum(), 1 / (v + 1))], 1)
            w = out[k].copy()
            for _ in range(ROUNDS):
                share = w * p
                w = (share / share.sum(1, keepdims=True) * n[own, None]).sum(0) / n[own].sum()
                w = np.maximum(w, [0 if k == 0 else 1e-6, 1e-6, 1e-6])
                w /= w.sum()
            out[k] = w
            seen.append(k)
        elif k and seen and seen[-1] > 0:
            out[k] = out[seen[-1]]
    return out


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    spark = docs.sparkSession
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(0))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, (crc == 0).alias("held_out"), (crc == FOLD).alias("fold"))
    name, buckets = f"llm_lm_{uuid.uuid4().hex[:12]}", max(8, docs.rdd.getNumPartitions())
    pack_blocks(docs, text, "held_out", "fold").write.bucketBy(buckets, "block").option("compression", "none").saveAsTable(f"{name}_blocks")
    blocks = spark.table(f"{name}_blocks")
    n_keys, n, n_fold = (x or 0 for x in blocks.agg(F.sum("n_keys"), F.sum("n_train"), F.sum("n_fold")).first())
    bits = max(0, int(n_keys // RANGE_KEYS).bit_length())
    added(asked(blocks, bits)).repartition(buckets, "block").write.bucketBy(buckets, "block").option("compression", "none").saveAsTable(f"{name}_answers")
    answers = spark.table(f"{name}_answers")
    v = answers.where("block = -1").agg(F.sum("words")).first()[0] or 0
    answers = answers.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("range", "train", "fold")).alias("answers"))
    both = blocks.select("block", "doc_ids", "lens", "flags", "words", "seq").join(answers, "block")
    cells = events(both, n - n_fold).collect()  # the grid bounds their number
    mixture = weights([(r["cell"], r["n"]) for r in cells], v)

    def run(batches):
        for row, b, train, _ in joined_rows(batches):
            k, p2, p1 = estimates(b, train, n)
            w = mixture[k]
            p = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (v + 1))[b.pair]
            c = train[:len(b.words)][b.seq]
            base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            starts = b.ends - b.lens
            add = lambda x: np.add.reduceat(x, starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array((b.flags & 1) == 1), pa.array(b.lens), pa.array(add((c > 0).astype(np.int64))),
                 pa.array(np.full(len(starts), n)), pa.array(add(base)), pa.array(add(p))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return both.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, known tokens, the base score and the model's log10 probability."""
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
