"""Quality classifier: a kernel machine over document statistics.

Sixteen statistics of a text (lengths, word and line repetition, shares of
byte classes) are standardised and mapped by random Fourier features

    z(x) = sqrt(2 / D) cos(W x + b),   W ~ N(0, 1 / width^2), b ~ U(0, 2 pi),

whose inner products approximate a Gaussian kernel. Each partition sums its
rows' normal equations (a D x D matrix and a vector, whatever its size), the
sums are added in two steps, and a ridge regression is solved on the driver. A
part of the training rows that the regression has not seen calibrates its
scores by isotonic regression over a histogram of ``BINS`` bins.

Only the text is an input. Labels are averaged per doc_id; null labels and
labels without a document are left out; repeated documents count each. Null
and empty texts have statistics of zero and are scored like others. Without
any usable label all scores are 0.5. Columns named like the output are
replaced, others pass through.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import partition_sum, slices, stored, table, texts, tidy, with_columns

#: Random features, kernel width, ridge, histogram bins and the range of raw scores that they cover.
D, WIDTH, RIDGE, BINS, RANGE = 256, 3.0, 1e-3, 2000, (-0.5, 1.5)
#: score from which a document counts as good
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)  # 0: control
for _i, _chars in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), range(0x80, 0x100),
                             b".,;:?'\"()-", b"|#$%&*+/<=>@[\\]^_`{}~!", b" \t\r", b"\n"), 1):
    _CLASS[list(_chars)] = _i
N_STATS = 16


def statistics(text: bytes) -> list[float]:
    counts = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=9) if text else np.zeros(9)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(text))
    tally = Counter(words)
    low, up, digit, wide, stop, symbol, blank, line = (counts[1:] / size).tolist()
    letters = max(1e-9, low + up + wide)
    return [math.log1p(len(text)), math.log1p(len(words)), (size - counts[7] - counts[8]) / n, math.log1p(max(map(len, tally), default=0)),
            len(tally) / n, max(tally.values(), default=0) / n, len(tally) / n ** 0.9, sum(w.isupper() for w in words) / n,
            up / letters, digit, wide, stop, symbol, blank, line, len(set(lines)) / max(1, len(lines))]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``stats``, the statistics of ``text``."""
    schema = with_columns(docs.schema, [T.StructField("stats", T.ArrayType(T.DoubleType()))])
    kept = schema.names[:-1]

    def run(batches):
        for b in slices(batches, text):
            stats = [statistics(t) for t in texts(b.column(text))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(stats, pa.list_(pa.float64()))], schema.names)

    return docs.mapInArrow(tidy(run), schema)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray
    seed: int = 7

    def lift(self, x: np.ndarray) -> np.ndarray:
        rnd = np.random.default_rng(self.seed)
        w, b = rnd.normal(0, 1 / WIDTH, (N_STATS, D)), rnd.uniform(0, 2 * np.pi, D)
        z = np.sqrt(2 / D) * np.cos(np.clip((x - self.mean) / self.scale, -6, 6) @ w + b)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """Sum of ``part(x, y)`` over the rows' statistics and labels."""
    return partition_sum(rows, lambda b: part(matrix(b.column("stats")), b.column("y").to_numpy(zero_copy_only=False)), size)


def isotonic(n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over the bins; returns knots (middle of each pooled run) and values."""
    centre = RANGE[0] + (np.arange(BINS) + 0.5) * (RANGE[1] - RANGE[0]) / BINS
    pools: list[list[float]] = []  # weight, sum of labels, sum of centres
    for i in np.flatnonzero(n):
        pools.append([n[i], good[i], n[i] * centre[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 2] / p[:, 0], p[:, 1] / p[:, 0]


def fit(rows: DataFrame) -> Model:
    """Fit on ``stats``, ``y`` (0 to 1) and ``calibrate`` (boolean: kept from the regression)."""
    learn = rows.where("not calibrate").select("stats", "y")
    s = summed(learn, lambda x, y: np.concatenate([[len(y)], x.sum(0), (x * x).sum(0)]), 1 + 2 * N_STATS)
    model = Model(np.zeros(N_STATS), np.ones(N_STATS), None, np.zeros(1), np.full(1, 0.5))
    if s[0] == 0:
        return model
    model.mean = s[1:N_STATS + 1] / s[0]
    model.scale = np.sqrt(np.maximum(s[N_STATS + 1:] / s[0] - model.mean ** 2, 1e-8)) + 1e-3

    def normal(x, y):
        z = model.lift(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    k = D + 1
    s2 = summed(learn, normal, k * k + k)
    model.weights = np.linalg.solve(s2[:k * k].reshape(k, k) + RIDGE * s[0] / D * np.eye(k), s2[k * k:])

    def histogram(x, y):
        i = np.clip((model.raw(x) - RANGE[0]) * BINS / (RANGE[1] - RANGE[0]), 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(i, minlength=BINS), np.bincount(i, y, minlength=BINS)])

    h = summed(rows.where("calibrate").select("stats", "y"), histogram, 2 * BINS)
    if not h.any():  # too few labels to hold any back
        h = summed(learn, histogram, 2 * BINS)
    model.knots, model.values = isotonic(h[:BINS], h[BINS:])
    return model


def fold(doc_id: str = "doc_id"):
    """crc32 of doc_id as text, mod 5: 0 is held out, 4 calibrates, 1 to 3 fit. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows that may be learnt from: ``stats``, ``y``, ``calibrate``."""
    y = labels.groupBy("doc_id").agg(F.avg("quality").alias("y")).where("y is not null")
    seen = stats.select("doc_id", "stats").where(fold() != 0).join(y, "doc_id")
    return stored(seen.select("stats", "y", (fold() == 4).alias("calibrate")), "quality-rows")


def apply(stats: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """Add ``score`` from ``stats``."""
    schema = with_columns(stats.schema, [T.StructField(score, T.DoubleType())])
    kept = [n for n in schema.names if n != score]
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            if b.num_rows:
                out = np.concatenate([shared.value.score(matrix(b.column("stats").slice(i, 2000))) for i in range(0, b.num_rows, 2000)])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(out)], [*kept, score])

    return stats.mapInArrow(tidy(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, all columns as they were."""
    stats = stored(features(docs.select("doc_id", text), text).select("doc_id", "stats"), "quality-stats")
    model = fit(training_rows(stats, labels))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, text):
            score = shared.value.score(np.array([statistics(t) for t in texts(b.column(text))]).reshape(b.num_rows, N_STATS))
            yield b.filter(pa.array(score >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out from learning, its score and the decision."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(features(docs).select("doc_id", "stats"), "quality-stats")
    model = fit(training_rows(stats, table(spark, sf_dir, "labels")))
    scored = apply(stats, model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
