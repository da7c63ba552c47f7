"""K-means with many starts at the passes of one.

All starts go through the data together. A pass gives every row, for each start, its nearest centre, and adds up number,
squared distance and features per start and centre: starts x k rows leave a partition, and as many reach the driver.
The first centres are drawn as k-means++ draws them, proportional to the squared distance from those chosen: in every
pass each start takes the row with the smallest -ln(u) / distance^2, u from a hash of start, step and the row's features
(an exponential race, so no total is needed), which is again a partial aggregate. k passes draw the centres of all
starts; after that all move together until the last has settled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


@dataclass
class Clustering:
    centres: np.ndarray  # k x features
    inertia: float
    all_inertias: list[float]
    passes: int

    def assign(self, x: DataFrame, out: str = "cluster") -> DataFrame:
        """``x`` (with ``features``) and the number of the nearest centre; the lower one in a tie."""
        v = vector_to_array("features")
        dist = []
        for i, c in enumerate(self.centres):
            centre = F.array(*[F.lit(float(a)) for a in c])
            d = F.aggregate(F.zip_with(F.col("_v"), centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, a: s + a)
            dist.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
        return x.withColumn("_v", v).withColumn(out, F.array_min(F.array(*dist))["i"]).drop("_v")


def _uniform(rows: np.ndarray, start: int, step: int, seed: int) -> np.ndarray:
    """A number in (0, 1) for each row from its content: the same row draws the same, wherever it lies."""
    salt = f"{seed}|{start}|{step}|".encode()
    raw = [hashlib.blake2b(salt + r.tobytes(), digest_size=8).digest() for r in np.ascontiguousarray(rows)]
    return (np.frombuffer(b"".join(raw), "<u8") / 2.0 ** 64).clip(1e-18, 1 - 1e-16)


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(((rows[:, None, :] - centres[None, :, :]) ** 2).sum(2), 0.0)


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, 0))


def _drawn(v: DataFrame, chosen: list[list[np.ndarray]], step: int, seed: int) -> list[np.ndarray]:
    """One more centre for every start."""
    shared = v.sparkSession.sparkContext.broadcast(chosen)

    def run(batches):
        best: dict[int, tuple[float, list[float]]] = {}
        for pdf in batches:
            rows = _matrix(pdf)
            if not len(rows):
                continue
            for s, centres in enumerate(shared.value):
                d = _distances(rows, np.array(centres)).min(1) if centres else np.ones(len(rows))
                with np.errstate(divide="ignore"):
                    race = -np.log(_uniform(rows, s, step, seed)) / d
                i = int(race.argmin())
                if s not in best or race[i] < best[s][0]:
                    best[s] = (float(race[i]), rows[i].tolist())
        yield pd.DataFrame([(s, r, row) for s, (r, row) in best.items()], columns=["start", "race", "v"])

    rows = v.mapInPandas(run, "start int, race double, v array<double>").groupBy("start").agg(F.min_by("v", F.struct("race", "v")).alias("v"))
    return [np.array(r.v) for r in rows.orderBy("start").collect()]


def _moved(v: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of the rows nearest to each centre (a centre without rows stays) and the inertia, of every start."""
    starts, k, p = centres.shape
    shared = v.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        sums, counts, inertia = np.zeros((starts, k, p)), np.zeros((starts, k)), np.zeros((starts, k))
        for pdf in batches:
            rows = _matrix(pdf)
            if not len(rows):
                continue
            for s in range(starts):
                d = _distances(rows, shared.value[s])
                near = d.argmin(1)
                counts[s] += np.bincount(near, minlength=k)
                inertia[s] += np.bincount(near, d[np.arange(len(rows)), near], minlength=k)
                np.add.at(sums[s], near, rows)
        yield pd.DataFrame([(s, c, int(counts[s, c]), float(inertia[s, c]), sums[s, c].tolist()) for s in range(starts) for c in range(k)],
                           columns=["start", "centre", "n", "inertia", "sums"])

    parts = v.mapInPandas(run, "start int, centre int, n long, inertia double, sums array<double>")
    total = parts.groupBy("start", "centre").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"),
                                                 F.array(*[F.sum(F.col("sums")[i]) for i in range(p)]).alias("sums"))
    out, inertia = centres.copy(), np.zeros(starts)
    for r in total.collect():  # starts x k rows
        inertia[r.start] += r.inertia
        if r.n:
            out[r.start, r.centre] = np.array(r.sums) / r.n
    return out, inertia


def fit_kmeans(x: DataFrame, k: int = 4, starts: int = 10, seed: int = 42, max_iter: int = 50, tol: float = 1e-6) -> Clustering:
    """The best of ``starts`` clusterings of ``x`` (a column ``features``) by inertia; k is kept within 2 to 6."""
    k = max(2, min(int(k), 6))
    v = stored(x.select(vector_to_array("features").alias("v")), "kmeans")
    chosen: list[list[np.ndarray]] = [[] for _ in range(starts)]
    for step in range(k):
        for s, row in enumerate(_drawn(v, chosen, step, seed)):
            chosen[s].append(row)
    if not chosen[0]:
        raise ValueError("no rows to cluster")
    centres = np.array(chosen)
    passes = k
    for _ in range(max_iter):
        after, inertia = _moved(v, centres)
        passes += 1
        settled = np.abs(after - centres).max() <= tol
        centres = after
        if settled:
            break
    else:
        _, inertia = _moved(v, centres)
        passes += 1
    best = int(inertia.argmin())
    return Clustering(centres[best], float(inertia[best]), [float(i) for i in inertia], passes)
