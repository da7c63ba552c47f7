"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of t or more lie within epsilon = sqrt(2 - 2 t) of
each other. The vectors are rotated onto the principal axes of their
covariance (summed per partition), which keeps distances, and sorted by the
cells of an epsilon grid on the leading axes: the epsilon grid order. The
sequence is cut into intervals of about ``BLOCK`` vectors. Pairs of intervals
are joined recursively, from long intervals to short ones: a pair whose boxes on
the leading axes are further apart than epsilon is skipped with all that is
in it. The remaining pairs of blocks are dealt over tasks in square tiles, in
which the recursion goes on down to ``LEAF`` vectors. Candidates come from
single precision with a margin, on as many leading axes as tell most vectors
apart; every link is decided in double precision.

Vectors are moved once, into the order, and written once, to files in the
shared folder. Tasks read the blocks of their tiles there: pairs of blocks are
numbers and no vector is shuffled for them, so disk grows with the vectors and
not with the pairs.

Equal vectors are joined once and counted by their number. A task returns how
many links each vector has and the first vector of those that it has found
connected, so no list of pairs is ever made.

A vector that is null, empty, all zero, or holds null or non-finite components
links with nothing, as does one without an id (its component is null and it is
kept). Vectors of different lengths never link. Rows that repeat an id have the
links and the component of their own vector; other rows with an equal vector
count as links. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import components, file_system, new_path, partition_sum, stored, table
from .skew import left_join

COSINE, BLOCK, LEAF, FAN, AXES = 0.9, 4096, 256, 16, 8
#: Blocks on a side of a tile at most; bytes that the blocks of a tile should take in a task.
TILE, TILE_BYTES = 8, 128 << 20


def fine(v: str = "v"):
    """Whether a vector has a direction."""
    low, high, inf = F.array_min(v), F.array_max(v), float("inf")
    numbers = ~F.array_contains(v, float("nan")) & (high < inf) & (low > -inf)  # null if one is null
    return F.coalesce(numbers & ((high != 0) | (low != 0)), F.lit(False))


def floats(rows: pa.Array, dim: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distinct(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of the equal vectors of a batch: the first row of each group, and each row's group."""
    _, first, group = np.unique(np.array(b.column("k").to_pylist(), "S16"), return_index=True, return_inverse=True)
    return first, group


def axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean of the unit vectors, their principal axes and the variance along each, leading ones first. Vectors that a
    batch holds more than once count once."""
    def moments(b):
        u = unit(floats(b.column("v").take(pa.array(distinct(b)[0])), dim))
        return np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])

    s = partition_sum(vectors.select("k", "v"), moments, 1 + dim + dim * dim)
    mean = s[1:dim + 1] / s[0]
    spread, q = np.linalg.eigh(s[dim + 1:].reshape(dim, dim) / s[0] - np.outer(mean, mean))
    return mean, q[:, ::-1], np.maximum(spread[::-1], 0)


def width(spread: np.ndarray, eps: float) -> int:
    """So many leading axes place two vectors further apart than ``eps`` nearly always (their squared distance on them,
    as of normal vectors, less 3 standard deviations); all axes if it takes most of them."""
    far = 2 * np.cumsum(spread) - 3 * np.sqrt(8 * np.cumsum(spread ** 2)) >= eps * eps
    k = max(int(np.argmax(far)) + 1, AXES) if far.any() else len(spread)
    return k if k + 3 <= 0.75 * len(spread) else len(spread)


def in_order(vectors: DataFrame, dim: int, kind: str, mean: np.ndarray, q: np.ndarray, eps: float) -> DataFrame:
    """The distinct vectors in epsilon grid order, in files of the shared folder (one a partition). A row for each run of
    ``BLOCK`` vectors or fewer: part, start (its first place in the part), rows, path, place_in (its offset in the file:
    the vectors, then how many rows have each), box lo0.., hi0.. on the leading axes, and lists: k, rep (least id), n."""
    q = q[:, :AXES]
    m, size, folder = q.shape[1], 4 if kind == "float" else 8, new_path(vectors.sparkSession, "ego-vectors")

    def cells(batches):
        for b in batches:
            if b.num_rows:
                first, group = distinct(b)
                rep = np.full(len(first), np.iinfo(np.int64).max)
                np.minimum.at(rep, group, b.column("id").to_numpy())
                b = b.take(pa.array(first))
                grid = np.floor((unit(floats(b.column("v"), dim)) - mean) @ q / eps).astype(np.int32)
                grid = pa.ListArray.from_arrays(pa.array(np.arange(0, grid.size + 1, m, dtype=np.int32)), pa.array(grid.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(np.bincount(group)), b.column("k"), b.column("v"), grid], ["rep", "n", "k", "v", "cell"])

    def write(batches):
        part, start, at, name = TaskContext.get().partitionId(), 0, 0, f"{uuid.uuid4().hex}.vectors"
        out, held = None, None

        def run(k, rep, n, v):
            nonlocal out, start, at
            if out is None:
                fs, where = file_system(folder)
                fs.create_dir(where)
                out = fs.open_output_stream(f"{where}/{name}", compression=None)
            z = (unit(v) - mean) @ q
            box = [pa.array([x]) for x in (*z.min(0).tolist(), *z.max(0).tolist())]
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([start]), pa.array([len(k)]), pa.array([f"{folder}/{name}"]), pa.array([at]),
                                              pa.array([k.tolist()], pa.list_(pa.binary())), pa.array([rep.tolist()], pa.list_(pa.int64())), pa.array([n.tolist()], pa.list_(pa.int64())), *box], names)
            data = v.tobytes() + n.tobytes()
            out.write(data)
            start, at = start + len(k), at + len(data)
            return row

        try:
            for b in batches:
                if not b.num_rows:
                    continue
                k = np.array(b.column("k").to_pylist(), object)
                new = np.append(True, k[1:] != k[:-1])  # equal vectors of several batches stand together
                starts = np.flatnonzero(new)
                rows = [k[starts], np.minimum.reduceat(b.column("rep").to_numpy(), starts), np.add.reduceat(b.column("n").to_numpy(), starts), floats(b.column("v"), dim)[starts]]
                if held and held[0][-1] == k[0]:
                    held[1][-1] = min(held[1][-1], rows[1][0])
                    held[2][-1] += rows[2][0]
                    rows = [x[1:] for x in rows]
                held = [np.concatenate(x) for x in zip(held, rows)] if held else rows
                while len(held[0]) > BLOCK:  # the last one may go on in the next batch
                    yield run(*(x[:BLOCK] for x in held))
                    held = [x[BLOCK:].copy() for x in held]
            if held:
                yield run(*held)
        finally:
            if out is not None:
                out.close()

    names = ["part", "start", "rows", "path", "place_in", "k", "rep", "n", *(f"lo{i}" for i in range(m)), *(f"hi{i}" for i in range(m))]
    schema = "part int, start long, rows long, path string, place_in long, k array<binary>, rep array<long>, n array<long>, " + ", ".join(f"{c} double" for c in names[8:])
    rows = vectors.select("id", "k", "v").mapInArrow(cells, f"rep long, n long, k binary, v array<{kind}>, cell array<int>")
    return stored(rows.repartitionByRange("cell", "k").sortWithinPartitions("cell", "k").mapInArrow(write, schema), "ego-order")


def placed(runs: DataFrame) -> DataFrame:
    """``runs`` with ``place``, the number of vectors before each run."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = runs.groupBy("part").agg(F.sum("rows").alias("all")).select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("place"))
    return runs.join(parts, "part").withColumn("place", F.col("place") + F.col("start"))


def near_pairs(boxes: DataFrame, m: int, eps: float) -> DataFrame:
    """a, b (a <= b): pairs of blocks whose boxes are within ``eps``, found from long intervals down to blocks."""
    sides = [F.min(f"lo{i}").alias(f"lo{i}") for i in range(m)] + [F.max(f"hi{i}").alias(f"hi{i}") for i in range(m)]
    levels = [boxes.select("block", *(f"{s}{i}" for s in ("lo", "hi") for i in range(m)))]
    n = levels[0].count()
    while n > FAN:
        levels.append(levels[-1].groupBy(F.floor(F.col("block") / FAN).cast("long").alias("block")).agg(*sides))
        n = -(-n // FAN)
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels):
        up = F.floor(F.col("block") / FAN).cast("long")  # 0 for all at the top
        side = lambda s: level.select(F.col("block").alias(f"{s}_block"), up.alias(s), *(F.col(c).alias(f"{s}_{c}") for c in level.columns if c != "block"))
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}")), 2) for i in range(m)), F.lit(0.0))
        pairs = (pairs.join(side("a"), "a").join(side("b"), "b").where("a_block <= b_block").where(gap <= eps * eps * (1 + 1e-9))
                 .select(F.col("a_block").alias("a"), F.col("b_block").alias("b")))
    return pairs


class Block:
    """Vectors of a block, in order, ready to be joined: ``left`` @ ``right``.T of two blocks is in single precision the
    cosine less one or more, by the distance on ``wide`` leading axes and that of the lengths of what they leave."""

    def __init__(self, x: np.ndarray, mean: np.ndarray, q: np.ndarray, wide: int):
        self.x, self.u, self.boxes = x, unit(x), {}
        turned = (self.u - mean) @ q
        self.z = turned[:, :AXES]
        if wide == x.shape[1]:
            self.left = self.right = self.u.astype(np.float32)
            self.base = 1.0
        else:
            away = self.u - mean
            square = (away * away).sum(1)
            rest = np.sqrt(np.maximum(0, square - (turned * turned).sum(1)))
            near, one = np.column_stack([turned, rest]), np.ones(len(x))
            self.left = np.column_stack([near, -square / 2, one]).astype(np.float32)
            self.right = np.column_stack([near, one, -square / 2]).astype(np.float32)
            self.base = 0.0

    def box(self, a: int, b: int):
        if (a, b) not in self.boxes:
            self.boxes[a, b] = self.z[a:b].min(0), self.z[a:b].max(0)
        return self.boxes[a, b]


def join_intervals(x: Block, y: Block, cosine: float):
    """Links between two blocks, or (both the same) within one: pairs of (row, column) arrays, leaf by leaf. Pairs of
    intervals that are provably distant are skipped."""
    eps2 = (2 - 2 * cosine) * (1 + 1e-9)
    least = np.float32(cosine - 1 + x.base - 1e-4)
    product, flags = np.empty(LEAF * LEAF, np.float32), np.empty(LEAF * LEAF, bool)
    todo = [(0, len(x.u), 0, len(y.u))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or x is y and d <= a:
            continue
        (l1, h1), (l2, h2) = x.box(a, b), y.box(c, d)
        if (np.maximum(0, np.maximum(l1 - h2, l2 - h1)) ** 2).sum() > eps2:
            continue
        if b - a > LEAF or d - c > LEAF:
            if b - a >= d - c:
                k = (a + b) // 2
                todo += [(a, k, c, d), (k, b, c, d)]
            else:
                k = (c + d) // 2
                todo += [(a, b, c, k), (a, b, k, d)]
            continue
        shape, n = (b - a, d - c), (b - a) * (d - c)
        near = np.matmul(x.left[a:b], y.right[c:d].T, out=product[:n].reshape(shape))
        at = np.flatnonzero(np.greater(near, least, out=flags[:n].reshape(shape)).ravel())
        if not len(at):
            continue
        i, j = np.divmod(at, d - c)
        if 16 * len(at) > n:
            cos = (x.u[a:b] @ y.u[c:d].T).ravel()[at]
            i, j = i + a, j + c
        else:
            i, j = i + a, j + c
            cos = np.einsum("ij,ij->i", x.u[i], y.u[j])
        good = cos >= cosine
        for k in np.flatnonzero(np.abs(cos - cosine) < 1e-9).tolist():  # decide these as the quotient of plain sums
            p, r = x.x[i[k]].astype(np.float64), y.x[j[k]].astype(np.float64)
            good[k] = np.dot(p, r) / (math.sqrt(np.dot(p, p)) * math.sqrt(np.dot(r, r))) >= cosine
        if x is y:
            good &= i < j
        if good.any():
            yield i[good], j[good]


def connect(first: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of each pair ``i``, ``j``; ``first`` holds the first member of everyone's set."""
    while True:
        p, r = first[i], first[j]
        new = np.flatnonzero(p != r)
        if not len(new):
            return
        i, j, p, r = i[new], j[new], p[new], r[new]
        np.minimum.at(first, np.maximum(p, r), np.minimum(p, r))
        while True:
            up = first[first]
            if (up == first).all():
                break
            first[:] = up


def links(runs: DataFrame, pairs: DataFrame, dim: int, kind: str, mean: np.ndarray, q: np.ndarray, wide: int, cosine: float) -> DataFrame:
    """id, other, n: how many links ``id`` (its place) has, by the number of equal vectors, and the first vector that it
    is connected with, null if it is the first; a row for each tile of pairs in which it has links. ``runs`` (block,
    place, rows, path, place_in) tells where the vectors are."""
    kind = np.dtype(np.float32 if kind == "float" else np.float64)
    q = q[:, :AXES if wide == dim else wide]

    def tile(row):
        of = {}
        for side in ("a_runs", "b_runs"):
            for r in row[side]:
                of.setdefault(r["block"], {})[r["place"]] = r
        wanted = sorted({x for p in row["pairs"] for x in (p["a"], p["b"])})
        base, blocks, ids, count, at = {}, {}, [], [], 0
        for block in wanted:
            vectors, counts = [], []
            for place, r in sorted(of[block].items()):
                fs, where = file_system(r["path"])
                with fs.open_input_file(where) as f:
                    data = f.read_at(r["rows"] * (dim * kind.itemsize + 8), r["place_in"])
                vectors.append(np.frombuffer(data, kind, r["rows"] * dim).reshape(-1, dim))
                counts.append(np.frombuffer(data, np.int64, offset=r["rows"] * dim * kind.itemsize))
                ids.append(np.arange(place, place + r["rows"]))
            blocks[block] = Block(np.concatenate(vectors), mean, q, wide)
            base[block] = at
            count += counts
            at += len(blocks[block].u)
        ids, count = np.concatenate(ids), np.concatenate(count)
        total, first = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for p in sorted((p["a"], p["b"]) for p in row["pairs"]):
            for i, j in join_intervals(*(blocks[x] for x in p), cosine):
                i, j = i + base[p[0]], j + base[p[1]]
                np.add.at(total, i, count[j])
                np.add.at(total, j, count[i])
                connect(first, i, j)
        some = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[first[some]], mask=first[some] == some), pa.array(total[some])], ["id", "other", "n"])

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                yield tile({c: batch.column(c)[r].as_py() for c in batch.schema.names})

    spark = runs.sparkSession
    n, cores = pairs.count(), spark.sparkContext.defaultParallelism
    fit = TILE_BYTES // (2 * BLOCK * dim * (16 + kind.itemsize))  # vectors, unit vectors and factors
    side = max(1, min(TILE, fit, math.isqrt(n // (8 * cores))))
    tiles = pairs.groupBy(F.floor(F.col("a") / side).alias("ta"), F.floor(F.col("b") / side).alias("tb")).agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    of = lambda s: (runs.groupBy(F.floor(F.col("block") / side).alias(f"t{s}"))
                    .agg(F.collect_list(F.struct("block", "place", "rows", "path", "place_in")).alias(f"{s}_runs")))
    tasks = max(1, min(-(-n // side ** 2), max(4 * cores, min(5000, n // 128))))
    return tiles.join(of("a"), "ta").join(of("b"), "tb").repartitionByRange(tasks, "ta", "tb").mapInArrow(run, "id long, other long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding). Links are between vectors:
    rows that share a vec_id but not the vector have their own."""
    spark = vectors.sparkSession
    kind = "float" if vectors.select("embedding").schema[0].dataType in (T.ArrayType(T.FloatType(), True), T.ArrayType(T.FloatType(), False)) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    v = F.col("v").cast("array<double>")
    key = F.unhex(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in (F.xxhash64(v), F.xxhash64(F.reverse(v), F.size("v")))))).alias("k")
    own = rows.where(F.col("id").isNotNull() & fine()).select("id", "v", key, F.size("v").alias("dim"))
    member = stored(own.select("id", "k", "dim"), "ego-members")
    eps, base, found, group = math.sqrt(2 - 2 * cosine), 0, None, None
    for (dim,) in member.select("dim").distinct().collect():
        same = own.where(F.col("dim") == dim)
        mean, q, spread = axes(same, dim)
        runs = in_order(same, dim, kind, mean, q, eps)
        m = min(dim, AXES)
        at = placed(runs).withColumn("block", F.floor(F.col("place") / BLOCK).cast("long")).withColumn("place", F.col("place") + base)
        at = stored(at.drop("k", "rep", "n"), "ego-runs")
        boxes = at.groupBy("block").agg(*(F.min(f"lo{i}").alias(f"lo{i}") for i in range(m)), *(F.max(f"hi{i}").alias(f"hi{i}") for i in range(m)))
        pairs = stored(near_pairs(boxes, m, eps), "ego-pairs")
        more = links(at, pairs, dim, kind, mean, q, width(spread, eps), cosine)
        found = more if found is None else found.union(more)
        ids = (runs.join(at.select("part", "start", "place"), ["part", "start"])
               .select("place", F.posexplode(F.arrays_zip("k", "rep", "n")).alias("i", "x"))
               .select((F.col("place") + F.col("i")).alias("node"), "x.k", "x.rep", "x.n"))
        group = ids if group is None else group.union(ids)
        base += at.agg(F.sum("rows")).first()[0]
    if found is None:
        found = spark.createDataFrame([], "id long, other long, n long")
        group = spark.createDataFrame([], "node long, k binary, rep long, n long")
    found = stored(found, "ego-links")
    edges = found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))
    component = group.select("node", "rep").join(components(edges, "ego").withColumnRenamed("id", "node"), "node")
    first = component.groupBy("component").agg(F.min("rep").alias("component_id"))
    component = component.join(first, "component").select("node", "component_id")
    linked = found.groupBy(F.col("id").alias("node")).agg(F.sum("n").alias("linked"))
    facts = (group.join(linked, "node", "left").join(component, "node", "left")
             .select("k", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    # equal vectors whose place is at a cell's edge may stand in two cells, by rounding: linked then, with the same facts
    facts = facts.groupBy("k").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    by_row = left_join(member.select("id", "k"), stored(facts, "ego-facts"), "k").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    odd = rows.where(F.col("id").isNull() | ~fine()).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = by_row.union(odd)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op6_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: links at a cosine of 0.9 or more, component, and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
