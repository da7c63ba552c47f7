"""N-gram Jaccard join by parity sketches.

Two sets with Jaccard similarity t or more differ in at most
``(1 - t) / (1 + t) * (|A| + |B|)`` elements. Documents are grouped into size
bands such that linked sets lie in the same band or in neighbouring ones, and
for each pair of neighbouring bands the largest possible difference d is
fixed. The space of shingle hashes is cut into d + 1 parts: by the pigeonhole
principle, two linked sets agree entirely in one part. The key of a part is
the XOR of its shingles' hashes; documents meet on equal keys.

Where there are many parts, only so many are looked at (``looks``) that two
linked sets are missed with odds below ``ODDS``: whatever the sets, d
differences spread over d + 1 parts by a hash leave each part untouched with
odds above 0.36, and touching one part makes touching another less likely. A
part with fewer than ``LEAST`` shingles says little (documents that share a
passage agree in many such parts) and gives no key; what is untouched has as
many shingles in both sets, so the looks are counted with that. A document with
fewer parts than looks is cut again with further seeds, until all parts of a
cut have keys or the looks are done. Sets with fewer than ``FEW`` parts use
parts of any size but empty ones. With ``odds=None`` all d + 1 parts have keys,
the empty ones too: then linked sets always meet.

Documents that meet form coarse clusters; equal sets are collapsed to one
member before. Within a cluster (in blocks, pair by pair, where it is large)
bit sketches, in which every shingle flips one bit, are compared: their
Hamming distance never exceeds the sets' difference, so only pairs within the
bound are verified on the sets themselves, and only while they are not
connected yet. No pairs are listed; links that connect are, at most one fewer
than there are members.

Sets are of 64-bit shingle hashes. A null or empty text, or one of white space,
has no shingles and links with nothing. A null doc_id links with nothing and
has no component. Repeated doc_ids are one document for the links and give a
row each. Texts are read whole; other columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Recent, components, filter_bit, hashes, id_filter, in_filter, mix, rows_per_batch, runs, shingles, slices, space_words, stored, table, texts, tidy, word_memo
from .skew import left_join

WORDS, PERCENT = 3, 90
#: Odds of missing a linked pair (less than what 64-bit hashes of shingles cost), shingles that a part needs for a key,
#: and the number of parts below which any will do.
ODDS, LEAST, FEW = 4e-13, 3, 8
#: A block of a cluster holds about so many members and bytes of sets at most.
BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20


class Bands:
    """Size bands for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, self.low = percent, [1]

    def band(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def parts(self, scheme: int) -> int:
        """Parts for the pair of bands ``scheme`` and ``scheme + 1``: one more than the largest difference."""
        while len(self.low) < scheme + 3:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return 2 * (self.low[scheme + 2] - 1) * (100 - self.percent) // (100 + self.percent) + 1


@functools.lru_cache(500)
def edges(parts: int, most: int) -> np.ndarray:
    """Where each part of the hash space begins, as far as parts are used."""
    return np.array([(i << 64) // parts for i in range(min(parts, most + 1))], np.uint64)


@functools.lru_cache(20)
def looks(percent: int, odds: float, least: int) -> int:
    """Parts to look at, so that two linked sets agree in none that has ``least`` shingles with at most ``odds``. Sets of
    the share s of a scheme's largest size have s differences a part, and s t / (1 - t) common shingles."""
    t = percent / 100

    def agree(s: float) -> float:
        common = s * t / (1 - t)
        return math.exp(-s) * (1 - sum(math.exp(-common) * common ** i / math.factorial(i) for i in range(least)))

    worst = min(agree(t * t + (1 - t * t) * i / 10) for i in range(11)) if percent < 100 else 1 - 1e-9
    return max(64, math.ceil(math.log(odds) / math.log(1 - worst)))


def part_keys(h: np.ndarray, scheme: int, parts: int, seed: int, most: int, least: int) -> tuple[np.ndarray, bool]:
    """Keys of the parts of a set that have ``least`` shingles, and whether there is one that has not."""
    if seed:
        h = np.sort(mix(h + np.uint64(seed)))
    at = np.searchsorted(h, edges(parts, most))
    at = np.append(at, len(h))[:most + 1]
    full = np.diff(at) >= least
    total = np.append(np.uint64(0), np.bitwise_xor.accumulate(mix(h[:at[-1]] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))) if at[-1] else np.zeros(1, np.uint64)
    value = (total[at[1:]] ^ total[at[:-1]])[full]
    place = np.flatnonzero(full).astype(np.uint64) + np.uint64((scheme << 40) + (seed << 32))
    return mix(value + mix(place)), not full.all()


def all_part_keys(h: np.ndarray, scheme: int, parts: int) -> np.ndarray:
    """Keys of all parts of a set; an empty part has the XOR 0."""
    value = np.zeros(parts, np.uint64)
    own = (h.astype(object) * parts >> 64).astype(np.int64) if parts < 1 << 32 else None
    np.bitwise_xor.at(value, own, mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    place = np.arange(parts, dtype=np.uint64) + np.uint64((scheme << 40) + (0xFF << 32))
    return mix(value + mix(place))


def keys(h: np.ndarray, bands: Bands, odds: float | None = ODDS) -> np.ndarray:
    """All keys under which a set meets others."""
    own, out = bands.band(len(h)), []
    for scheme in (own - 1, own):
        parts = bands.parts(scheme) if scheme >= 0 else 1
        if parts == 1:  # linked sets are equal
            continue
        if odds is None:
            out.append(all_part_keys(h, scheme, parts))
            continue
        least = 1 if parts < FEW else LEAST
        most = looks(bands.percent, odds, least)
        for seed in range(-(-most // parts)):
            k, weak = part_keys(h, scheme, parts, seed, most, least)
            out.append(k)
            if not weak:
                break
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketched(docs: DataFrame, text: str, words: int, percent: int, odds: float | None = ODDS) -> DataFrame:
    """doc_id, n (set size), fp1 and fp2 (fingerprint of the set), keys. Of equal sets with a doc_id seen by a task, one
    has keys; rows without a doc_id have none."""
    def run(batches):
        memo, bands, seen = word_memo(), Bands(percent), Recent(lambda ks: [(k, None) for k in ks], 100_000)
        for b in slices(batches, text):
            n, fp1, fp2, out = [], [], [], []
            for t, known in zip(texts(b.column(text)), b.column("doc_id").is_valid().to_pylist()):
                h = shingles(hashes(space_words(t), memo), words)
                n.append(len(h))
                fp1.append(int(np.bitwise_xor.reduce(mix(h))) if len(h) else 0)
                fp2.append(int(np.add.reduce(mix(h + np.uint64(1)), dtype=np.uint64)) if len(h) else 0)
                k = (n[-1], fp1[-1], fp2[-1])
                first = known and k not in seen.now and k not in seen.old
                if known:
                    seen.of({k})
                out.append(keys(h, bands, odds).view(np.int64) if first and len(h) else [])
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), signed(fp1), signed(fp2), pa.array(out, pa.list_(pa.int64()))],
                                             ["doc_id", "n", "fp1", "fp2", "keys"])

    return docs.select("doc_id", text).mapInArrow(tidy(run), "doc_id long, n long, fp1 long, fp2 long, keys array<long>")


class Sets:
    """Joined sets: who is connected with whom so far."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def linked(sets: list[np.ndarray], block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all that is connected, among members of one block or (``block``: 0 and 1) between two."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    sets, size, block = [sets[i] for i in order], size[order], block[order]
    bits = max(64, 1 << int(4 * size[-1] - 1).bit_length())
    sketch = np.empty((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        sketch[i] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    both, out, joined = block.any() and not block.all(), [], Sets(len(sets))
    step = max(1, (4 << 20) // sketch.shape[1])
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(size, size[i] * 100 // percent, "right"))
        for a in range(i + 1, end, step):
            z = min(end, a + step)
            far = np.bitwise_count(sketch[a:z] ^ sketch[i]).sum(1, dtype=np.int64)
            near = far * (100 + percent) <= (size[a:z] + size[i]) * (100 - percent)
            if both:
                near &= block[a:z] != block[i]
            for j in (np.flatnonzero(near) + a).tolist():
                if joined.root(i) != joined.root(j):
                    same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * same >= percent * (size[i] + size[j] - same):
                        joined.join(i, j)
                        out.append((int(order[i]), int(order[j])))
    return out


def links_within(members: DataFrame, docs: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """Links (a, b) within coarse clusters. ``members``: doc_id, cluster, blocks, block. Only members' sets are moved: a
    filter of fixed size tells most of the other documents before the join."""
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(members, "doc_id"))

    def sets_of(batches):
        memo, bits = word_memo(), shared.value
        for batch in batches:
            near = batch.filter(pa.array(in_filter(bits, batch.column("bit").to_numpy())))
            for b in slices([near], "text", 1 << 20):
                items = [shingles(hashes(space_words(t), memo), words).tobytes() for t in texts(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(items, pa.binary())], ["doc_id", "items"])

    def verify(batches):
        for (_, lo, hi), t in runs(batches, ["cluster", "lo", "hi"]):
            ids, block = t.column("id").to_pylist(), t.column("side").to_numpy()
            if len(ids) < 2 or lo != hi and (block == block[0]).all():
                continue
            found = linked([np.frombuffer(x.as_py(), np.uint64) for x in t.column("items")], block, percent)
            if found:
                yield pa.RecordBatch.from_pydict({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

    sets = docs.where("doc_id is not null").select("doc_id", F.col(text).alias("text"), filter_bit("doc_id").alias("bit")).mapInArrow(
        tidy(sets_of), "doc_id long, items binary")
    # the plan is the same at every size: a merge join, no broadcast of members while they are few
    each = sets.join(members.hint("merge"), "doc_id").select(
        "cluster", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), F.col("doc_id").alias("id"), "items")
    pairs = each.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                        (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "items")
    return (pairs.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
            .mapInArrow(tidy(verify), "a long, b long"))


def similar(docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT, odds: float | None = ODDS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``. ``odds``: of missing a linked pair (see above);
    None: linked sets meet for certain, with a key for every part of a set."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    seen = stored(sketched(docs, text, words, percent, odds), "jaccard-sketches")
    known = seen.where("doc_id is not null and n > 0")
    same = known.select("doc_id", "n", F.concat_ws(":", "n", "fp1", "fp2").alias("set"))
    exact = left_join(same, same.groupBy("set").agg(F.min("doc_id").alias("rep")), "set")
    exact = stored(exact.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"), "n"), "jaccard-equal")
    met = known.select("doc_id", F.explode("keys").alias("key"))
    met = met.select(F.col("doc_id").alias("a"), F.min("doc_id").over(Window.partitionBy("key")).alias("b")).where("a <> b").distinct()
    equal = exact.where("a <> b").select("a", "b")
    met = stored(met, "jaccard-met")
    coarse = components(met.union(equal), "jaccard-coarse")
    # one member for each set; clusters of one set need no look
    member = exact.where("a = b").select(F.col("a").alias("id"), "n").distinct().join(coarse, "id")
    sizes = member.groupBy("component").agg(F.count("*").alias("rows"), F.sum(8 * F.col("n")).alias("bytes")).where("rows > 1")
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int")
    member = stored(member.join(sizes.select("component", blocks.alias("blocks")), "component")
                    .select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"), "blocks",
                            F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")), "jaccard-members")
    with rows_per_batch(docs.sparkSession, 250):  # a row holds a set
        links = stored(links_within(member, docs, text, words, percent), "jaccard-verified")
    final = components(links.union(equal), "jaccard")
    return (seen.select("doc_id", F.col("n").alias("n_shingles")).join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def drop_similar(docs: DataFrame, text: str = "text", words: int = 5, percent: int = 80, odds: float | None = ODDS) -> DataFrame:
    """One document of each group of similar ones, that with the smallest doc_id; all columns. Rows that share a doc_id
    but not the text are documents of their own; of rows that repeat both one stays; rows without a doc_id all stay."""
    number = F.col("doc_id").cast("long")
    own = F.when(number.isNotNull(), F.xxhash64(number, text))
    found = similar(docs.select(own.alias("doc_id"), text), text, words, percent, odds)
    names = docs.where("doc_id is not null").select(own.alias("node__"), number.alias("id__")).distinct()
    group = (found.where("doc_id is not null").groupBy(F.col("doc_id").alias("node__"), "component_id").agg(F.count("*").alias("rows__"))
             .join(names, "node__"))
    kept = stored(group.groupBy("component_id").agg(F.min(F.struct("id__", "node__", "rows__")).alias("first"))
                  .select("first.node__", "first.rows__"), "jaccard-kept")
    with_id = docs.where("doc_id is not null").withColumn("node__", own).join(kept.hint("merge"), "node__")
    return (with_id.where("rows__ = 1").select(docs.columns).union(with_id.where("rows__ > 1").dropDuplicates(["node__"]).select(docs.columns))
            .union(docs.where("doc_id is null")))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the size of its set of 3-word shingles and the smallest doc_id reachable by links of 0.9 or more."""
    return similar(table(spark, sf_dir, "documents"))
