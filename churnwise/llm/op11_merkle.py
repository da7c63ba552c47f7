"""Merkle manifest of a table by time-forward processing.

Each row is a leaf; the leaves of a group (a language) in order, then the groups' subroots in order, form trees in which
every two consecutive nodes (a last one alone) become their hash. Every leaf gets its proof: the siblings on its way up.

Time-forward processing: a node is an event at the time of its label, what it needs comes as messages that its children
(upwards) or its parent (downwards) put into a priority queue ordered by label. The queue has two levels:

* inside a segment, 2^``HEIGHT`` consecutive nodes of a level, labels are postorder (last position covered, then level).
  A task sweeps over the sorted rows of its segments; a node's digest goes to its parent's label, and nodes due are
  computed before the next leaf is read. The messages waiting are at most two a level, however many leaves there are.
  The reversed sweep reads the nodes by descending label: each hands its children the proof suffix (their sibling and
  its own suffix), again at most two a level.
* between segments the queue is external: tops of segments are written to the shared folder as the leaves of the next
  round, and Spark's sorted shuffle by (group, segment, label) delivers them. On the way back the suffixes of the tops,
  rows with the highest label, meet their segment's nodes in the same sort. Rounds: log of the largest group to base
  2^HEIGHT, so 3 for 10^10 leaves.

Positions: rows are sorted by range partitions, numbered within the partition in the task, and the numbers that a
group's earlier partitions hold are added. Only a partition's first group has any, so that is one row a partition at
most, which is broadcast. No group is ever collected in one task; a group with all the rows is as good as many.

H is lowercase hex sha256. A leaf is H of the stated columns, each ``-`` if null, else the byte count of its UTF-8 text,
``:`` and the text (``fields``). Null groups come first, then bytewise; in a group null orders come first, equal orders
by leaf digest (rows that are equal in all fields are interchangeable). Long texts are hashed whole, by Spark. An empty
table gives no rows. Columns that are not fields are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import stored, table

HEIGHT = 12
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE = "grp string, seg long, label long, first string, second string, ref long"
PROOF = "grp string, pos long, ref long, leaf string, found string, tree string, siblings string, sides string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """H of the fields."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the position of each row among those of its ``grp`` (never null) in ``order``; ``rows`` is stored."""
    schema = T.StructType([*rows.schema, T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])

    def run(batches):
        last, n = None, 0
        for b in batches:
            pos = []
            for g in b.column("grp").to_pylist():
                if g != last:
                    last, n = g, 0
                pos.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pos, pa.int64())], schema.names)

    ranged = rows.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id())
    out = stored(ranged.sortWithinPartitions("grp", *order).mapInArrow(run, schema), "merkle-order")
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    earlier = (out.groupBy("grp", "part").agg(F.count("*").alias("n")).withColumn("before", before)
               .where("before > 0").select("grp", "part", "before"))  # a partition's first group only
    return out.join(F.broadcast(earlier), ["grp", "part"], "left").withColumn(
        "pos", F.col("pos") + F.coalesce("before", F.lit(0))).drop("part", "before")


def label_of(level: int, index: int) -> int:
    """Postorder: by the last position that a node covers, then by level."""
    return ((index + 1 << level) - 1) * 64 + level


def place(label: int) -> tuple[int, int]:
    level = label & 63
    return level, ((label >> 6) + 1 >> level) - 1


class Upward:
    """The upward sweep over one segment: leaves come in order, nodes are computed when they are due."""

    def __init__(self, height: int):
        self.height, self.queue, self.count, self.spine = height, [], 0, [None] * (height + 1)

    def send(self, level: int, index: int, value: str) -> None:
        if index == 0:
            self.spine[level] = value
        if level < self.height:
            heapq.heappush(self.queue, (label_of(level + 1, index >> 1), index, value))

    def due(self, before: int):
        """Compute the nodes whose time is before ``before``: (label, first child, second child or None)."""
        while self.queue and self.queue[0][0] < before:
            label, _, first = heapq.heappop(self.queue)
            second = heapq.heappop(self.queue)[2] if self.queue and self.queue[0][0] == label else None
            yield label, first, second
            self.send(*place(label), digest(first, second or ""))

    def leaf(self, value: str):
        yield from self.due(label_of(0, self.count))
        self.send(0, self.count, value)
        self.count += 1

    def end(self):
        """What is left, then a summary: -1 - label of the root of these leaves alone, its digest, the top's at full height."""
        yield from self.due(1 << 62)
        level = (self.count - 1).bit_length()
        yield -1 - label_of(level, 0), self.spine[level], self.spine[self.height]


def batches_of(rows, schema: str, most: int = 4000):
    """Arrow batches of an iterator of tuples."""
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    kinds = [pa.int64() if k == "long" else pa.string() for k in kinds]
    held = []
    make = lambda: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield make()
            held = []
    if held:
        yield make()


def upward(leaves: DataFrame, height: int) -> DataFrame:
    """All nodes (NODE) of the segments of ``leaves`` (grp, pos, digest, found, ref), stored: inner nodes hold their
    children's digests, leaves their own and ``found``; a segment's summary has a negative label (``Upward.end``)."""
    def sweep(batches):
        key, up = None, None
        for b in batches:
            for grp, seg, value, found, ref in zip(*(c.to_pylist() for c in b.columns)):
                if (grp, seg) != key:
                    if up:
                        yield from ((*key, *x, None) for x in up.end())
                    key, up = (grp, seg), Upward(height)
                yield from ((*key, *x, None) for x in up.leaf(value))
                yield *key, label_of(0, up.count - 1), value, found, ref
        if up:
            yield from ((*key, *x, None) for x in up.end())

    split = leaves.withColumn("seg", F.shiftright("pos", height))
    return stored(split.repartition("grp", "seg").sortWithinPartitions("grp", "seg", "pos")
                  .select("grp", "seg", "digest", "found", "ref").mapInArrow(lambda b: batches_of(sweep(b), NODE), NODE), "merkle-nodes")


def downward(nodes: DataFrame, suffixes: DataFrame, height: int) -> DataFrame:
    """Proofs (PROOF) of the leaves of ``nodes``; ``suffixes`` has a row for each segment: grp, seg, label of the node
    that it belongs to, tree, siblings, sides. ``tree`` passes through."""
    def sweep(batches):
        key, queue, tree = None, [], None
        for b in batches:
            for grp, seg, label, sent, first, second, ref, t, siblings, sides in zip(*(c.to_pylist() for c in b.columns)):
                if (grp, seg) != key:
                    key, queue = (grp, seg), []
                if sent:
                    heapq.heappush(queue, (-label, siblings, sides))
                    tree = t
                    continue
                if not queue or queue[0][0] != -label:
                    continue  # above the root of its group's only segment
                _, siblings, sides = heapq.heappop(queue)
                level, index = place(label)
                if level == 0:
                    yield grp, (seg << height) + index, ref, first, second, tree, siblings, sides
                    continue
                heapq.heappush(queue, (-label_of(level - 1, 2 * index), (second or "") + siblings, ("2" if second is None else "0") + sides))
                if second is not None:
                    heapq.heappush(queue, (-label_of(level - 1, 2 * index + 1), first + siblings, "1" + sides))

    none = lambda *columns: [F.lit(None).cast(t).alias(c) for c, t in columns]
    own = nodes.where("label >= 0").select("grp", "seg", "label", F.lit(0).alias("sent"), "first", "second", "ref",
                                           *none(("tree", "string"), ("siblings", "string"), ("sides", "string")))
    sent = suffixes.select("grp", "seg", "label", F.lit(1).alias("sent"), *none(("first", "string"), ("second", "string"), ("ref", "long")),
                           "tree", "siblings", "sides")
    return (own.unionByName(sent).repartition("grp", "seg").sortWithinPartitions("grp", "seg", F.col("label").desc(), F.col("sent").desc())
            .mapInArrow(lambda b: batches_of(sweep(b), PROOF, 1000), PROOF))


class Forest:
    """One tree for each ``grp`` of ``leaves`` (grp, pos, digest, found, ref; stored)."""

    def __init__(self, leaves: DataFrame, height: int = HEIGHT):
        self.height, self.rounds, found = height, [], []
        while True:
            nodes = upward(leaves, height)
            self.rounds.append(nodes)
            tops = nodes.where("label < 0").select("grp", "seg", (-1 - F.col("label")).alias("label"), F.col("first").alias("root"),
                                                   F.col("second").alias("top"))
            more = tops.where("seg = 1").select("grp")
            found.append(tops.where("seg = 0").join(more, "grp", "left_anti")
                         .select("grp", "label", F.col("root").alias("digest"), F.lit(len(found)).alias("round")))
            up = tops.where("seg > 0").unionByName(tops.where("seg = 0").join(more, "grp", "left_semi"))
            leaves = stored(up.select("grp", F.col("seg").alias("pos"), F.col("top").alias("digest"), F.lit(None).cast("string").alias("found"),
                                      F.lit(None).cast("long").alias("ref")), "merkle-tops")
            if leaves.isEmpty():
                break
        roots = found[0]
        for x in found[1:]:
            roots = roots.unionByName(x)
        #: grp, label, digest, round of each tree's root
        self.roots = stored(roots, "merkle-roots")

    def proofs(self, suffixes: DataFrame) -> DataFrame:
        """PROOF of every leaf; ``suffixes`` has grp, tree, siblings, sides of each root. ``siblings`` are the digests
        beside the way up, one after the other; ``sides`` has a letter a level: the node on the way is the first (0) or
        second (1) of its run, or alone in it (2, without a sibling)."""
        below = None
        tops = self.roots.join(suffixes, "grp")
        for i, nodes in reversed(list(enumerate(self.rounds))):
            here = tops.where(F.col("round") == i).select("grp", F.lit(0).cast("long").alias("seg"), "label", "tree", "siblings", "sides")
            if below is not None:
                here = here.unionByName(stored(below, "merkle-suffixes").select(
                    "grp", F.col("pos").alias("seg"), F.lit(label_of(self.height, 0)).cast("long").alias("label"), "tree", "siblings", "sides"))
            below = downward(nodes, here, self.height)
        return below


def fold(value: str, siblings: str, sides: str) -> str:
    """The root that follows from a leaf and its proof."""
    at = 0
    for side in sides:
        if side == "2":
            value = digest(value)
        else:
            beside = siblings[at:at + 64]
            at += 64
            value = digest(value, beside) if side == "0" else digest(beside, value)
    return value


def manifest(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per leaf: ref, leaf, found, subroot, root, siblings, sides. ``leaves``: grp (string, null allowed), ref (long, null
    allowed), digest, found (a digest to be checked against the proof later, or null). Ordered by ref within a group."""
    none = F.lit(None).cast("string")
    grp = F.coalesce(F.concat(F.lit("="), "grp"), F.lit(""))  # null first
    rows = stored(leaves.withColumn("grp", grp).select("grp", "ref", "digest", "found"), "merkle-leaves")
    # rows that are equal so far are told apart by their place in the stored table, so that they can be dealt out
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    forest = Forest(numbered(rows, ["ref", "digest", "row"]).select("grp", "pos", "digest", "found", "ref"), height)
    subroots = numbered(forest.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"])
    subroots = stored(subroots, "merkle-subroots")
    above = Forest(subroots.select("grp", "pos", "digest", none.alias("found"), F.lit(None).cast("long").alias("ref")), height)
    root = above.roots.first()
    proofs = above.proofs(above.roots.select("grp", F.col("digest").alias("tree"), F.lit("").alias("siblings"), F.lit("").alias("sides")))
    down = subroots.select("pos", F.col("name").alias("grp"), "digest").join(proofs.drop("grp"), "pos")
    out = forest.proofs(stored(down.select("grp", F.col("digest").alias("tree"), "siblings", "sides"), "merkle-down"))
    return out.select("ref", "leaf", "found", F.col("tree").alias("subroot"), F.lit(root and root.digest).cast("string").alias("root"), "siblings", "sides")


CHECKED = "ref long, leaf string, subroot string, root string, siblings string, folded_root string"


def checked(proofs: DataFrame) -> DataFrame:
    """CHECKED: ``folded_root`` follows from ``found`` (or ``leaf``, if it is null) and the proof."""
    def run(batches):
        for b in batches:
            value = b.column("found").fill_null("").to_pylist()
            kept = [b.column(c) for c in ("ref", "leaf", "subroot", "root", "siblings")]
            rows = zip(value, *(b.column(c).to_pylist() for c in ("leaf", "siblings", "sides")))
            yield pa.RecordBatch.from_arrays([*kept, pa.array([fold(v or leaf, x, s) for v, leaf, x, s in rows], pa.string())],
                                             [x.split()[0] for x in CHECKED.split(", ")])

    return proofs.mapInArrow(run, CHECKED)


def tampered(doc_id: str = "doc_id") -> Column:
    """Whether a row's n_chars is changed after the manifest; never for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 0, F.lit(False))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, the subroot of its lang, the root, its proof's digest, and whether it is verified."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    leaves = docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("ref"), leaf([F.col(c) for c in FIELDS]).alias("digest"),
                         F.when(tampered(), leaf(more)).alias("found"))
    done = checked(manifest(leaves))
    return done.select(F.col("ref").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


_BYTE = "list_reduce(list_value(xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))"
#: crc32 of the decimal doc_id, bit by bit
_CRC = f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {_BYTE}))"


def _leaf_sql(n_chars: str) -> str:
    cast = lambda c: f"CAST({n_chars if c == 'n_chars' else c} AS VARCHAR)"
    part = lambda c: f"coalesce(CAST(octet_length(encode({cast(c)})) AS VARCHAR) || ':' || {cast(c)}, '-')"
    return f"sha256({' || '.join(map(part, FIELDS))})"


def _levels_sql(name: str, source: str) -> str:
    """All nodes of the trees of ``source`` (g, idx, digest, n): g, level, idx, digest, n (nodes of that level)."""
    return f"""{name} AS (SELECT g, 0 AS level, idx, digest, n FROM {source} UNION ALL
       SELECT g, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, level, idx // 2, n)"""


#: The same in SQL.
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS found FROM documents),
 e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest, COUNT(*) OVER (PARTITION BY g) AS n FROM d),
 {_levels_sql('low', 'e')},
 sub AS (SELECT g, digest, max(level) OVER (PARTITION BY g) AS top FROM low WHERE n = 1),
 s AS (SELECT '' AS g, g AS name, digest, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, COUNT(*) OVER () AS n FROM sub),
 {_levels_sql('high', 's')},
 way AS (SELECT e.doc_id, e.idx AS leaf_idx, e.g, low.level, e.idx >> low.level AS idx, low.digest AS sibling, 0 AS tier
         FROM e JOIN low ON low.g = e.g AND low.n > 1 AND low.idx = xor(e.idx >> low.level, 1) UNION ALL
         SELECT e.doc_id, e.idx, e.g, 1000 + high.level, s.idx >> high.level, high.digest, 1
         FROM e JOIN s ON s.name = e.g JOIN high ON high.n > 1 AND high.idx = xor(s.idx >> high.level, 1)),
 steps AS (SELECT e.g, e.idx AS leaf_idx, l.level FROM e JOIN (SELECT DISTINCT g, level FROM low WHERE n > 1) l USING (g) UNION ALL
           SELECT e.g, e.idx, 1000 + l.level FROM e, (SELECT DISTINCT level FROM high WHERE n > 1) l),
 path AS (SELECT st.g, st.leaf_idx, row_number() OVER (PARTITION BY st.g, st.leaf_idx ORDER BY st.level) AS k, w.idx, w.sibling
          FROM steps st LEFT JOIN way w ON w.g = st.g AND w.leaf_idx = st.leaf_idx AND w.level = st.level),
 f AS (SELECT g, idx AS leaf_idx, CAST(0 AS BIGINT) AS k, found AS v FROM e UNION ALL
       SELECT f.g, f.leaf_idx, f.k + 1, sha256(CASE WHEN p.sibling IS NULL THEN f.v WHEN p.idx % 2 = 0 THEN f.v || p.sibling ELSE p.sibling || f.v END)
       FROM f JOIN path p ON p.g = f.g AND p.leaf_idx = f.leaf_idx AND p.k = f.k + 1),
 folded AS (SELECT g, leaf_idx, arg_max(v, k) AS folded_root FROM f GROUP BY g, leaf_idx),
 proof AS (SELECT g, leaf_idx, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM path GROUP BY g, leaf_idx),
 root AS (SELECT digest AS root FROM high WHERE n = 1)
SELECT e.doc_id, e.leaf, sub.digest AS subroot, root.root, coalesce(proof.proof_sha256, sha256('')) AS proof_sha256, folded.folded_root,
       folded.folded_root = root.root AS verified
FROM e JOIN sub USING (g) CROSS JOIN root JOIN folded ON folded.g = e.g AND folded.leaf_idx = e.idx
LEFT JOIN proof ON proof.g = e.g AND proof.leaf_idx = e.idx
"""
