"""T5: latest score per customer as a key-bucketed snapshot that is rewritten bucket by bucket (copy on write).

A customer lies in one of ``buckets`` buckets by a hash of the key. A micro-batch merges its newest rows with the current
files of the buckets that it touches and writes only these, below ``data/v=<batch>/bucket=<b>``; then it commits a
manifest that names the version of every bucket. Readers take the newest manifest whose writing ended, so they see whole
versions only; a batch that is tried again finds the manifest before it unchanged and writes the same version anew.
Folders that neither of the two newest manifests names are removed.

The number of buckets belongs to the snapshot (it is kept in the manifest) and bounds everything that the driver handles:
the touched buckets of a batch and the rows of a manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import latest_per_key
from .jobs import _run

BUCKETS = 64
MANIFEST = "bucket int, version long, buckets int"


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the folders ``<prefix><number>`` in ``path``."""
    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def manifests(spark: SparkSession, snap: str) -> list[int]:
    """Versions whose manifest is complete, ascending."""
    return [v for v in _children(spark, f"{snap}/manifest", "v=")
            if (lambda fs, p: fs.exists(p))(*_fs(spark, f"{snap}/manifest/v={v}/_SUCCESS"))]


def read_manifest(spark: SparkSession, snap: str, version: int) -> dict[int, int]:
    """bucket -> version of its files; at most as many entries as there are buckets."""
    return {r.bucket: r.version for r in spark.read.schema(MANIFEST).parquet(f"{snap}/manifest/v={version}").collect()}


def _read(spark: SparkSession, snap: str, schema, where: dict[int, int]) -> DataFrame:
    """The rows of the buckets of ``where`` (bucket -> version), with the column ``bucket``."""
    paths = [f"{snap}/data/v={v}/bucket={b}" for b, v in sorted(where.items())]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def merge(spark: SparkSession, snap: str, batch: DataFrame, version: int, key: str = "customer_id",
          order: tuple[str, ...] = ("created_at", "id"), buckets: int = BUCKETS) -> set[int]:
    """Merge ``batch`` into the snapshot as ``version``; returns the touched buckets."""
    before = [v for v in manifests(spark, snap) if v < version]
    current = read_manifest(spark, snap, before[-1]) if before else {}
    if before:
        kept = spark.read.parquet(f"{snap}/manifest/v={before[-1]}").select("buckets").first()
        buckets = kept[0] if kept else buckets
    newest = latest_per_key(batch, key, list(order))
    touched = {r[0] for r in newest.select(bucket_of(key, buckets)).distinct().collect()}
    if not touched and before:
        return touched
    old = _read(spark, snap, batch.schema, {b: v for b, v in current.items() if b in touched})
    merged = latest_per_key(old.unionByName(newest.select(*batch.columns)), key, list(order)).withColumn("bucket", bucket_of(key, buckets))
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{snap}/data/v={version}")
    now = current | dict.fromkeys(touched, version)
    rows = [(b, v, buckets) for b, v in sorted(now.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{snap}/manifest/v={version}")
    _remove_unused(spark, snap, [m for m in (current, now) if m])
    return touched


def _remove_unused(spark: SparkSession, snap: str, named: list[dict[int, int]]) -> None:
    used = {(b, v) for m in named for b, v in m.items()}
    for v in _children(spark, f"{snap}/data", "v="):
        here = _children(spark, f"{snap}/data/v={v}", "bucket=")
        gone = [b for b in here if (b, v) not in used]
        for path in [f"{snap}/data/v={v}"] if len(gone) == len(here) else [f"{snap}/data/v={v}/bucket={b}" for b in gone]:
            fs, p = _fs(spark, path)
            fs.delete(p, True)


def read_snapshot(spark: SparkSession, out: str, schema) -> DataFrame:
    """The newest complete version."""
    snap = f"{out}/snapshot"
    done = manifests(spark, snap)
    return _read(spark, snap, schema, read_manifest(spark, snap, done[-1]) if done else {})


def latest_score_upsert(spark: SparkSession, landing: str, out: str, schema: str, files_per_trigger: int = 1,
                        buckets: int = BUCKETS) -> list:
    """T5: score rows stream in from the folder ``landing``; every micro-batch is merged into ``out``/snapshot."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read twice: for the touched buckets and for the merge
        try:
            merge(spark, f"{out}/snapshot", batch, batch_id, buckets=buckets)
        finally:
            batch.unpersist()

    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    return _run(spark, src.writeStream.foreachBatch(upsert).option("checkpointLocation", f"{out}/_checkpoint")
                .trigger(availableNow=True))
