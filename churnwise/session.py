"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every churnwise job assumes. Shuffle partitions stay AQE-coalesced,
# so the large default suits a cluster while small local runs collapse them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", app: str = "churnwise", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the churnwise defaults."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Keep at least one post-shuffle partition per core when AQE coalesces
    # small shuffles, so CPU-heavy row work after a small shuffle still runs
    # on every core (large shuffles are far above this floor anyway).
    conf.setdefault("spark.sql.adaptive.coalescePartitions.minPartitionNum", str(shuffle_partitions))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is; without
    it this fails, since a folder of one machine would lose what the others
    write. Only a local master gets a scratch folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="churnwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a new sub-folder of the shared folder and read it back: what follows scans the table
    instead of deriving it again, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:10]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
