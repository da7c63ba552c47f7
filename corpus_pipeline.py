"""Corpus pipeline: quality, near copies, benchmark passages, personal data, tokens.

Each stage takes the documents that its predecessor kept, written as Parquet
and read again, and applies one operator to all of them. All but the last
return the columns of ``documents``.

Every stage sets the session's Arrow batches to ``BATCH_ROWS`` rows and
``BATCH_BYTES`` bytes at most (a longer row is a batch of its own): rows hold
whole texts, and a small executor runs all stages.

Null, empty and very long texts pass through every stage: a null or empty one
is scored like others, has no near copies, benchmark passages or personal data,
and no tokens. A null doc_id stays a row of its own; repeated rows are near
copies of each other. An empty table gives no rows. Further columns pass
through the filtering stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnwise.llm import op1_jaccard, op3_quality, op4_suffix, op9_pii, op10_bpe
from churnwise.llm.common import stored, table


BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; it learns from the labels of those it is given."""
    small_batches(spark)
    return op3_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each group linked by 5-word shingles at 0.8 or more."""
    small_batches(spark)
    return op1_jaccard.drop_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words (or a whole shorter text) of a benchmark item."""
    small_batches(spark)
    return op4_suffix.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and disclosing terms in the texts; n_chars follows. No document goes."""
    small_batches(spark)
    out = op9_pii.sanitise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the digest of the text decoded from them."""
    small_batches(spark)
    both = op10_bpe.encode(docs.select("doc_id", "source", "lang", "text"), decoded="decoded", keep=False)
    return both.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
                                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("tokens", tokens)]

#: A fitted classifier, graph components, mutual information and BPE merges are not expressible in SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
