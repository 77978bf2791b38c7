"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``coldflow.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldflow.llm import decontam, huffman, jaccard, queries, toxicity
from coldflow.llm.workers import importable
from coldflow.session import remove_path, scratch_path, stage_table, work_tables


ROW = "_pipeline_row"

#: Python workers live through all stages, so what a worker has freed must go back to the system:
#: Arrow's buffers by the C library, large blocks as mappings of their own, the rest trimmed.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(32 << 20),
}

#: A batch of long texts is cut at this size on its way to a Python worker: the JVM, the stream and the worker each hold a copy.
BATCH_BYTES = "2m"

#: Near duplicates are first combined inside a batch, so theirs are larger.
COMBINED_BYTES = "8m"

#: Rows that a scan decodes at once: of whole texts the usual 4,096 are arrays of many MB in each task.
SCAN_ROWS = "512"


def _workers(spark: SparkSession, batch_bytes: str = BATCH_BYTES) -> None:
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", SCAN_ROWS)
    spark.sparkContext.environment.update(WORKER_MEMORY)


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number of their own in ROW: ids may be null or repeat, rows are what a stage keeps or drops.

    The copy of the texts stays until the stage's result is written, so it is packed well.
    """
    path = scratch_path(spark := docs.sparkSession, f"pipeline-{name}-rows")
    docs.withColumn(ROW, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _as_documents(rows: DataFrame) -> DataFrame:
    """The texts under their row numbers, for operators that tell documents apart by doc_id."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def _decided(spark: SparkSession, name: str, decide: Callable[[], DataFrame]) -> DataFrame:
    """What ``decide`` returns as a staged table; the tables it staged on the way there go."""
    path = scratch_path(spark, f"pipeline-{name}")
    with work_tables(spark):
        decide().write.parquet(path)
    return spark.read.parquet(path)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity score of 0.5 or more; the classifier learns from the stage's labelled documents."""
    _workers(spark)
    scored = toxicity.score(docs, queries.toxicity_model(spark, docs, sf_dir), "_toxic_score", "_toxic")
    return scored.where("_toxic = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id, of several rows with it, one; null ids come last."""
    _workers(spark, COMBINED_BYTES)
    rows = _numbered(docs, "near-duplicates")

    def copies() -> DataFrame:
        found = stage_table(jaccard.components(_as_documents(rows)).select(F.col("doc_id").alias(ROW), "component_id"), "pipeline-components")
        members = rows.select(ROW, F.col("doc_id").isNull().alias("none"), "doc_id").join(found, ROW)
        first = members.groupBy("component_id").agg(F.min(F.struct("none", "doc_id", ROW)).alias("first"))
        return found.select(ROW).join(first.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_anti")

    # only row numbers are joined by shuffle; texts are not moved while the numbers that go are few enough to broadcast
    gone = _decided(spark, "copies", copies)
    return rows.join(jaccard.small(gone, gone.count()), ROW, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    _workers(spark)
    rows = _numbered(docs, "decontamination")
    items = queries.table(spark, sf_dir, "benchmark")
    gone = _decided(spark, "contaminated", lambda: decontam.contaminated(_as_documents(rows), items).select(F.col("doc_id").alias(ROW)).distinct())
    return rows.join(jaccard.small(gone, gone.count()), ROW, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    _workers(spark)
    rows = _numbered(docs, "mixing")
    taken = _decided(spark, "mix", lambda: queries.mixed(rows, (ROW,)).where("copies > 0").select(ROW, F.col("copies").alias("_copies")))
    taken = rows.join(jaccard.small(taken, taken.count()), ROW)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Coded token-id files of the mix, read back: one row per document."""
    _workers(spark)
    path = scratch_path(spark, "token-ids")
    with work_tables(spark):  # the uncoded ids
        huffman.write_documents(docs, queries.vocabulary(), path)
    return huffman.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: Classifier, WAND search and token coding are not SQL; tests/llm holds near duplicates and decontamination against brute force,
#: mixing and token ids for their ids and row count; run() as a whole is in no test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage staged, and its input, go once its result is written."""
    docs, before = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with work_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
