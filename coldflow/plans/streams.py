"""Registered streaming query: the recall job as a stream.

The log fixture is written as parquet queue records (one file per quarter of
the events, or as many as hold ``FILE_RECORDS`` each; offset = event id), replayed through a file stream two quarters per
trigger (two micro-batches), and the resulting sorted-set table is read back.  Its view must
equal the batch ``recall_zset``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coldflow.operators import recall
from coldflow.operators.batches import BatchTable
from coldflow.session import files_version, scratch_path, stage_table
from coldflow.sources import fixtures
from coldflow.sources.logsource import file_log_stream
from coldflow.sources.tables import Tables
from coldflow.streaming.recall_stream import ZsetTable, run_recall_stream

STREAM_FILES = 4
FILE_RECORDS = 100_000


def files_of(records: int) -> int:
    """How many files hold so many records: a micro-batch is read with one task a file at most."""
    return max(1, -(-records // FILE_RECORDS))


def write_log_records(spark, sf_dir: str, path: str, files: int = STREAM_FILES) -> None:
    log = fixtures.log(Tables(spark, sf_dir))
    rec = log.select(
        F.col("value").cast("binary").alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp")
    )
    rec.repartitionByRange(files, "offset").sortWithinPartitions("offset").write.mode("overwrite").parquet(path)


_REPLAYS: dict[tuple, str] = {}


def _replay(spark, sf_dir: str, files: int = STREAM_FILES, files_per_trigger: int = 2) -> str:
    """The folder of a finished replay (zset, metrics, misses and rejects under it).

    The four are outputs of one job, so it runs once per application and state of the input files.
    """
    t = Tables(spark, sf_dir)
    key = (spark.sparkContext.applicationId, files_version(t.events), files_version(t.part), files, files_per_trigger)
    if key not in _REPLAYS:
        base = scratch_path(spark, "recall-stream")
        split = files_of(-(-t.events.count() // files))
        write_log_records(spark, sf_dir, f"{base}/in", files * split)
        store = recall.catalogue_store(fixtures.ring(t), t.part, lambda n: scratch_path(spark, n))
        outputs = {f"{n}_path": f"{base}/{n}" for n in ("metrics", "misses", "rejects")}
        run_recall_stream(spark, file_log_stream(spark, f"{base}/in", files_per_trigger * split), store, f"{base}/zset", f"{base}/checkpoint", **outputs)
        _REPLAYS[key] = base
    return _REPLAYS[key]


def q_stream_recall_zset(spark, sf_dir, files: int = STREAM_FILES, files_per_trigger: int = 2):
    return ZsetTable(f"{_replay(spark, sf_dir, files, files_per_trigger)}/zset").view(spark)


def q_stream_misses(spark, sf_dir):
    """K10 of the live job: every name and singer miss of its finished batches."""
    rows = BatchTable(f"{_replay(spark, sf_dir)}/misses").read(spark)
    return rows.select(F.col("event_id.offset").alias("event_id"), "pos", "kind", "text")


def q_stream_rejects(spark, sf_dir):
    """P1-P3 of the live job: every rejected record of its finished batches."""
    rows = BatchTable(f"{_replay(spark, sf_dir)}/rejects").read(spark)
    return rows.select(F.col("event_id.offset").alias("event_id"), "reason")


def q_stream_catalogue_refresh(spark, sf_dir):
    """T-1: the catalogue changes between two runs of the job; later batches match the new version.

    The first half of the records is matched against the base catalogue, the second
    against the changed one.
    """
    base = scratch_path(spark, "refresh-stream")
    t = Tables(spark, sf_dir)
    store = recall.build_store(fixtures.ring_base(t), f"{base}/index")
    log = fixtures.log(t).select("value", F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    log = stage_table(log.withColumn("value", F.col("value").cast("binary")), "refresh-log")
    half = fixtures.half_of_events(t)
    for part, rows in enumerate((log.where(F.col("offset") < half), log.where(F.col("offset") >= half))):
        if part:
            recall.change_store(store, fixtures.ring_changes(t))
        files = files_of(rows.count())
        rows.repartition(files).write.mode("append").parquet(f"{base}/in")
        run_recall_stream(spark, file_log_stream(spark, f"{base}/in", max(8, files)), store, f"{base}/zset", f"{base}/checkpoint")
    return ZsetTable(f"{base}/zset").view(spark)


QUERIES = {
    "stream_recall_zset": q_stream_recall_zset,
    "stream_misses": q_stream_misses,
    "stream_rejects": q_stream_rejects,
    "stream_catalogue_refresh": q_stream_catalogue_refresh,
}
