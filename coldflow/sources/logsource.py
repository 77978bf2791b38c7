"""Sources: log streams (S1, S2), text reads (S10, S11), exported collections.

A log source is any DataFrame (batch or streaming) with the columns of a
queue record: ``value`` (the untouched bytes), ``partition``, ``offset`` and
``timestamp``.  The Kafka source has exactly these; tests use a file stream
of parquet records with the same schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldflow.functions.timefmt import request_id

RECORD_SCHEMA = "value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ"


def kafka_log_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """Consumer-group read of a topic from the latest offset (needs the Kafka connector jar).

    Returns (value BINARY, partition, offset, timestamp).  The payload stays as it
    is; the parser rejects bytes that are no text.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.select(
        "value",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


def file_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A file stream of parquet records with the queue-record schema (tests, replays)."""
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def raw_messages(records: DataFrame) -> DataFrame:
    """S2 + P6: payload untouched (BINARY) plus its request id (ingest epoch ms as text)."""
    return records.select(F.col("value").cast("binary").alias("bytes"), request_id(F.col("timestamp")).alias("request_id"), "partition", "offset")


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Every file as one row (path, value)."""
    return spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())


def collection_scan(spark: SparkSession, path: str, fmt: str = "json", schema: str | None = None) -> DataFrame:
    """Full scan of an exported document collection (no predicate, no projection).

    With ``schema`` the files are read once; without it a JSON collection is
    read another time before, to find its fields.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)
