"""Run the live recall job (T-1).

    python -m coldflow.streaming.run --catalogue /data/ring --table /data/zset \\
        --checkpoint /data/ckpt --kafka-servers host:9092 --topic logs [--metrics /data/metrics]

The catalogue is a parquet table ``(item_id, name, singer, fire)``.  Its posting store is
written to ``--index`` (next to the checkpoint by default) unless one is there; every
micro-batch reads the store's newest version.  ``--changes TABLE`` adds the next
version from ``(item_id, name, singer, fire, deleted)`` and ends; a job that
runs meanwhile takes it up with its next batch.  ``--misses`` and ``--rejects`` are written per batch.  ``--files DIR`` replays parquet
queue records ``(value, partition, offset, timestamp)`` instead of Kafka, and
``--once`` processes what is there and stops (``availableNow``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from coldflow.operators import recall
from coldflow.operators.posting_store import CatalogueStore
from coldflow.sources.logsource import file_log_stream, kafka_log_stream
from coldflow.streaming.recall_stream import decode_lines, run_recall_stream


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--catalogue")
    ap.add_argument("--index")
    ap.add_argument("--changes")
    ap.add_argument("--table")
    ap.add_argument("--checkpoint")
    ap.add_argument("--metrics")
    ap.add_argument("--misses")
    ap.add_argument("--rejects")
    ap.add_argument("--ttl", type=int, default=-1)
    ap.add_argument("--lines", action="store_true", help="a message holds several log lines")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic")
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--files")
    ap.add_argument("--files-per-trigger", type=int, default=1)
    ap.add_argument("--cap", type=int, default=recall.RECALL_CAP)
    ap.add_argument("--trigger", default="1 second")
    ap.add_argument("--once", action="store_true")
    a = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("coldflow-recall").getOrCreate()
    if a.changes:
        if not a.index:
            ap.error("--changes needs --index")
        return recall.change_store(CatalogueStore(a.index), spark.read.parquet(a.changes))
    if not (a.table and a.checkpoint):
        ap.error("give --table and --checkpoint")
    if a.files:
        records = file_log_stream(spark, a.files, a.files_per_trigger)
    elif a.kafka_servers and a.topic:
        records = kafka_log_stream(spark, a.kafka_servers, a.topic, a.starting_offsets)
    else:
        ap.error("give --files or --kafka-servers with --topic")
    store = CatalogueStore(a.index or f"{a.checkpoint.rstrip('/')}-index")
    if not store.versions(spark):
        if not a.catalogue:
            ap.error("give --catalogue or an --index that holds one")
        recall.build_store(spark.read.parquet(a.catalogue), store.path)
    q = run_recall_stream(
        spark, records, store, a.table, a.checkpoint, a.metrics, cap=a.cap, available_now=a.once, processing_time=a.trigger,
        misses_path=a.misses, rejects_path=a.rejects, ttl_seconds=a.ttl, decode=decode_lines if a.lines else None,
    )
    if not a.once:
        q.awaitTermination()
    return q


if __name__ == "__main__":
    main()
