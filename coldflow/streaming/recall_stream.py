"""T-1: the live recall job as one Structured Streaming query.

``log records -> decode -> parse (P1-P5) -> waterfall (J2-J4) -> capped merge (A2)
-> per-user sorted-set replace (K1)`` with write metrics (K9), misses (K10) and
rejects (P1-P3) beside it.

Decoding and parsing are stream-native; everything after them runs in
``foreachBatch`` because per-event top-k windows are not allowed on streaming
frames.  The catalogue may be a posting store: every micro-batch then picks its
newest version, so items added or removed while the job runs count from the
next batch on.

Each output is a ``BatchTable``: a micro-batch writes its rows to
``<table>/batch_id=<n>`` with a plain overwrite, so a retried batch replaces
itself (idempotent), readers take only batches with Spark's ``_SUCCESS`` mark, and
the checkpoint makes the whole query resume where it stopped: effectively once
(the reference loses in-flight records on a crash).

The sorted-set table is an append log of full per-user lists with a
``version`` = (record timestamp, partition, offset, part); the read view keeps
each key's newest version.  A user with no hits in an event keeps the previous list.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldflow.functions.timefmt import EPOCH, epoch_millis, request_id
from coldflow.operators import keyed, parse, recall
from coldflow.operators.batches import BatchTable
from coldflow.operators.posting_store import CatalogueStore
from coldflow.session import path_exists, remove_path

Decode = Callable[[DataFrame], DataFrame]


@dataclass
class ZsetTable:
    """Versioned sorted-set table on shared storage.

    Layout: ``batches/batch_id=<n>`` (one overwrite per micro-batch),
    ``base-<id>`` (a compacted view with versions) and ``_pointer`` (which
    base covers batches up to which id).  Readers take the base plus newer
    batches; a reader that finds no pointer reads every batch - slower, never
    wrong - so the pointer need not be switched atomically as long as old
    batches are kept until a retention job removes them.
    """

    path: str

    @property
    def batches(self) -> str:
        return f"{self.path}/batches"

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        BatchTable(self.batches).write(rows, batch_id)

    def _pointer(self, spark: SparkSession):
        if not path_exists(spark, f"{self.path}/_pointer/_SUCCESS"):
            return None  # no compaction yet, or one that is just being published
        r = spark.read.schema("base string, upto long").json(f"{self.path}/_pointer").collect()
        return r[0] if r else None

    def log(self, spark: SparkSession) -> DataFrame:
        """Current rows with versions: base (if any) plus the finished batches after it."""
        ptr = self._pointer(spark)
        newer = BatchTable(self.batches).read(spark, -1 if ptr is None else int(ptr["upto"]))
        if ptr is None and newer is None:
            raise ValueError(f"no finished batch in {self.batches}")
        parts = [] if ptr is None else [spark.read.parquet(ptr["base"])]
        parts += [] if newer is None else [newer.drop("batch_id")]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def view(self, spark: SparkSession, now: Column | None = None) -> DataFrame:
        """(key, member, score) of each key's newest replace; with ``now``, of keys alive at that time (K5)."""
        rows = keyed.newest_write(self.log(spark), ["key"])
        if now is not None and "expires_at" in rows.columns:
            rows = rows.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
        return rows.select("key", "member", "score")

    def compact(self, spark: SparkSession) -> str:
        """Write the newest list of every key as a new base and point readers at it."""
        import uuid

        ptr = self._pointer(spark)
        done = BatchTable(self.batches).finished(spark, -1 if ptr is None else int(ptr["upto"]))
        if not done:
            return "" if ptr is None else ptr["base"]
        base = f"{self.path}/base-{uuid.uuid4().hex[:12]}"
        keyed.newest_write(self.log(spark), ["key"]).write.mode("overwrite").parquet(base)
        spark.createDataFrame([(base, done[-1])], "base string, upto long").coalesce(1).write.mode("overwrite").json(
            f"{self.path}/_pointer"
        )
        return base


materialize_catalogue = recall.materialize_catalogue


def parse_records(records: DataFrame, decode: Decode | None = None) -> DataFrame:
    """Decode, P1 and P2 on a record frame (batch or streaming): (event_id, timestamp, uid, audios, reason).

    ``decode`` turns a record frame (value BINARY, partition, offset, timestamp) into
    log lines (value, part, partition, offset, timestamp), as many rows of a message
    as it likes; ``part`` is the line's place in its message.  Without it a message is one
    line.  ``event_id`` is the line's position (timestamp, partition, offset,
    part), which also orders versions of the per-user lists.
    """
    lines = decode(records) if decode else records.withColumn("part", F.lit(0))
    ev = lines.select(F.struct("timestamp", "partition", "offset", F.col("part").cast("int").alias("part")).alias("event_id"), "value", "timestamp")
    return parse.parse_log(ev, carry=["event_id", "timestamp"])


def decode_lines(records: DataFrame, separator: str = "\n") -> DataFrame:
    """A decode step for messages of several log lines: one row for each non-empty line."""
    lines = F.filter(F.split(F.col("value").cast("string"), separator, -1), lambda x: x != "")
    return records.select("partition", "offset", "timestamp", F.posexplode(lines).alias("part", "value"))


@dataclass
class BatchOutput:
    """What one micro-batch of parsed records gives."""

    zset: DataFrame  # (key, member, score, version)
    metrics: DataFrame  # (uid, n_items, request_id, request_ms)
    misses: DataFrame  # (event_id, pos, kind, text)
    rejects: DataFrame  # (event_id, reason)


def batch_rows(
    parsed: DataFrame, cat: recall.Catalogue, cap: int = recall.RECALL_CAP, mode: str = "faithful", stage=None
) -> BatchOutput:
    """Recall rows, metrics, misses and rejects of one micro-batch of parsed records.

    ``stage(df, name)`` materializes tables read by several branches (parsed
    records, songs, hit tables) as written tables of this batch id, so a
    retried batch overwrites its own files.
    """
    stage = stage or (lambda df, name: df)
    recs = stage(parsed, "records")
    ok, incomplete = parse.split(recs)
    good, bad = parse.split(parse.parse_songs(ok, keep=["event_id", "timestamp", "uid", "audios"]))
    songs = stage(parse.with_singers(parse.song_rows(good, keep=("event_id", "uid")), mode), "songs")
    wf = recall.waterfall(songs, cat, stage=stage)
    merged = stage(recall.merge_recalls(wf, songs, cap), "merged")
    per_event = merged.groupBy("event_id", "uid").agg(F.count(F.lit(1)).alias("n_items"))
    metrics = per_event.join(ok.select("event_id", "timestamp"), "event_id").select(
        "uid", "n_items", request_id(F.col("timestamp")).alias("request_id"), epoch_millis(F.col("timestamp")).alias("request_ms")
    )
    rejects = incomplete.select("event_id", "reason").unionByName(bad.select("event_id", "reason"))
    return BatchOutput(recall.zset_rows(merged), metrics, wf.misses, rejects)


def run_recall_stream(
    spark: SparkSession,
    records: DataFrame,
    cat: recall.Catalogue | CatalogueStore,
    table_path: str,
    checkpoint_path: str,
    metrics_path: str | None = None,
    cap: int = recall.RECALL_CAP,
    available_now: bool = True,
    processing_time: str | None = None,
    misses_path: str | None = None,
    rejects_path: str | None = None,
    ttl_seconds: int = -1,
    decode: Decode | None = None,
):
    """Start the streaming query; returns the StreamingQuery (awaited when ``available_now``).

    ``cat`` is a fixed catalogue or a posting store, whose newest version each batch
    picks.  Lists expire ``ttl_seconds`` after they were written if that is positive.
    """
    table = ZsetTable(table_path)
    work = f"{checkpoint_path.rstrip('/')}-work"

    def process(batch: DataFrame, batch_id: int) -> None:
        own = f"{work}/batch_id={batch_id}"
        session = batch.sparkSession

        def stage(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{own}/{name}")
            return session.read.parquet(f"{own}/{name}")

        now = recall.open_catalogue(session, cat) if isinstance(cat, CatalogueStore) else cat
        out = batch_rows(batch, now, cap, stage=stage)
        sink_ms = int(time.time() * 1000)  # the sink clock, not current_timestamp() (constant per batch)
        zset = out.zset
        if ttl_seconds > 0:
            zset = zset.withColumn("expires_at", F.timestamp_add("SECOND", F.lit(sink_ms // 1000 + ttl_seconds), F.expr(EPOCH)))
        if misses_path:
            BatchTable(misses_path).write(out.misses, batch_id)
        if rejects_path:
            BatchTable(rejects_path).write(out.rejects, batch_id)
        if metrics_path:
            latency = (F.lit(sink_ms) - F.col("request_ms")).alias("latency_ms")
            BatchTable(metrics_path).write(out.metrics.select("uid", "n_items", "request_id", latency), batch_id)
        table.write_batch(zset, batch_id)  # last: a list that can be seen has its other outputs
        remove_path(session, own)

    # Decode and parse are stream-native; per-event top-k windows are not allowed on
    # streaming frames, so matching and merging run per micro-batch.
    writer = parse_records(records, decode).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 second").start()
