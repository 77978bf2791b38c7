"""Message-table jobs: position reads (S3, S4), tag subscription (S6),
redelivery with a dead-letter table (T-5) and duplicate suppression (T-6).

A message table has the columns of a queue record: (msg_id, topic, tag,
body, store_ts, partition, offset).  The same functions serve the Kafka
source's batch form (``spark.read.format("kafka")``) after renaming.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def offset_range(msgs: DataFrame, starting: Mapping[int, int] | int, ending: Mapping[int, int] | int | None = None) -> DataFrame:
    """S3 + S4: rows with starting <= offset < ending per partition; NULL payloads are skipped.

    ``starting``/``ending`` are one offset for all partitions or a
    {partition: offset} map (missing partition: from 0 / to the end).
    -2 = earliest, -1 = latest, as in the Kafka source options.
    """
    def bound(spec, default):
        if isinstance(spec, Mapping):
            expr = F.lit(default)
            for p, o in spec.items():
                expr = F.when(F.col("partition") == F.lit(p), F.lit(o)).otherwise(expr)
            return expr
        return F.lit(default if spec is None else spec)

    lo = bound(starting, 0)
    out = msgs
    if _uses_latest(starting):
        # One row per source partition: bounded by the partition count.
        ends = msgs.groupBy("partition").agg((F.max("offset") + 1).alias("_end"))
        out = out.join(F.broadcast(ends), "partition")
        lo = F.when(lo == -1, F.col("_end")).otherwise(lo)
    lo = F.when(lo == -2, F.lit(0)).otherwise(lo)
    cond = (F.col("offset") >= lo) & F.col("body").isNotNull()
    if ending is not None:
        hi = bound(ending, None)
        cond = cond & (hi.isNull() | (hi == -1) | (F.col("offset") < hi))
    out = out.where(cond)
    return out.drop("_end") if "_end" in out.columns else out


def _uses_latest(spec) -> bool:
    if isinstance(spec, Mapping):
        return any(v == -1 for v in spec.values())
    return spec == -1


def offset_before(msgs: DataFrame, ts: Column) -> DataFrame:
    """S3 by time: per partition the last offset stored before ``ts``, -1 if none."""
    parts = msgs.select("partition").distinct()
    before = msgs.where(F.col("store_ts") < ts).groupBy("partition").agg(F.max("offset").alias("offset"))
    return parts.join(before, "partition", "left").select("partition", F.coalesce("offset", F.lit(-1)).cast("bigint").alias("offset"))


def parse_tag_expression(expr: str) -> list[str] | None:
    """``*`` -> None (all tags); ``A || B`` -> ["A", "B"]."""
    expr = (expr or "").strip()
    if expr in ("", "*"):
        return None
    return [t.strip() for t in expr.split("||") if t.strip()]


def subscribe(msgs: DataFrame, topic: str, tag_expression: str = "*") -> DataFrame:
    """Messages of ``topic`` whose tag matches the subscription expression."""
    tags = parse_tag_expression(tag_expression)
    out = msgs.where(F.col("topic") == F.lit(topic))
    if tags is not None:
        out = out.where(F.col("tag").isin(tags))
    return out


def latest_per_id(msgs: DataFrame) -> DataFrame:
    """T-6 batch form: one row per msg_id, the newest delivery (store_ts, partition, offset).

    ``max_by`` over a struct is a partial aggregate: a message id delivered
    a million times is combined map-side, never gathered into one task.
    """
    cols = [c for c in msgs.columns if c != "msg_id"]
    order = F.struct("store_ts", "partition", "offset")
    best = msgs.groupBy("msg_id").agg(F.max_by(F.struct(*cols), order).alias("m"))
    return best.select("msg_id", *[F.col(f"m.{c}").alias(c) for c in cols])


def dedup_stream(stream: DataFrame, watermark: str = "10 minutes", time_col: str = "store_ts") -> DataFrame:
    """T-6 stream form: drop repeated msg_ids arriving within the watermark delay.

    Watermarks need a TIMESTAMP (not NTZ) event time; an NTZ column is
    converted in an extra column that is dropped again.
    """
    if stream.schema[time_col].dataType.simpleString() == "timestamp_ntz":
        s = stream.withColumn("_event_ts", F.col(time_col).cast("timestamp"))
        return s.withWatermark("_event_ts", watermark).dropDuplicatesWithinWatermark(["msg_id"]).drop("_event_ts")
    return stream.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["msg_id"])


def redeliver(msgs: DataFrame, failed: DataFrame, max_attempts: int = 1) -> tuple[DataFrame, DataFrame]:
    """T-5: re-emit failed messages up to ``max_attempts`` times; the rest go to a dead-letter table.

    ``failed(msg_id, attempt)`` records failures (attempt = number of
    deliveries so far that failed, 1 for the first).  Returns
    (redeliveries with ``attempt`` + 1, dead letters).
    """
    worst = failed.groupBy("msg_id").agg(F.max("attempt").alias("attempt"))
    firsts = latest_per_id(msgs)
    j = firsts.join(worst, "msg_id")
    retry = j.where(F.col("attempt") <= F.lit(max_attempts)).withColumn("attempt", F.col("attempt") + 1)
    dead = j.where(F.col("attempt") > F.lit(max_attempts))
    return retry, dead
