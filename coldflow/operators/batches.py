"""Tables written batch by batch, and keyed logs laid out by key hash (K2-K6, S12, S13, T-3).

A batch is one folder ``batch_id=<n>``, written with a plain overwrite: a retried
batch replaces itself.  Readers take only batches with Spark's ``_SUCCESS``
mark (which jobs write unless ``mapreduce.fileoutputcommitter.marksuccessfuljobs``
is off), so a batch whose writer was killed is not seen at all.

``KeyedLog`` adds ``bucket=<b>`` folders, b = hash of the key, with rows sorted by
key.  A reader that asks for some keys reads the buckets of these keys
only (a partition filter of at most ``buckets`` numbers) and drops other keys
by a semi-join before any view is computed.  The views are those of
``coldflow.operators.keyed``: the log is what a store's commands wrote, a view is
what a client would read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldflow.operators import keyed
from coldflow.session import path_exists


@dataclass
class BatchTable:
    """Rows of micro-batches, one folder ``batch_id=<n>`` each.

    Batch ids are consecutive, so a reader that needs those after a given one asks for
    n + 1, n + 2, ... until one is not there or not finished; it lists no folder.
    """

    path: str

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.folder(batch_id))

    def finished(self, spark: SparkSession, after: int = -1) -> list[int]:
        """Ids of the finished batches after ``after``."""
        ids = []
        while path_exists(spark, f"{self.folder(after + 1)}/_SUCCESS"):
            after += 1
            ids.append(after)
        return ids

    def read(self, spark: SparkSession, after: int = -1, schema: str | None = None) -> DataFrame | None:
        """Rows of the finished batches after ``after``, with their batch_id; None without any."""
        ids = self.finished(spark, after)
        if not ids:
            return None
        reader = spark.read.option("basePath", self.path)
        if schema:
            reader = reader.schema(f"{schema}, batch_id int")
        return reader.parquet(*[self.folder(n) for n in ids])


LOG_SCHEMAS = {
    "zset": "key string, member string, score double, op string, ttl int, write_ts timestamp_ntz, version bigint",
    "hash": "key string, field string, value string, ttl int, write_ts timestamp_ntz, version bigint",
    "kv": "key string, value string, ttl int, write_ts timestamp_ntz, version bigint",
    "cells": "row_key string, family string, qualifier string, value string, version bigint",
}


FILE_ROWS = 500_000


def files_for(rows: int, buckets: int) -> int:
    """Files of a bucket for so many rows: of FILE_ROWS rows if keys are even, of ``buckets`` times that if one bucket holds all."""
    return max(1, -(-rows // (buckets * FILE_ROWS)))


@dataclass
class KeyedLog:
    """The write log of one kind of keyed table (``zset``, ``hash``, ``kv``, ``cells``)."""

    path: str
    kind: str
    buckets: int = 64

    @property
    def key(self) -> str:
        return LOG_SCHEMAS[self.kind].split(" ", 1)[0]

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in LOG_SCHEMAS[self.kind].split(", ")]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, batch_id: int, files: int | None = None) -> None:
        """One batch of writes.  A bucket becomes ``files`` files, each sorted by one task; None: by the number of rows."""
        if files is None:
            files = files_for(rows.count(), self.buckets)
        types = dict(c.split(" ", 1) for c in LOG_SCHEMAS[self.kind].split(", "))
        typed = rows.where(F.col(self.key).isNotNull()).select(*[F.col(c).cast(types[c]).alias(c) for c in self.columns], self._bucket().alias("bucket"))
        part = F.col("bucket") * files + F.pmod(F.xxhash64("version"), F.lit(files)).cast("int")
        out = typed.repartitionById(self.buckets * files, part).sortWithinPartitions("bucket", self.key, "version")
        out.write.mode("overwrite").partitionBy("bucket").parquet(BatchTable(self.path).folder(batch_id))

    def rows(self, spark: SparkSession, keys: DataFrame | None = None) -> DataFrame:
        """The log of the finished batches; with ``keys`` (a frame with the key column), of these keys."""
        log = BatchTable(self.path).read(spark, schema=f"{LOG_SCHEMAS[self.kind]}, bucket int")
        if log is None:
            return spark.createDataFrame([], LOG_SCHEMAS[self.kind])
        if keys is None:
            return log.select(*self.columns)
        asked = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct().withColumn("bucket", self._bucket())
        wanted = sorted(r[0] for r in asked.select("bucket").distinct().collect())
        log = log.where(F.col("bucket").isin(wanted) if wanted else F.lit(False))
        return log.join(asked, ["bucket", self.key], "left_semi").select(*self.columns)

    def view(self, spark: SparkSession, now: Column | None = None, keys: DataFrame | None = None) -> DataFrame:
        """What a client reads at ``now``: members, fields, values or cells."""
        rows = self.rows(spark, keys)
        if self.kind == "zset":
            return keyed.zset_ttl_view(rows, now)
        if self.kind == "hash":
            return keyed.hash_view(rows, now)
        if self.kind == "kv":
            return keyed.kv_view(rows, now)
        return keyed.newest_cells(rows)


def write_profiles(log: KeyedLog, users: DataFrame, batch_id: int) -> None:
    """P9 -> K3: (key, template, version[, ttl, write_ts]) config writes as their seven hash fields."""
    more = [F.col(c) if c in users.columns else F.lit(None).alias(c) for c in ("ttl", "write_ts")]
    fields = users.select("key", "version", *more, F.explode(keyed.profile_fields(F.col("template"))).alias("f"))
    log.write(fields.select("*", "f.field", "f.value"), batch_id, files_for(users.count() * len(keyed.PROFILE_FIELDS), log.buckets))


def row_lookup(requests: DataFrame, log: KeyedLog) -> DataFrame:
    """S12 over a written log: only the buckets and rows of the requested keys reach the newest-cell aggregate."""
    return keyed.row_lookup(requests, log.view(requests.sparkSession, keys=requests))


def cell_lookup(requests: DataFrame, log: KeyedLog) -> DataFrame:
    """S13 over a written log."""
    return keyed.cell_lookup(requests, log.view(requests.sparkSession, keys=requests))
