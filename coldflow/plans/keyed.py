"""Registered keyed-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from coldflow.operators import keyed
from coldflow.operators.batches import KeyedLog, cell_lookup, row_lookup, write_profiles
from coldflow.session import scratch_path, stage_table
from coldflow.sources import fixtures
from coldflow.sources.tables import Tables

BUCKETS = 8  # of the logs below; a large table takes more


def q_zset_append(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return keyed.zset_view(fixtures.zset_ops(t)).select("key", "member", "score")


def q_zset_ttl(spark, sf_dir):
    """K2 + K5 over a written log: appends before and after expiry, ttl <= 0 keeping it."""
    log = KeyedLog(scratch_path(spark, "zset-log"), "zset", BUCKETS)
    ops = fixtures.zset_ttl_ops(Tables(spark, sf_dir))
    for n in range(2):
        log.write(ops.where(F.col("version") % 2 == n), n)
    return log.view(spark, fixtures.ntz(fixtures.KV_NOW))


def q_hash_log(spark, sf_dir):
    """P9 -> K3 + K5: config writes go into a written hash log and are read back."""
    t = Tables(spark, sf_dir)
    log = KeyedLog(scratch_path(spark, "hash-log"), "hash", BUCKETS)
    write_profiles(log, fixtures.hash_writes(t), 0)
    return log.view(spark).drop("version")


def q_kv_log(spark, sf_dir):
    """K4 + K5 over a written string log."""
    log = KeyedLog(scratch_path(spark, "kv-log"), "kv", BUCKETS)
    log.write(fixtures.kv_ops(Tables(spark, sf_dir)), 0)
    return log.view(spark, fixtures.ntz(fixtures.KV_NOW))


def q_hash_replace(spark, sf_dir):
    t = Tables(spark, sf_dir)
    newest = keyed.newest_row(fixtures.hash_writes(t), ["key"])
    rows = newest.select("key", F.explode(keyed.profile_fields(F.col("template"))).alias("f"))
    return rows.select("key", F.col("f.field").alias("field"), F.col("f.value").alias("value"))


def q_kv_ttl(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return keyed.kv_view(fixtures.kv_ops(t), fixtures.ntz(fixtures.KV_NOW))


def _latest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    latest, _ = keyed.cells_latest(fixtures.cells(t))
    return t, latest


def q_cells_latest(spark, sf_dir):
    _, latest = _latest(spark, sf_dir)
    return latest


def _cell_log(spark, t):
    """K6: cell puts written as a log of two batches; malformed column names stay out."""
    log = KeyedLog(scratch_path(spark, "cell-log"), "cells", BUCKETS)
    family, qualifier, reason = keyed.split_column(F.col("column"))
    puts = fixtures.cells(t).where(reason.isNull()).withColumns({"family": family, "qualifier": qualifier})
    for n in range(2):
        log.write(puts.where(F.col("version") % 2 == n), n)
    return log


def q_row_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return row_lookup(fixtures.cell_requests(t), _cell_log(spark, t))


def q_cell_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cell_lookup(fixtures.cell_requests(t), _cell_log(spark, t))


def q_prefix_newest(spark, sf_dir):
    t, latest = _latest(spark, sf_dir)
    rows, _ = keyed.prefix_newest(fixtures.prefix_requests(t), latest, stage=stage_table)
    return rows


QUERIES = {
    "zset_append": q_zset_append,
    "zset_ttl": q_zset_ttl,
    "hash_log": q_hash_log,
    "kv_log": q_kv_log,
    "hash_replace": q_hash_replace,
    "kv_ttl": q_kv_ttl,
    "cells_latest": q_cells_latest,
    "row_lookup": q_row_lookup,
    "cell_lookup": q_cell_lookup,
    "prefix_newest": q_prefix_newest,
}
