"""Keyed logs, batch tables and expiring sorted sets."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from coldflow.operators import keyed
from coldflow.operators.batches import BatchTable, KeyedLog, cell_lookup, row_lookup
from coldflow.session import path_exists, remove_path, scratch_path
from coldflow.sources.fixtures import ntz
from coldflow.streaming import zset_state
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
ZSET = "key string, member string, score double, op string, ttl int, write_ts timestamp_ntz, version long"


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def model(ops, now=None):
    """A sorted-set store in plain Python: writes in (time, version) order."""
    sets, expiry = {}, {}
    writes = {}
    for key, member, score, op, ttl, ts, version in ops:
        writes.setdefault((ts, version, key, op, ttl), []).append((member, score))
    for (ts, _, key, op, ttl), members in sorted(writes.items(), key=lambda x: x[0][:2]):
        if key in expiry and expiry[key] <= ts:
            sets.pop(key, None), expiry.pop(key)
        if op in ("replace", "delete"):
            sets.pop(key, None), expiry.pop(key, None)
        if op != "delete":
            sets.setdefault(key, {}).update({m: s for m, s in members if m is not None})
        if ttl is not None and ttl > 0:
            expiry[key] = ts + dt.timedelta(seconds=ttl)
    return sorted((k, m, s) for k, v in sets.items() for m, s in v.items() if now is None or k not in expiry or expiry[k] > now)


def random_ops(seed, n, keys):
    rnd, out = random.Random(seed), []
    for version in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        op = rnd.choices(["put", "replace", "delete"], [12, 1, 1])[0]
        ttl = rnd.choice([None, -1, 0, 0, 5, 40, 200])
        members = [None] if op == "delete" else rnd.sample("abcdefgh", 2 if op == "replace" else 1)
        out += [(key, m, None if m is None else float(version), op, ttl if op != "delete" else 0, _at(version * 7 + rnd.randrange(3)), version) for m in members]
    return out


@pytest.mark.parametrize("chunks", [1, 9])
def test_expiring_sets_equal_a_store(spark, chunks):
    ops = random_ops(chunks, 400, 4)
    df = spark.createDataFrame(ops, ZSET).repartition(4)
    for now in (None, _at(2805), _at(2900), _at(9999)):
        got = keyed.zset_ttl_view(df, None if now is None else ntz(now.replace(microsecond=0)), chunks)
        assert rows(got, "key", "member", "score") == model(ops, now)


def test_an_append_after_expiry_starts_anew(spark):
    put = lambda m, ttl, at: ("k", m, 1.0, "put", ttl, _at(at), at)
    cases = {
        "abc": [put("a", 60, 0), put("b", 0, 30), put("c", -1, 50)],  # ttl <= 0 keeps the expiry
        "c": [put("a", 60, 0), put("b", 0, 30), put("c", 0, 60)],  # expired at 60: a new life without expiry
        "bc": [put("a", 60, 0), put("b", 60, 61), put("c", 0, 62)],
        "": [put("a", 60, 0), put("b", 10, 1)],
    }
    for want, ops in cases.items():
        got = keyed.zset_ttl_view(spark.createDataFrame(ops, ZSET), ntz(_at(59 if want == "abc" else 100)), 2)
        assert "".join(r[0] for r in rows(got, "member")) == want
        assert rows(keyed.zset_ttl_view(spark.createDataFrame(ops, ZSET), ntz(_at(59 if want == "abc" else 100)), 1), "member") == rows(got, "member")
    assert keyed.zset_ttl_view(spark.createDataFrame([], ZSET), ntz(T0)).count() == 0


def test_stream_state_equals_the_view(spark):
    """The stream keeps the same sets; a timer empties a key that nothing writes any more."""
    ops = random_ops(3, 150, 3) + [("gone", "x", 1.0, "put", 10, _at(5), 1000), ("end", "z", 1.0, "put", 0, _at(5000), 2000)]
    base = scratch_path(spark, "zset-stream")
    df = spark.createDataFrame(ops, ZSET).withColumn("write_ts", F.col("write_ts").cast("timestamp"))
    for n, (low, high) in enumerate(((0, 500), (500, 2000), (2000, 10_000))):
        part = df.where((F.col("write_ts") >= F.lit(_at(low))) & (F.col("write_ts") < F.lit(_at(high))))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
        q = zset_state.expiring_sets(stream).writeStream.format("parquet").option("path", f"{base}/out")
        q.option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.parquet(f"{base}/out")
    assert rows(zset_state.current_members(changes), "key", "member", "score") == model(ops, _at(5000))
    assert changes.where("key = 'gone' AND score IS NULL").count() == 1


def test_writes_of_every_kind_are_read_back(spark):
    hashes = KeyedLog(scratch_path(spark, "hash"), "hash", 4)
    schema = "key string, field string, value string, ttl int, write_ts timestamp_ntz, version long"
    hashes.write(spark.createDataFrame([("h", "a", "1", 0, T0, 1), ("h", "b", "2", 0, T0, 1), ("i", "x", "9", 5, T0, 1), (None, "q", "0", 0, T0, 1)], schema), 0)
    hashes.write(spark.createDataFrame([("h", "c", "3", 0, T0, 2)], schema), 1)
    assert rows(hashes.view(spark, ntz(_at(3))), "key", "field", "value") == [("h", "c", "3"), ("i", "x", "9")]
    assert rows(hashes.view(spark, ntz(_at(6))), "key", "field") == [("h", "c")]
    strings = KeyedLog(scratch_path(spark, "kv"), "kv", 4)
    assert strings.view(spark, ntz(T0)).count() == 0
    strings.write(spark.createDataFrame([("s", "v", 60, T0, 1), ("s", "w", 0, T0, 2)], "key string, value string, ttl int, write_ts timestamp_ntz, version long"), 0)
    assert rows(strings.view(spark, ntz(_at(100))), "key", "value") == [("s", "w")]
    sets = KeyedLog(scratch_path(spark, "zset"), "zset", 4)
    sets.write(spark.createDataFrame([("k", "a", 1.0, "put", 10, T0, 1)], ZSET), 0)
    sets.write(spark.createDataFrame([("k", "b", 2.0, "put", 0, _at(20), 2)], ZSET), 1)
    assert rows(sets.view(spark, ntz(_at(30))), "member") == [("b",)]


def _cells(spark):
    log = KeyedLog(scratch_path(spark, "cells"), "cells", 16)
    cells = spark.range(400).select(
        F.concat(F.lit("r"), F.col("id") % 100).alias("row_key"), F.lit("cf").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").cast("string").alias("value"), F.col("id").alias("version"),
    )
    log.write(cells.where("version < 200"), 0)
    log.write(cells.where("version >= 200"), 1, files=3)
    return log


def test_lookups_read_only_the_buckets_of_their_keys(spark):
    log = _cells(spark)
    req = spark.createDataFrame([(1, "r7", "cf", "q"), (2, "nope", "cf", "q"), (3, None, "cf", "q")], "request_id long, row_key string, family string, qualifier string")
    assert rows(cell_lookup(req, log), "request_id", "value") == [(1, "307"), (2, None), (3, None)]
    assert rows(row_lookup(req, log), "request_id", "qualifier", "value") == [(1, "q", "307"), (2, None, None), (3, None, None)]
    plan = row_lookup(req, log)._jdf.queryExecution().executedPlan().toString()
    wanted = {r[0] for r in req.where("row_key IS NOT NULL").select(F.pmod(F.xxhash64("row_key"), F.lit(16))).collect()}
    pruned = re.search(r"PartitionFilters: \[bucket#\d+ (?:IN|=) ([^\]]*)\]", plan)[1]
    assert {int(x) for x in re.findall(r"\b\d+\b", pruned.split("bucket#")[0])} == wanted
    assert plan.index("max_by") < plan.index("LeftSemi")  # the aggregate stands above the semi-join


def test_a_retried_batch_replaces_itself_and_a_killed_one_is_not_seen(spark):
    log = _cells(spark)
    before = rows(log.view(spark))
    again = spark.createDataFrame([("r7", "cf", "q", "new", 999)], "row_key string, family string, qualifier string, value string, version long")
    for _ in range(2):
        log.write(again, 2)
    assert log.rows(spark).where("version = 999").count() == 1
    remove_path(spark, f"{BatchTable(log.path).folder(2)}/_SUCCESS")  # as a writer leaves it that is killed before its commit
    assert rows(log.view(spark)) == before
    assert BatchTable(log.path).finished(spark) == [0, 1] and BatchTable(log.path).finished(spark, 0) == [1]
    assert BatchTable(scratch_path(spark, "none")).read(spark) is None
    assert not path_exists(spark, scratch_path(spark, "none"))
