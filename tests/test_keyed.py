"""Keyed-table cases of FIXTURES.md 1.4."""

import datetime as dt

from pyspark.sql import functions as F

from coldflow.operators import keyed
from coldflow.sources.fixtures import ntz
from tests.conftest import rows


def test_sorted_set_replace_append_replace(spark):
    schema = "key string, member string, score double, op string, version long"
    ops = [("k", "a", 1.0, "replace", 1), ("k", "b", 2.0, "replace", 1)]
    df = spark.createDataFrame(ops, schema)
    assert rows(keyed.zset_view(df), "member") == [("a",), ("b",)]
    ops.append(("k", "c", 3.0, "put", 2))
    assert rows(keyed.zset_view(spark.createDataFrame(ops, schema)), "member") == [("a",), ("b",), ("c",)]
    ops.append(("k", "d", 4.0, "replace", 3))
    assert rows(keyed.zset_view(spark.createDataFrame(ops, schema)), "member") == [("d",)]
    ops.append(("k", None, None, "delete", 4))
    assert keyed.zset_view(spark.createDataFrame(ops, schema)).count() == 0


def test_kv_ttl(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", "x", 60, t0, 1), ("b", "y", 60, t0, 1), ("b", "z", 0, t0, 2), ("c", "w", 10, t0, 1)],
        "key string, value string, ttl int, write_ts timestamp_ntz, version long",
    )
    out = keyed.kv_view(df, ntz(dt.datetime(2024, 1, 1, 0, 0, 30)))
    assert rows(out, "key", "value") == [("a", "x"), ("b", "z")]


def test_cell_key_split(spark):
    df = spark.createDataFrame([("r", "cf:q:z", "1", 1), ("r", "cf", "2", 1)], "row_key string, column string, value string, version long")
    latest, bad = keyed.cells_latest(df)
    assert rows(latest, "family", "qualifier") == [("cf", "q")]
    assert bad.count() == 1


def test_prefix_read(spark):
    cells = spark.createDataFrame(
        [("u~a~1", "3"), ("u~b~2", "9"), ("u~~x~3", "7"), ("u~娱~4", "8"), ("v~a~5", "1")], "row_key string, value string"
    ).select("row_key", F.lit("cf").alias("family"), F.lit("s").alias("qualifier"), "value", F.lit(1).alias("version"))

    def run(limit):
        req = spark.createDataFrame([("u", "cf", "s", limit)], "uid string, family string, qualifier string, limit int")
        out, _ = keyed.prefix_newest(req, cells)
        return sorted(r["row_key"] for r in out.collect())

    assert run(1) == ["u~b~2"]
    assert run(0) == []
    assert run(-1) == ["u~a~1", "u~b~2"]


def test_prefix_requests_get_rows_of_their_own(spark):
    cells = spark.createDataFrame([("u~a~1", "3"), ("u~b~2", "9"), ("u~c~3", "7")], "row_key string, value string").select(
        "row_key", F.lit("cf").alias("family"), F.lit("s").alias("qualifier"), "value", F.lit(1).alias("version")
    )
    req = spark.createDataFrame([("u", "cf", "s", n) for n in (1, 2)], "uid string, family string, qualifier string, limit int")
    out, _ = keyed.prefix_newest(req, cells)
    assert sorted((r["limit"], r["row_key"]) for r in out.collect()) == [(1, "u~b~2"), (2, "u~b~2"), (2, "u~c~3")]


def test_hash_replace_with_ttl(spark):
    t0 = dt.datetime(2024, 1, 1)
    writes = spark.createDataFrame(
        [
            ("h1", "a", "1", 1, 60, t0),
            ("h1", "b", "2", 2, 0, t0),  # newest write of h1: no TTL, replaces {a}
            ("h2", "c", "3", 1, 0, t0),
            ("h2", "d", "4", 2, 10, t0),  # newest write of h2 expires after 10 s
        ],
        "key string, field string, value string, version long, ttl int, write_ts timestamp_ntz",
    )
    out = keyed.hash_view(writes, ntz(dt.datetime(2024, 1, 1, 0, 0, 30)))
    assert rows(out, "key", "field", "value") == [("h1", "b", "2")]
    assert rows(keyed.hash_view(writes), "key", "field") == [("h1", "b"), ("h2", "d")]
