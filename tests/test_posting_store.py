"""The posting store: base + deltas = full rebuild, pruning of buckets and blocks, versions."""

import re

import pytest
from pyspark.sql import functions as F

from coldflow.operators import posting_store
from coldflow.operators.match import build_index, match
from coldflow.operators.posting_store import CatalogueStore
from coldflow.plans.recall import _songs
from coldflow.session import scratch_path
from coldflow.sources import fixtures
from coldflow.sources.tables import Tables
from tests.conftest import SF_MID, SF_SMALL, rows

SCHEMA = "item_id string, name string, singer string, fire int"
BUCKETS = 5
CHANGE = SCHEMA + ", deleted boolean"


def _store(spark, docs=None):
    store = CatalogueStore(scratch_path(spark, "store"), buckets=BUCKETS)
    if docs is not None:
        store.build(docs)
    return store


def _texts(spark, docs):
    q = docs.select(F.col("name").alias("q")).unionByName(docs.select(F.col("singer").alias("q")))
    return q.unionByName(spark.createDataFrame([("ring",), ("small ring gear",), ("",), (None,), ("zzz",)], "q string"))


def test_store_matches_like_the_index_table(spark):
    ring = fixtures.ring(Tables(spark, SF_MID))
    snap = _store(spark, ring).snapshot(spark)
    songs = _songs(spark, SF_MID)
    for field, col, k in (("name", "song_name", 1), ("singer", "first_singer", 5)):
        want = rows(match(songs.select(F.col(col).alias("q")), "q", build_index(ring, "item_id", field, payload=["fire"]), k))
        assert rows(match(songs.select(F.col(col).alias("q")), "q", snap.field(field), k)) == want


def test_base_and_deltas_equal_a_rebuild(spark, monkeypatch):
    monkeypatch.setattr(posting_store, "BLOCK_ROWS", 3)
    ring = fixtures.ring(Tables(spark, SF_SMALL)).where("CAST(item_id AS INT) < 120")
    n = F.col("item_id").cast("int")
    store = _store(spark, ring.where(n % 5 != 0))
    added = ring.where(n % 5 == 0).withColumn("deleted", F.lit(False))
    gone = ring.where(n % 7 == 0).withColumn("deleted", F.lit(True))
    again = ring.where(n % 14 == 0).withColumn("name", F.concat(F.col("name"), F.lit(" ring ring"))).withColumn("deleted", F.lit(False))
    for change in (added, gone, again):
        store.apply(change)
    final = ring.where(n % 7 != 0).unionByName(again.drop("deleted"))
    q = _texts(spark, ring)
    want_snap = _store(spark, final).snapshot(spark)
    for version in (None, store.compact(spark)):
        snap = store.snapshot(spark, version)
        assert snap.stats == want_snap.stats
        assert rows(snap.docs().drop("seg"), "item_id", "fire") == rows(final, "item_id", "fire")
        for field, k in (("name", 1), ("singer", 5)):
            want = rows(match(q, "q", build_index(final, "item_id", field, payload=["fire"]), k, prune=False))
            assert rows(match(q, "q", snap.field(field), k)) == want
            assert rows(match(q, "q", snap.field(field), k, prune=False)) == want


def test_a_picked_version_does_not_change(spark):
    base = spark.createDataFrame([("1", "small ring", "A", 1), ("2", "small gear", "B", 2), (None, "ring", "C", 3)], SCHEMA)
    store = _store(spark, base)
    old = store.snapshot(spark)
    store.apply(spark.createDataFrame([("3", "ring", "C", 3, False), ("1", None, None, None, True), ("9", None, None, None, True)], CHANGE))
    q = spark.createDataFrame([("ring",), ("small",)], "q string")
    best = lambda snap: {r["q"]: r["item_id"] for r in match(q, "q", snap.field("name"), 1).collect()}
    assert best(old) == {"ring": "1", "small": "1"}
    assert best(store.snapshot(spark)) == {"ring": "3", "small": "2"}
    assert best(store.snapshot(spark, 0)) == best(old)
    with pytest.raises(ValueError):
        store.snapshot(spark, 7)


def test_a_repeated_id_counts_once_and_empty_changes_are_versions(spark):
    store = _store(spark, spark.createDataFrame([("1", "a b", "S", 1), ("1", "a", "S", 1)], SCHEMA))
    assert store.snapshot(spark).stats["name"] == (1, 2)
    v = store.apply(spark.createDataFrame([], CHANGE))
    assert store.snapshot(spark).version == v == 1 and store.snapshot(spark).stats["name"] == (1, 2)
    store.apply(spark.createDataFrame([("1", None, None, None, True)], CHANGE))
    snap = store.snapshot(spark)
    assert snap.stats["name"] == (0, 0) and match(spark.createDataFrame([("a",)], "q string"), "q", snap.field("name"), 2).count() == 0


def test_only_buckets_of_the_terms_are_read(spark):
    ring = fixtures.ring(Tables(spark, SF_SMALL))
    field = _store(spark, ring).snapshot(spark).field("name")
    q = spark.createDataFrame([("ring",), ("small",)], "q string")
    wanted = {r[0] for r in q.select(F.pmod(F.xxhash64("q"), F.lit(BUCKETS))).collect()}
    _, buckets = field.query_blocks(q, "q")
    assert set(buckets) == wanted and len(wanted) < BUCKETS
    plan = field.match(q, "q", 1)._jdf.queryExecution().executedPlan().toString()
    scans = [m for m in re.findall(r"FileScan parquet.*", plan) if "bucket#" in m and "q#" not in m]
    filters = [re.search(r"PartitionFilters: \[([^\]]*)", s)[1] for s in scans]
    assert scans and all("bucket" in f and all(str(b) in f for b in wanted) for f in filters)
    files = [r[0] for r in field._rows("postings", buckets).select(F.input_file_name()).distinct().collect()]
    assert files and {int(re.search(r"bucket=(\d+)", f)[1]) for f in files} == wanted


def test_blocks_below_the_bound_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(posting_store, "BLOCK_ROWS", 10)
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(str(i), f"common {long} {i}", "s", 1) for i in range(300)] + [("a", "common rare", "s", 1), ("b", "common", "s", 1)]
    field = _store(spark, spark.createDataFrame(docs, SCHEMA)).snapshot(spark).field("name")
    q = spark.createDataFrame([("common rare",)], "q string")
    blocks, buckets = field.query_blocks(q, "q")
    assert [r["item_id"] for r in field.candidates(blocks, buckets, 1).collect()] == ["a"]
    assert field.candidates(blocks, buckets, 1, prune=False).count() == 302
