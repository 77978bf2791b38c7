"""Rows that tie with a bound are not all candidates, and postings stay where they are read."""

from coldflow.operators import posting_store
from coldflow.operators.posting_store import CatalogueStore
from tests.conftest import rows


def _tied(spark, tmp_path, n=600):
    words = ("red", "blue", "old")
    docs = [(str(i), f"{words[i % 3]} ring", "one singer", i) for i in range(n)]
    store = CatalogueStore(str(tmp_path / "store"), buckets=3)
    store.build(spark.createDataFrame(docs, "item_id string, name string, singer string, fire int"))
    return store.snapshot(spark)


def test_rows_that_tie_with_the_bound_are_no_candidates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(posting_store, "BLOCK_ROWS", 40)
    index = _tied(spark, tmp_path).field("name")
    q = spark.createDataFrame([("red ring",), ("blue ring",), ("ring",), ("old red",)], "q string")
    for k in (1, 5):
        blocks, buckets = index.query_blocks(q, "q")
        found = index.candidates(blocks, buckets, k)
        assert found.where("q = 'red ring'").count() < 100  # 200 rows tie for the best score
        assert rows(index.match(q, "q", k)) == rows(index.match(q, "q", k, prune=False))


def test_match_without_broadcast_blocks(spark, tmp_path, monkeypatch):
    index = _tied(spark, tmp_path, 60).field("name")
    q = spark.createDataFrame([("red ring",), ("old red",)], "q string")
    want = rows(index.match(q, "q", 5))
    monkeypatch.setattr(posting_store, "SMALL_BYTES", 0)
    assert rows(index.match(q, "q", 5)) == want


def test_postings_are_not_broadcast(spark, tmp_path):
    index = _tied(spark, tmp_path, 60).field("name")
    blocks, buckets = index.query_blocks(spark.createDataFrame([("red ring",)], "q string"), "q")
    pairs = index.candidates(blocks, buckets, 1, prune=False, few=True)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "leftHint=(strategy=merge)" in plan
