"""Recall merge cases of FIXTURES.md 1.3 (cap 3) and waterfall properties."""

import pytest
from pyspark.sql import functions as F

from coldflow.operators import recall
from coldflow.operators.match import build_index, match
from tests.conftest import SF_SMALL


def _wf(spark, name, singer):
    schema = "event_id long, pos int, item_id string, fire int, score double, rank int"
    n = spark.createDataFrame([(1, 0, i, f, 1.0, 1) for i, f in name], schema)
    s = spark.createDataFrame([(1, 1, i, f, 1.0, 1) for i, f in singer], schema)
    wf = recall.Waterfall(None, None, 1, 5)
    wf.__dict__.update(name=n, singer=s, misses=spark.createDataFrame([], "event_id long, pos int, kind string, text string"))
    return wf


@pytest.mark.parametrize(
    "name,singer,expected",
    [
        ([("n1", 5)], [], [("n1", "name")]),
        ([], [], []),
        ([("n1", 5), ("n2", 4)], [("s1", 9), ("s2", 8)], [("n1", "name"), ("n2", "name"), ("s1", "singer")]),
        ([("n1", 5)], [("n1", 5), ("s1", 9), ("s2", 8), ("s3", 7)], [("n1", "name"), ("s1", "singer"), ("s2", "singer")]),
        ([("n1", 1), ("n2", 2), ("n3", 3), ("n4", 4)], [("s1", 9)], [("n4", "name"), ("n3", "name"), ("n2", "name")]),
    ],
)
def test_merge_cases(spark, name, singer, expected):
    songs = spark.createDataFrame([(1, "u")], "event_id long, uid string")
    out = recall.merge_recalls(_wf(spark, name, singer), songs, cap=3).orderBy("rank").collect()
    assert [(r["item_id"], r["match_kind"]) for r in out] == expected


def test_match_top1_prefers_full_match(spark):
    docs = spark.createDataFrame(
        [("1", "small ring", 1), ("2", "small gear", 2), ("3", "red ring", 3), ("4", "small ring", 4)],
        "item_id string, name string, fire int",
    )
    idx = build_index(docs, "item_id", "name", payload=["fire"], postings_per_task=1)
    q = spark.createDataFrame([("small ring",), ("zzz",), ("",)], "q string")
    got = {r["q"]: r["item_id"] for r in match(q, "q", idx, 1).collect()}
    assert got == {"small ring": "1"}  # tie between 1 and 4 -> smaller id; no terms -> no hit


def test_waterfall_one_outcome_per_song(spark):
    from coldflow.plans.recall import _waterfall

    songs, wf = _waterfall(spark, SF_SMALL)
    per_song = wf.outcomes().groupBy("event_id", "pos").agg(F.countDistinct("match_kind").alias("k"))
    assert per_song.where("k <> 1").count() == 0
    assert per_song.count() == songs.count()


def test_cap_never_exceeded_and_name_first(spark):
    from coldflow.plans.recall import _waterfall

    songs, wf = _waterfall(spark, SF_SMALL)
    m = recall.merge_recalls(wf, songs, cap=3)
    assert m.groupBy("event_id").count().where("count > 3").count() == 0
    # a singer hit is never kept while a name hit of the same event is dropped
    names = wf.name.select("event_id", "item_id").distinct()
    kept = m.select("event_id", "item_id")
    dropped_names = names.join(kept, ["event_id", "item_id"], "left_anti").select("event_id").distinct()
    singer_kept = m.where("match_kind = 'singer'").select("event_id").distinct()
    assert dropped_names.join(singer_kept, "event_id").count() == 0


def test_salting_changes_nothing(spark):
    """Hot-term salting spreads postings over tasks but gives the same scores."""
    from coldflow.operators.match import score_queries
    from coldflow.sources import fixtures
    from coldflow.sources.tables import Tables
    from tests.conftest import rows

    ring = fixtures.ring(Tables(spark, SF_SMALL))
    q = ring.select(F.col("name").alias("q")).unionByName(ring.select(F.col("singer").alias("q")))
    plain = build_index(ring, "item_id", "name", payload=["fire"])
    salted = build_index(ring, "item_id", "name", payload=["fire"], postings_per_task=3)
    assert salted.doc_freq.agg(F.max("salts")).collect()[0][0] > 1
    assert rows(score_queries(q, "q", plain)) == rows(score_queries(q, "q", salted))


def test_pruned_match_equals_direct(spark):
    """MaxScore candidates give exactly the direct term join's top k (names top 1, singers top 5)."""
    from coldflow.operators.match import match
    from coldflow.plans.recall import _songs
    from coldflow.sources import fixtures
    from coldflow.sources.tables import Tables
    from tests.conftest import SF_MID, rows

    t = Tables(spark, SF_MID)
    cat = recall.build_catalogue(fixtures.ring(t))
    songs = _songs(spark, SF_MID)
    for col, idx, k in (("song_name", cat.name, 1), ("first_singer", cat.singer, 5)):
        q = songs.select(F.col(col).alias("q"))
        assert rows(match(q, "q", idx, k, prune=True)) == rows(match(q, "q", idx, k, prune=False))


def test_pruning_skips_stop_word_postings(spark):
    """A query 'brand 17' never pairs with every doc holding 'brand'."""
    from coldflow.operators.match import score_candidates_pruned, score_queries
    from coldflow.sources import fixtures
    from coldflow.sources.tables import Tables

    ring = fixtures.ring(Tables(spark, SF_SMALL))
    idx = build_index(ring, "item_id", "singer", payload=["fire"])
    q = spark.createDataFrame([("BRAND#17",)], "q string")
    assert score_candidates_pruned(q, "q", idx, 5).count() < score_queries(q, "q", idx).count()


def test_pruned_match_equals_direct_on_long_texts(spark):
    """Whole-document BM25 with stop-word queries: MaxScore keeps exactly the direct top k."""
    from coldflow.operators.match import match
    from coldflow.sources import fixtures
    from coldflow.sources.tables import Tables
    from tests.conftest import SF_MID, rows

    news = fixtures.news(Tables(spark, SF_MID))
    idx = build_index(news.select("row_id", "title"), "row_id", "title")
    turns = Tables(spark, SF_MID).conversations.select(F.col("text").alias("q"))  # whole turns as queries
    kw = turns.unionByName(spark.createDataFrame([(w,) for w in fixtures.NEWS_KEYWORDS], "q string"))
    for k in (1, 10):
        assert rows(match(kw, "q", idx, k, prune=True)) == rows(match(kw, "q", idx, k, prune=False))
