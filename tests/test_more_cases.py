"""Lenient times, payload bytes, positional phrases, split joins and the bounded two-hop join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coldflow.functions import timefmt
from coldflow.operators import graph, match, news, parse
from coldflow.session import files_version, scratch_path
from coldflow.sources.fixtures import ntz
from coldflow.sources.logsource import collection_scan, raw_messages, whole_text
from tests.conftest import rows
from tests.test_graph import EDGE, NODE


@pytest.mark.parametrize(
    "text,fmt,want",
    [
        ("2016-02-30", "yyyy-MM-dd", "2016-03-01 00:00:00"),
        ("2016-13-01 25:61:61", "yyyy-MM-dd HH:mm:ss", "2017-01-02 02:02:01"),
        ("2016-0-0", "yyyy-M-d", "2015-11-30 00:00:00"),
        ("2016-7-9 and more", "yyyy-MM-dd", "2016-07-09 00:00:00"),
        ("20160709235960", "yyyyMMddHHmmss", "2016-07-10 00:00:00"),
        ("9 JULY 2016", "d MMM yyyy", "2016-07-09 00:00:00"),
        ("Jul-9", "MMM-d", "1970-07-09 00:00:00"),
        ("at 5 o'clock", "'at' H 'o''clock'", "1970-01-01 05:00:00"),
        ("12:00:01.1500", "HH:mm:ss.S", "1970-01-01 12:00:02.5"),
        ("x2016-01-01", "yyyy-MM-dd", None),
        ("2016/01/01", "yyyy-MM-dd", None),
        ("2016-99999999999-01", "yyyy-MM-dd", None),
        ("9 Foo 2016", "d MMM yyyy", None),
        (None, "yyyy", None),
    ],
)
def test_lenient_times(spark, text, fmt, want):
    df = spark.createDataFrame([(text,)], "t string").select(timefmt.lenient_ntz(F.col("t"), fmt).cast("string").alias("x"))
    assert df.collect()[0][0] == want


def test_lenient_pattern_refuses_what_it_does_not_know():
    for fmt in ("yy-MM", "EEE", "hh a"):
        with pytest.raises(ValueError):
            timefmt.lenient_ntz(F.lit("x"), fmt)


def test_bad_bytes_are_rejected(spark):
    good = "uid~1\x1faudios~[]".encode()
    df = spark.createDataFrame([(1, good), (2, good + b"\xff"), (3, b"uid~\xe4\xbd\x1faudios~[]"), (4, None), (6, b"\xff"), (5, "uid~é\x1faudios~[]".encode())], "event_id long, value binary")
    got = parse.parse_log(df)
    assert rows(got, "event_id", "uid", "reason") == [(1, "1", None), (2, "1", "bad_bytes"), (3, "\ufffd", "bad_bytes"), (4, None, "incomplete"), (5, "é", None), (6, None, "incomplete")]
    raw = raw_messages(df.select("value", F.lit(0).alias("partition"), F.col("event_id").alias("offset"), ntz(dt.datetime(2024, 1, 1)).alias("timestamp")))
    assert dict(raw.dtypes)["bytes"] == "binary" and raw.where("offset = 2").collect()[0]["bytes"] == good + b"\xff"


def test_whole_text_and_collections(spark):
    base = scratch_path(spark, "texts")
    spark.createDataFrame([("a\nb",), ("c",)], "value string").coalesce(1).write.text(base)
    got = whole_text(spark, base).collect()
    assert [r["value"] for r in got] == ["a\nb\nc\n"] and got[0]["path"].startswith("file:")
    spark.createDataFrame([(1, "x")], "id long, name string").write.json(f"{base}-json")
    assert rows(collection_scan(spark, f"{base}-json", schema="id long, name string, more int")) == [(1, "x", None)]
    assert rows(collection_scan(spark, f"{base}-json")) == [(1, "x")]


def test_phrases_by_position(spark):
    texts = [(1, "a b a c"), (2, "b a a b"), (3, "a B a"), (4, ""), (5, None), (6, "a x b a b a"), (7, "c c c")]
    docs = spark.createDataFrame(texts, "id long, t string")
    index = match.build_phrase_index(docs, "id", "t")
    kw = spark.createDataFrame([("a b a",), ("b",), ("c c",), ("a a a",), ("z",), ("",), (None,), ("a z",)], "k string")
    assert rows(match.phrase_matches(kw, "k", index), "k", "id") == [("a b a", 1), ("a b a", 3), ("a b a", 6), ("b", 1), ("b", 2), ("b", 3), ("b", 6), ("c c", 7)]
    assert "t" not in index.postings.columns


def test_filters_stand_below_the_tokenizer(spark):
    base = dt.datetime(2024, 1, 9)
    docs = spark.createDataFrame(
        [(1, "d", "a b", base, base, ["x1"])],
        "row_id long, doc_id string, title string, created_time timestamp_ntz, publish_time timestamp_ntz, channels array<string>",
    )
    path = scratch_path(spark, "news")
    docs.write.parquet(path)
    s = news.NewsSearch(spark.read.parquet(path), ["x"], ntz(base))
    plan = s.phrase.postings._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") < plan.index("exists(channels")  # the tokenizer's projection is above the filter
    assert rows(s.newest(spark.createDataFrame([("a b",)], "keyword string")), "doc_id") == [("d",)]


def test_split_joins_lose_nothing(spark, monkeypatch):
    left = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("zz", 4)], "k string, v int")
    want = rows(left.join(right, "k"), "k", "id", "v")
    assert rows(match.join_split(left, right, "k", ["id"]), "k", "id", "v") == want
    monkeypatch.setattr(match, "HOT_ROWS", 20)
    assert match.hot_keys(left, "k").collect()[0]["_shares"] == 17
    assert rows(match.join_split(left, right, "k", ["id"]), "k", "id", "v") == want


def test_two_hop_names_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(match, "HOT_ROWS", 4)
    monkeypatch.setattr(graph, "HEAD", 2)
    nodes = [(f"u{i}", "USER", str(i), None) for i in range(12)] + [(f"m{i}", "MOVIE", None, None if i == 3 else f"n{i % 9}") for i in range(15)]
    nodes += [(f"c{i}", "CELEBRITY", None, f"c{i:02}") for i in range(20)]
    likes = [(f"u{i}", f"m{j}") for i in range(12) for j in range(15) if (i * j) % 4 == 0 or j == 0]
    acts = [(f"c{i}", f"m{j}") for i in range(20) for j in range(15) if (i + j) % 3 == 0]
    edges = [(a, b, "LIKE", 1, 1) for a, b in likes + likes[:5]] + [(a, b, "ACT", None, None) for a, b in acts]
    n, e = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE)
    name = {i: x for i, _, _, x in nodes}
    full = {}
    for u, m in likes:
        full.setdefault(u[1:], set()).update(x for x in [name[m], *(name[c] for c, w in acts if w == m)] if x)
    for limit in (1, 5, 50, -1):
        want = sorted((u, x) for u, names in full.items() for x in (sorted(names)[:limit] if limit > 0 else names))
        assert rows(graph.liked_names(n, e, limit), "uid", "name") == want
    plan = graph.liked_names(n, e)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_the_files_version_follows_the_files(spark):
    path = scratch_path(spark, "files")
    spark.range(3).write.parquet(path)
    first = files_version(spark.read.parquet(path))
    assert files_version(spark.read.parquet(path)) == first
    spark.range(4).write.mode("overwrite").parquet(path)
    assert files_version(spark.read.parquet(path)) != first
