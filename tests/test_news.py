"""News, channel and time cases of FIXTURES.md 1.4."""

import datetime as dt

from pyspark.sql import functions as F

from coldflow.functions import timefmt
from coldflow.operators import news
from coldflow.sources.fixtures import ntz
from tests.conftest import rows


def test_time_score(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 7, 19, 1, 2, 3),), (None,)], "t timestamp_ntz")
    got = [r["s"] for r in df.select(news.time_score(F.col("t")).alias("s")).collect()]
    assert got == [20160719010203.0, 1.0]


def test_title_search_cut_then_filter(spark):
    base = dt.datetime(2024, 1, 9)
    docs = spark.createDataFrame(
        [
            (1, None, "a b c", base, base, ["x1"]),
            (2, "d2", "a b", base - dt.timedelta(hours=1), base, ["x1"]),
            (3, "d3", "x a b", base - dt.timedelta(hours=2), base, ["x1"]),
            (4, "d4", "a b", base - dt.timedelta(hours=3), base, ["x1"]),
        ],
        "row_id long, doc_id string, title string, created_time timestamp_ntz, publish_time timestamp_ntz, channels array<string>",
    )
    s = news.NewsSearch(docs, ["x"], ntz(base))
    kw = spark.createDataFrame([("a b",)], "keyword string")
    assert rows(s.newest(kw), "doc_id") == [("d2",), ("d3",)]
    assert rows(s.num_found(kw), "keyword", "num_found", "page_size") == [("a b", 4, 4)]


def test_channel_decode(spark):
    df = spark.createDataFrame([(1, "a:1~b:2:9~a:3"), (2, "a:1~b")], "event_id long, value string")
    ok, bad = news.decode_channels(df)
    assert rows(ok, "channel", "value") == [("a", "3"), ("b", "2")]
    assert rows(bad, "event_id") == [(2,)]


def test_channel_ids(spark):
    df = spark.createDataFrame([(1, '[{"channelId":7},{"x":1},{"channelId":7}]')], "event_id long, json string")
    assert rows(news.channel_ids(df), "idx", "channel_id") == [(0, "7"), (1, "7")]


def test_time_parse_is_zone_independent(spark):
    df = spark.createDataFrame([("2016-07-09 00:00:00",), ("2016-7-9",), ("bad",)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = []
        for tz in ("UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out.append([r[0] for r in df.select(timefmt.epoch_millis(timefmt.parse_ntz(F.col("t")))).collect()])
        assert out[0] == out[1] == [1468022400000, 1468022400000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
