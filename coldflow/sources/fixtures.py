"""Input sets derived from the driver tables (recipes in FIXTURES.md §2).

Each builder is a pure DataFrame plan over the given tables, so its size grows
with the scale factor and Spark can push filters and prune columns into the
parquet scans.  The same recipes are written in SQL in ``coldflow.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldflow.functions.text import LOG_FIELD_SEP, SINGER_NAME_KEY, SONG_NAME_KEY
from coldflow.operators.indexing import dense_index
from coldflow.sources.tables import Tables

# Fixed "now" values of the recipes (FIXTURES.md §2).
KV_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)
GRAPH_TODAY = dt.date(2001, 7, 25)
NEWS_NOW = dt.datetime(2024, 1, 9, 12, 0, 0)
NEWS_WORDS = ("src1", "src2", "fr")
NEWS_KEYWORDS = ("of the", "de la", "the", "les", "que", "zzzz")
TEMPLATE = (
    '{"individual":"1","configName":"n","algorithmConfig":{"a":1},"historyConfig":{},'
    '"ctrConfig":{"c":[1]},"diversityConfig":{},"selectorConfig":{"s":"x"}}'
)


def ntz(value: dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (independent of the session and Python time zones)."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S}'")


def _m(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


# ---------------------------------------------------------------------------
# Recall slice: catalogue, songs, log lines
# ---------------------------------------------------------------------------
def ring(t: Tables) -> DataFrame:
    """Catalogue (item_id, name, singer, fire) from ``part``."""
    return t.part.select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("name"),
        F.upper("p_brand").alias("singer"),
        F.floor("p_retailprice").cast("int").alias("fire"),
    )


def ring_base(t: Tables) -> DataFrame:
    """The catalogue before its change: without the items whose key is divisible by 5."""
    return ring(t).where(F.col("item_id").cast("bigint") % 5 != 0)


def ring_changes(t: Tables) -> DataFrame:
    """(item_id, name, singer, fire, deleted): every 5th item comes, every 7th goes, every 11th gets a longer name."""
    r = ring(t).withColumn("k", F.col("item_id").cast("bigint"))
    r = r.where((F.col("k") % 5 == 0) | (F.col("k") % 7 == 0) | (F.col("k") % 11 == 0))
    name = F.when(F.col("k") % 11 == 0, F.concat(F.col("name"), F.lit(" special edition"))).otherwise(F.col("name"))
    return r.withColumn("name", name).withColumn("deleted", F.col("k") % 7 == 0).drop("k")


def song(t: Tables) -> DataFrame:
    """Songs per event (event_id, pos, song, singer) before any parsing."""
    n = t.part_count
    ev = t.events.select("event_id").where(~_m("event_id", 10).isin(0, 1, 2, 5))
    s = ev.select("event_id", F.explode(F.sequence(F.lit(0), _m("event_id", 3))).alias("pos"))
    s = s.withColumn("h", F.col("event_id") + F.col("pos")).withColumn(
        "pk", (F.col("event_id") * 7 + F.col("pos") * 13) % F.lit(n)
    )
    p = t.part.select(F.col("p_partkey").alias("pk"), "p_name", F.upper("p_brand").alias("brand"))
    s = s.join(p, "pk")
    h4, h8, h16 = F.col("h") % 4, F.col("h") % 8, F.col("h") % 16
    name = F.when(h4 == 0, F.lit("qqq zzz")).when(h4 == 1, F.lit("")).otherwise(F.col("p_name"))
    singer = (
        F.when(h16 == 9, F.lit(""))
        .when(h8.isin(0, 1), F.col("brand"))
        .when(h8.isin(4, 5), F.lit("NOBODY XYZ"))
        .otherwise(F.concat(F.col("brand"), F.lit(",OTHER")))
    )
    return s.select("event_id", "pos", name.alias("song"), singer.alias("singer"))


def _song_object(song_col: Column, singer_col: Column) -> Column:
    return F.concat(
        F.lit('{"' + SONG_NAME_KEY + '":"'), song_col, F.lit('","' + SINGER_NAME_KEY + '":"'), singer_col, F.lit('"}')
    )


def log(t: Tables) -> DataFrame:
    """Raw log lines (value, event_id, ts): one per event, shaped by ``event_id % 10``."""
    objs = song(t).select("event_id", F.struct("pos", _song_object(F.col("song"), F.col("singer")).alias("o")).alias("x"))
    # Songs per event are few (<= 3); collecting them per event is bounded.
    arr = objs.groupBy("event_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    arr = arr.select("event_id", F.array_join(F.transform("xs", lambda x: x["o"]), ",").alias("j"))
    ev = t.events.select("event_id", "ts", "user_id").join(arr, "event_id", "left")
    js = F.concat(F.lit("["), F.coalesce(F.col("j"), F.lit("")), F.lit("]"))
    uid_term = F.concat(F.lit("uid~"), F.col("user_id").cast("string"))
    audios_term = F.concat(F.lit("audios~"), js)
    tail = F.lit("trace~x")
    m = _m("event_id", 10)
    value = (
        F.when(m == 0, F.concat_ws(LOG_FIELD_SEP, uid_term, F.lit("audios~"), tail))
        .when(m == 1, F.concat_ws(LOG_FIELD_SEP, audios_term, tail))
        .when(m == 2, F.concat_ws(LOG_FIELD_SEP, uid_term, F.lit("audios~oops"), tail))
        .when(m == 3, F.concat_ws(LOG_FIELD_SEP, F.concat(uid_term, F.lit("~junk")), audios_term, tail))
        .when(m == 4, F.concat_ws(LOG_FIELD_SEP, F.lit("uid~old"), uid_term, audios_term, tail))
        .otherwise(F.concat_ws(LOG_FIELD_SEP, uid_term, audios_term, tail))
    )
    return ev.select(value.alias("value"), "event_id", "ts")


def half_of_events(t: Tables) -> int:
    """Event ids below this one are the first half."""
    return (t.events.agg(F.max("event_id")).collect()[0][0] or 0) // 2


# ---------------------------------------------------------------------------
# Keyed tables
# ---------------------------------------------------------------------------
def zset_ops(t: Tables) -> DataFrame:
    """(key, member, score, op, version): sorted-set writes, replace every 7th event."""
    e = t.events
    return e.select(
        F.concat(F.lit("z:"), (F.col("user_id") % 50).cast("string")).alias("key"),
        F.col("event_type").alias("member"),
        F.col("value").alias("score"),
        F.when(_m("event_id", 7) == 0, F.lit("replace")).otherwise(F.lit("put")).alias("op"),
        F.col("event_id").alias("version"),
    )


def zset_ttl_ops(t: Tables) -> DataFrame:
    """(key, member, score, op, ttl, write_ts, version): replace every 29th event, ttl -1, 0 or (id % 5) half days."""
    e = t.events
    return e.select(
        F.concat(F.lit("z:"), (F.col("user_id") % 50).cast("string")).alias("key"),
        F.col("event_type").alias("member"),
        F.col("value").alias("score"),
        F.when(_m("event_id", 29) == 0, F.lit("replace")).otherwise(F.lit("put")).alias("op"),
        F.when(_m("event_id", 3) == 0, F.lit(-1)).otherwise(_m("event_id", 5) * 43200).cast("int").alias("ttl"),
        F.col("ts").alias("write_ts"),
        F.col("event_id").alias("version"),
    )


def kv_ops(t: Tables) -> DataFrame:
    """(key, value, ttl, write_ts, version): string sets with a TTL in seconds (0 = none)."""
    e = t.events
    return e.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("value"),
        (_m("event_id", 3) * 86400).alias("ttl"),
        F.col("ts").alias("write_ts"),
        F.col("event_id").alias("version"),
    )


def hash_writes(t: Tables) -> DataFrame:
    """(key, template, version): one gray-config write per event.

    The template's ``configName`` is the event type, so later writes differ
    from earlier ones and the replace semantics are visible.
    """
    e = t.events
    tpl = F.lit(TEMPLATE)
    tpl = F.regexp_replace(tpl, F.lit('"configName":"n"'), F.concat(F.lit('"configName":"'), F.col("event_type"), F.lit('"')))
    return e.select(
        F.concat(F.lit("cfg:"), F.col("user_id").cast("string")).alias("key"),
        tpl.alias("template"),
        F.col("event_id").alias("version"),
    )


def cells(t: Tables) -> DataFrame:
    """(row_key, column, value, version) wide-column puts; every 5th event has a second version."""
    e = t.events.select("event_id", "user_id", "event_type", "value")
    algo = F.when(_m("event_id", 11) == 0, F.lit("娱乐")).otherwise(F.col("event_type"))
    row_key = F.concat_ws("~", F.col("user_id").cast("string"), algo, F.col("event_id").cast("string"))
    column = F.when(_m("event_id", 13) == 0, F.lit("cf:x")).otherwise(F.lit("cf:s"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    base = e.select(
        row_key.alias("row_key"), column.alias("column"), cents.alias("cents"), F.col("event_id").alias("version"), "event_id"
    )
    second = base.where(_m("event_id", 5) == 0).select(
        "row_key", "column", (F.col("cents") + 100).alias("cents"), (F.col("version") + 1000000).alias("version"), "event_id"
    )
    both = base.unionByName(second)
    return both.select("row_key", "column", F.col("cents").cast("string").alias("value"), "version")


def cell_requests(t: Tables) -> DataFrame:
    """(request_id, row_key, family, qualifier): one lookup per event, by the key it would have without the 娱乐 rename."""
    e = t.events
    rk = F.concat_ws("~", F.col("user_id").cast("string"), F.col("event_type"), F.col("event_id").cast("string"))
    return e.select(F.col("event_id").alias("request_id"), rk.alias("row_key"), F.lit("cf").alias("family"), F.lit("s").alias("qualifier"))


def prefix_requests(t: Tables) -> DataFrame:
    """(uid, family, qualifier, limit): one newest-rows request per user, limits -1..5."""
    u = t.events.select("user_id").distinct()
    return u.select(
        F.col("user_id").cast("string").alias("uid"),
        F.lit("cf").alias("family"),
        F.lit("s").alias("qualifier"),
        ((F.col("user_id") % 7) - 1).cast("int").alias("limit"),
    )


# ---------------------------------------------------------------------------
# Graph
# ---------------------------------------------------------------------------
def nodes(t: Tables) -> DataFrame:
    """(id, label, uid, name): customers are USERs, parts MOVIEs, suppliers CELEBRITYs."""
    users = t.customer.select(
        F.concat(F.lit("u:"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit("USER").alias("label"),
        F.col("c_custkey").cast("string").alias("uid"),
        F.col("c_name").alias("name"),
    )
    movies = t.part.select(
        F.concat(F.lit("m:"), F.col("p_partkey").cast("string")).alias("id"),
        F.lit("MOVIE").alias("label"),
        F.lit(None).cast("string").alias("uid"),
        F.col("p_name").alias("name"),
    )
    celebs = t.supplier.select(
        F.concat(F.lit("c:"), F.col("s_suppkey").cast("string")).alias("id"),
        F.lit("CELEBRITY").alias("label"),
        F.lit(None).cast("string").alias("uid"),
        F.col("s_name").alias("name"),
    )
    return users.unionByName(movies).unionByName(celebs)


def edges(t: Tables) -> DataFrame:
    """(src, dst, type, frequency, last_time BIGINT yyyyMMddHHmmss).

    LIKE: customer -> part over orders x lineitem (count, newest order time;
    every 17th order has no time); customers without orders like nothing.
    ACT: supplier -> part for every pair in lineitem.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    lt = F.when(_m("o_orderkey", 17) == 0, F.lit(None)).otherwise(
        F.date_format("o_orderdate", "yyyyMMddHHmmss").cast("bigint")
    )
    likes = (
        o.join(li, o.o_orderkey == li.l_orderkey)
        .groupBy("o_custkey", "l_partkey")
        .agg(F.count(F.lit(1)).cast("int").alias("frequency"), F.max(lt).alias("last_time"))
        .select(
            F.concat(F.lit("u:"), F.col("o_custkey").cast("string")).alias("src"),
            F.concat(F.lit("m:"), F.col("l_partkey").cast("string")).alias("dst"),
            F.lit("LIKE").alias("type"),
            "frequency",
            "last_time",
        )
    )
    acts = (
        li.select("l_suppkey", "l_partkey")
        .distinct()
        .select(
            F.concat(F.lit("c:"), F.col("l_suppkey").cast("string")).alias("src"),
            F.concat(F.lit("m:"), F.col("l_partkey").cast("string")).alias("dst"),
            F.lit("ACT").alias("type"),
            F.lit(None).cast("int").alias("frequency"),
            F.lit(None).cast("bigint").alias("last_time"),
        )
    )
    return likes.unionByName(acts)


def uid_lines(t: Tables) -> DataFrame:
    """(value) lines of a uid file: ``<name> <custkey>`` with trailing blanks on even keys."""
    c = t.customer
    pad = F.when(F.col("c_custkey") % 2 == 0, F.lit("  ")).otherwise(F.lit(""))
    return c.select(F.concat(F.col("c_name"), F.lit(" "), F.col("c_custkey").cast("string"), pad).alias("value"))


def requested_users(t: Tables) -> DataFrame:
    """(uid) asked for by the get-or-create / assignment jobs.

    One uid per pair of suppliers, ``(s_suppkey DIV 2 + 1) * 37``: about
    a fifth lie above the customer keys (new users), and there are half as
    many requests as celebrities, so each new user gets two.
    """
    k = F.expr("s_suppkey div 2") + 1
    return t.supplier.select((k * 37).cast("bigint").cast("string").alias("uid")).distinct()


def _interest(t: Tables, parity: int) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").where(F.col("o_orderkey") % 2 == parity)
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    s = t.supplier.select("s_suppkey", "s_name")
    j = o.join(li, o.o_orderkey == li.l_orderkey).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy(F.col("o_custkey").cast("string").alias("uid"), F.col("s_name").alias("word")).agg(
        F.count(F.lit(1)).cast("int").alias("frequency"),
        F.max(F.date_format("o_orderdate", "yyyyMMddHHmmss").cast("bigint")).alias("last_time"),
    )


def interest_stored(t: Tables) -> DataFrame:
    """(uid, word, frequency, last_time) stored interest edges: odd orders' suppliers per customer."""
    return _interest(t, 1)


def interest_batch(t: Tables) -> DataFrame:
    """(uid, word, frequency, last_time) a new batch of query words: even orders."""
    return _interest(t, 0)


# ---------------------------------------------------------------------------
# News, channels, messages, times
# ---------------------------------------------------------------------------
def news(t: Tables) -> DataFrame:
    """(row_id, doc_id, title, created_time, publish_time, channels)."""
    d = t.documents.select("doc_id", "text", "lang", "source")
    base = ntz(dt.datetime(2024, 1, 1))
    created = F.when(_m("doc_id", 19) == 0, F.lit(None)).otherwise(F.timestamp_add("MINUTE", F.col("doc_id"), base))
    pub_days = (F.floor(F.col("doc_id") / 20) % 10).cast("int")
    pub = F.timestamp_add("HOUR", F.col("doc_id") % 24, F.timestamp_add("DAY", pub_days, base))
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.when(_m("doc_id", 23) == 0, F.lit(None)).otherwise(F.col("doc_id").cast("string")).alias("doc_id"),
        F.col("text").alias("title"),  # the whole text: titles are searched in full
        created.cast("timestamp_ntz").alias("created_time"),
        pub.alias("publish_time"),
        F.array("source", "lang").alias("channels"),
    )


def keywords(spark, words=NEWS_KEYWORDS) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "keyword string")


def channel_cache(t: Tables) -> DataFrame:
    """(channel, item_id, score): duplicates of (channel, item) are intended."""
    return t.events.select(
        F.col("event_type").alias("channel"), F.col("user_id").cast("string").alias("item_id"), F.col("value").alias("score")
    )


def channel_text(t: Tables) -> DataFrame:
    """(event_id, value) encoded channel strings ``c<u%5>:<id>~c<id%5>:9``; every 31st is malformed."""
    e = t.events
    good = F.concat(
        F.lit("c"), (F.col("user_id") % 5).cast("string"), F.lit(":"), F.col("event_id").cast("string"),
        F.lit("~c"), (F.col("event_id") % 5).cast("string"), F.lit(":9"),
    )
    value = F.when(_m("event_id", 31) == 0, F.lit("c1")).otherwise(good)
    return e.select("event_id", value.alias("value"))


def channel_list(t: Tables) -> DataFrame:
    """(event_id, json) channel lists; every 6th lacks the channel id."""
    e = t.events
    first = F.when(_m("event_id", 6) == 0, F.lit('{"y":0}')).otherwise(
        F.concat(F.lit('{"channelId":'), (F.col("user_id") % 5).cast("string"), F.lit("}"))
    )
    return e.select("event_id", F.concat(F.lit("["), first, F.lit(',{"x":1}]')).alias("json"))


def messages(t: Tables) -> DataFrame:
    """(msg_id, topic, tag, body, store_ts, partition, offset): every id delivered twice."""
    e = t.events.select("event_id", "user_id", "event_type", "props", "ts")
    rows = e.select(
        "event_id",
        (F.floor(F.col("event_id") / 2)).cast("bigint").alias("msg_id"),
        F.lit("t").alias("topic"),
        F.col("event_type").alias("tag"),
        F.col("props").alias("body"),
        F.col("ts").alias("store_ts"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
    )
    # Offsets are the rank of the event inside its source partition.  A window
    # per partition would put a whole source partition into one task, so the
    # distributed dense numbering is used instead.
    numbered = dense_index(rows, order_cols=["event_id"], group_cols=["partition"], out="offset")
    return numbered.drop("event_id")


def lenient_times(t: Tables) -> DataFrame:
    """(event_id, t) times whose fields run over: month + 12, day + 31, hour + 25, second + 75, month 0; every 37th is no time."""
    e = t.events
    k = _m("event_id", 6)
    year, month, day = F.year("ts"), F.month("ts"), F.dayofmonth("ts")
    month = F.when(k == 1, month + 12).when(k == 5, F.lit(0)).otherwise(month)
    day = F.when(k == 2, day + 31).otherwise(day)
    hour = F.when(k == 3, F.hour("ts") + 25).otherwise(F.hour("ts"))
    second = F.when(k == 4, F.second("ts") + 75).otherwise(F.second("ts"))
    text = F.concat(F.concat_ws("-", year, month, day), F.lit(" "), F.concat_ws(":", hour, F.minute("ts"), second), F.lit(" GMT"))
    return e.select("event_id", F.when(_m("event_id", 37) == 0, F.lit("bad")).otherwise(text).alias("t"))


def times(t: Tables) -> DataFrame:
    """(event_id, t) timestamps as text; every 37th is unparseable."""
    e = t.events
    txt = F.when(_m("event_id", 37) == 0, F.lit("bad")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", txt.alias("t"))
