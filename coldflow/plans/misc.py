"""Registered news, channel, message, time and metrics queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from coldflow.functions import timefmt
from coldflow.operators import graph, messages, news, parse, recall
from coldflow.session import scratch_path, stage_table
from coldflow.sources.logsource import collection_scan, raw_messages
from coldflow.plans.recall import _waterfall
from coldflow.sources import fixtures
from coldflow.sources.tables import Tables

METRICS_SINK_TIME = dt.datetime(2024, 2, 1)
OFFSET_TIME = dt.datetime(2024, 1, 15)


def _search(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = news.NewsSearch(fixtures.news(t), fixtures.NEWS_WORDS, fixtures.ntz(fixtures.NEWS_NOW), stage=stage_table)
    return s, fixtures.keywords(spark)


def q_title_newest(spark, sf_dir):
    s, kw = _search(spark, sf_dir)
    return s.newest(kw)


def q_title_relevance(spark, sf_dir):
    s, kw = _search(spark, sf_dir)
    return s.relevance(kw)


def q_title_num_found(spark, sf_dir):
    s, kw = _search(spark, sf_dir)
    return s.num_found(kw)


def q_channel_ids(spark, sf_dir):
    return news.channel_ids(fixtures.channel_list(Tables(spark, sf_dir)))


def q_channel_decode(spark, sf_dir):
    rows, _ = news.decode_channels(fixtures.channel_text(Tables(spark, sf_dir)))
    return rows


def q_channel_decode_rejects(spark, sf_dir):
    _, bad = news.decode_channels(fixtures.channel_text(Tables(spark, sf_dir)))
    return bad


def q_channel_topk(spark, sf_dir):
    return news.channel_topk(fixtures.channel_cache(Tables(spark, sf_dir)), 5)


def _msgs(spark, sf_dir):
    return fixtures.messages(Tables(spark, sf_dir))


def q_offset_range(spark, sf_dir):
    m = messages.offset_range(_msgs(spark, sf_dir), starting=100, ending=500)
    return m.select("msg_id", "tag", "partition", "offset")


def q_offset_for_time(spark, sf_dir):
    return messages.offset_before(_msgs(spark, sf_dir), fixtures.ntz(OFFSET_TIME))


def q_tag_subscribe(spark, sf_dir):
    m = messages.subscribe(_msgs(spark, sf_dir), "t", "click || view")
    return m.select("msg_id", "tag", "partition", "offset")


def q_msg_dedup(spark, sf_dir):
    return messages.latest_per_id(_msgs(spark, sf_dir))


def _failures(m):
    """Error-tagged deliveries fail once; those with an even id fail on the retry too."""
    err = m.where(F.col("tag") == "error").select("msg_id").distinct()
    return err.select("msg_id", F.lit(1).alias("attempt")).unionByName(
        err.where(F.col("msg_id") % 2 == 0).select("msg_id", F.lit(2).alias("attempt"))
    )


def q_msg_redeliver(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    retry, _ = messages.redeliver(m, _failures(m), max_attempts=1)
    return retry.select("msg_id", "partition", "offset", "attempt")


def q_msg_dead_letter(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    _, dead = messages.redeliver(m, _failures(m), max_attempts=1)
    return dead.select("msg_id", "partition", "offset", "attempt")


def _times(spark, sf_dir):
    t = fixtures.times(Tables(spark, sf_dir))
    return t.withColumn("ts", timefmt.parse_ntz(F.col("t")))


def q_time_normalize(spark, sf_dir):
    t = _times(spark, sf_dir).where(F.col("ts").isNotNull())
    return t.select("event_id", timefmt.epoch_millis(F.col("ts")).alias("epoch_ms"), timefmt.stamp14(F.col("ts")).alias("stamp"))


def q_time_rejects(spark, sf_dir):
    return _times(spark, sf_dir).where(F.col("ts").isNull()).select("event_id", "t")


LENIENT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def q_time_lenient(spark, sf_dir):
    """Fields that run over roll into the next ones; the result is written in a given format."""
    t = fixtures.lenient_times(Tables(spark, sf_dir)).withColumn("ts", timefmt.lenient_ntz(F.col("t"), LENIENT_FORMAT))
    return t.select("event_id", timefmt.epoch_millis(F.col("ts")).alias("epoch_ms"), timefmt.formatted(F.col("ts"), "dd.MM.yyyy HH:mm").alias("text"))


def q_write_metrics(spark, sf_dir):
    """K9 + P6: per recall write (uid, items, request id = ingest ms, latency to a given sink time)."""
    songs, wf = _waterfall(spark, sf_dir)
    recs = recall.merge_recalls(wf, songs)
    per_event = recs.groupBy("event_id", "uid").agg(F.count(F.lit(1)).alias("n_items"))
    log = fixtures.log(Tables(spark, sf_dir)).select("event_id", "ts")
    sink = timefmt.epoch_millis(fixtures.ntz(METRICS_SINK_TIME))
    j = per_event.join(log, "event_id")
    return j.select(
        "event_id",
        "uid",
        "n_items",
        timefmt.request_id(F.col("ts")).alias("request_id"),
        (sink - timefmt.epoch_millis(F.col("ts"))).alias("latency_ms"),
    )


def q_raw_records(spark, sf_dir):
    """S2 + P6: log records as queue records of bytes -> untouched payload, shown in hex, with its request id."""
    log = fixtures.log(Tables(spark, sf_dir))
    rec = log.select(F.col("value").cast("binary").alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    raw = raw_messages(rec)
    return raw.select(F.hex("bytes").alias("bytes_hex"), "request_id", "partition", "offset")


def q_record_rejects(spark, sf_dir):
    """S2 -> P1-P3 over payload bytes: every 41st record holds a byte that is no text."""
    log = fixtures.log(Tables(spark, sf_dir))
    value = F.col("value").cast("binary")
    value = F.when(F.col("event_id") % 41 == 0, F.concat(value, F.unhex(F.lit("FF")))).otherwise(value)
    ok, bad = parse.split(parse.parse_log(log.select("event_id", value.alias("value"))))
    _, worse = parse.split(parse.parse_songs(ok, keep=["event_id"]))
    return bad.select("event_id", "reason").unionByName(worse.select("event_id", "reason"))


def q_label_scan(spark, sf_dir):
    """Every CELEBRITY node."""
    return graph.label_scan(fixtures.nodes(Tables(spark, sf_dir)), "CELEBRITY")


def q_collection_scan(spark, sf_dir):
    """The labels table exported as a JSON document collection, then fully scanned."""
    path = scratch_path(spark, "collection")
    Tables(spark, sf_dir).labels.write.mode("overwrite").json(path)
    return collection_scan(spark, path, "json", "doc_id bigint, quality int, toxic int")


QUERIES = {
    "raw_records": q_raw_records,
    "record_rejects": q_record_rejects,
    "label_scan": q_label_scan,
    "collection_scan": q_collection_scan,
    "title_newest": q_title_newest,
    "title_relevance": q_title_relevance,
    "title_num_found": q_title_num_found,
    "channel_ids": q_channel_ids,
    "channel_decode": q_channel_decode,
    "channel_decode_rejects": q_channel_decode_rejects,
    "channel_topk": q_channel_topk,
    "offset_range": q_offset_range,
    "offset_for_time": q_offset_for_time,
    "tag_subscribe": q_tag_subscribe,
    "msg_dedup": q_msg_dedup,
    "msg_redeliver": q_msg_redeliver,
    "msg_dead_letter": q_msg_dead_letter,
    "time_normalize": q_time_normalize,
    "time_rejects": q_time_rejects,
    "time_lenient": q_time_lenient,
    "write_metrics": q_write_metrics,
}
