"""Registered recall queries: log lines -> recall lists.

Each function takes (spark, sf_dir) and returns a lazy DataFrame.  The only
eager work is the posting store of the catalogue (once per state of its files),
the list of buckets that a match reads and the catalogue row count used by the
song recipe.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coldflow.operators import parse, recall
from coldflow.session import scratch_path, stage_table
from coldflow.sources import fixtures
from coldflow.sources.tables import Tables


def q_parse_log_kv(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ok, _ = parse.split(parse.parse_log(fixtures.log(t)))
    return ok.select("event_id", "uid", "audios")


def q_parse_rejects(spark, sf_dir):
    t = Tables(spark, sf_dir)
    recs = parse.parse_log(fixtures.log(t))
    ok, incomplete = parse.split(recs)
    _, bad = parse.split(parse.parse_songs(ok, keep=["event_id", "uid", "audios"]))
    return incomplete.select("event_id", "reason").unionByName(bad.select("event_id", "reason"))


def _songs(spark, sf_dir, mode="faithful"):
    t = Tables(spark, sf_dir)
    ok, _ = parse.split(parse.parse_log(fixtures.log(t)))
    good, _ = parse.split(parse.parse_songs(ok, keep=["event_id", "uid", "audios"]))
    return parse.with_singers(parse.song_rows(good), mode)


def q_songs_rows(spark, sf_dir):
    return _songs(spark, sf_dir).select("event_id", "pos", "song_name", "singer_text")


def q_singer_split(spark, sf_dir):
    base = _songs(spark, sf_dir).select("event_id", "pos", "singer_text")
    out = None
    for mode in ("faithful", "literal"):
        part = base.select(
            "event_id",
            "pos",
            F.lit(mode).alias("mode"),
            F.posexplode(parse.singer_list(F.col("singer_text"), mode)).alias("idx", "singer"),
        ).withColumn("idx", F.col("idx").cast("bigint"))
        out = part if out is None else out.unionByName(part)
    return out


def _waterfall(spark, sf_dir):
    """Songs and the waterfall, with the songs and hit tables written at their stage boundaries."""
    songs = stage_table(_songs(spark, sf_dir), "songs")
    t = Tables(spark, sf_dir)
    cat = recall.catalogue_snapshot(fixtures.ring(t), t.part, lambda n: scratch_path(spark, n))
    return songs, recall.waterfall(songs, cat, stage=stage_table)


def q_catalogue_refresh(spark, sf_dir):
    """Best name hits after the catalogue changed: base, then one delta that adds, renames and removes items."""
    t = Tables(spark, sf_dir)
    store = recall.build_store(fixtures.ring_base(t), scratch_path(spark, "catalogue"))
    recall.change_store(store, fixtures.ring_changes(t))
    songs = stage_table(_songs(spark, sf_dir), "songs")
    hits = recall.name_hits(songs, recall.open_catalogue(spark, store))
    return hits.select("event_id", "pos", "item_id", "fire", "score")


def q_match_name_top1(spark, sf_dir):
    _, wf = _waterfall(spark, sf_dir)
    return wf.name.select("event_id", "pos", "item_id", "fire", "score")


def q_match_singer_top5(spark, sf_dir):
    _, wf = _waterfall(spark, sf_dir)
    return wf.singer.select("event_id", "pos", "item_id", "fire", "score", F.col("rank").cast("bigint").alias("rank"))


def q_recall_waterfall(spark, sf_dir):
    _, wf = _waterfall(spark, sf_dir)
    return wf.outcomes().withColumn("rank", F.col("rank").cast("bigint"))


def q_recall_capped(spark, sf_dir, cap: int = 3):
    songs, wf = _waterfall(spark, sf_dir)
    return recall.merge_recalls(wf, songs, cap).withColumn("rank", F.col("rank").cast("bigint"))


def q_recall_zset(spark, sf_dir):
    songs, wf = _waterfall(spark, sf_dir)
    return recall.zset_rows(recall.merge_recalls(wf, songs)).drop("version")


def q_miss_report(spark, sf_dir):
    _, wf = _waterfall(spark, sf_dir)
    return wf.misses


def q_miss_counts(spark, sf_dir):
    _, wf = _waterfall(spark, sf_dir)
    return recall.miss_counts(wf.misses)


QUERIES = {
    "parse_log_kv": q_parse_log_kv,
    "parse_rejects": q_parse_rejects,
    "songs_rows": q_songs_rows,
    "singer_split": q_singer_split,
    "catalogue_refresh": q_catalogue_refresh,
    "match_name_top1": q_match_name_top1,
    "match_singer_top5": q_match_singer_top5,
    "recall_waterfall": q_recall_waterfall,
    "recall_capped": q_recall_capped,
    "recall_zset": q_recall_zset,
    "miss_report": q_miss_report,
    "miss_counts": q_miss_counts,
}
