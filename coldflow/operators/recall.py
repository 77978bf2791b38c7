"""Recall jobs: name -> singer waterfall (J2-J4), capped merge (A1, A2),
miss report (K10) and the per-user sorted-set view (K1).

The waterfall is a chain of left-anti joins: the singer stage only sees songs
that the name stage missed, and misses are what both stages left.  Each song
gets exactly one outcome.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coldflow.functions.text import RECALL_KEY_PREFIX
from coldflow.operators.match import TextIndex, build_index, hot_keys, join_split, match, materialize_index
from coldflow.operators.posting_store import CatalogueStore, FieldIndex
from coldflow.session import files_version

# Fixed values of the live job: hits per name query, per singer query, recall cap.
NAME_MATCH_SIZE = 1
SINGER_MATCH_SIZE = 5
RECALL_CAP = 200

SONG_KEY = ["event_id", "pos"]


@dataclass
class Catalogue:
    """Indexes over the catalogue's name and singer fields (payload: fire)."""

    name: TextIndex | FieldIndex
    singer: TextIndex | FieldIndex
    rejects: DataFrame | None = None  # catalogue rows without an integer fire


def split_catalogue(ring: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to index, rows rejected because they lack an integer fire; a removal needs none)."""
    bad = F.col("fire").isNull()
    if "deleted" in ring.columns:
        bad = bad & ~F.coalesce(F.col("deleted"), F.lit(False))
    return ring.where(~bad), ring.where(bad).withColumn("reason", F.lit("no_fire"))


def build_catalogue(ring: DataFrame, postings_per_task: int | None = None) -> Catalogue:
    """Index tables of ``ring(item_id, name, singer, fire)`` for one job; rows with NULL fire go to ``rejects``."""
    good, bad = split_catalogue(ring)
    kw = {} if postings_per_task is None else {"postings_per_task": postings_per_task}
    return Catalogue(
        build_index(good, "item_id", "name", payload=["fire"], **kw),
        build_index(good, "item_id", "singer", payload=["fire"], **kw),
        bad,
    )


def materialize_catalogue(cat: Catalogue, path: str) -> Catalogue:
    """Write both index tables under ``path`` and read them back: a fixed catalogue (a posting store can change)."""
    return Catalogue(materialize_index(cat.name, f"{path}/name"), materialize_index(cat.singer, f"{path}/singer"), cat.rejects)


def build_store(ring: DataFrame, path: str) -> CatalogueStore:
    """A posting store of ``ring`` at ``path``: the base version, or a full rebuild as the next one."""
    store = CatalogueStore(path)
    store.build(split_catalogue(ring)[0])
    return store


def change_store(store: CatalogueStore, changes: DataFrame) -> int:
    """The next catalogue version from ``changes(item_id, name, singer, fire, deleted)``; rows lacking fire change nothing."""
    return store.apply(split_catalogue(changes)[0])


def open_catalogue(spark: SparkSession, store: CatalogueStore, version: int | None = None) -> Catalogue:
    """The newest (or a given) version of a stored catalogue."""
    snap = store.snapshot(spark, version)
    return Catalogue(snap.field("name"), snap.field("singer"))


_STORES: dict[tuple[str, str], CatalogueStore] = {}


def catalogue_store(ring: DataFrame, source: DataFrame, path_for) -> CatalogueStore:
    """The posting store of ``ring``, written once per state of the files of ``source`` and reused by the application.

    ``path_for(name)`` gives a folder in shared storage.  New or changed files are a new state.
    """
    key = (ring.sparkSession.sparkContext.applicationId, files_version(source))
    if key not in _STORES:
        _STORES[key] = build_store(ring, path_for("catalogue"))
    return _STORES[key]


def catalogue_snapshot(ring: DataFrame, source: DataFrame, path_for) -> Catalogue:
    """The newest version of ``catalogue_store``."""
    return open_catalogue(ring.sparkSession, catalogue_store(ring, source, path_for))


def _text_hits(asked: DataFrame, index: TextIndex | FieldIndex, k: int, stage) -> DataFrame:
    """Hits of (event_id, pos, q): each distinct text is matched once and joined back, very frequent texts in shares of events."""
    stage = stage or (lambda df, name: df)
    texts = stage(asked.groupBy("q").agg(F.count(F.lit(1)).alias("_n")), "texts")
    best = match(texts.select("q"), "q", index, k, stage=stage)
    return join_split(asked, best, "q", SONG_KEY, hot_keys(texts, "q")).select(*SONG_KEY, "item_id", "fire", "score", "rank")


def name_hits(songs: DataFrame, cat: Catalogue, k: int = NAME_MATCH_SIZE, stage=None) -> DataFrame:
    """(event_id, pos, item_id, fire, score, rank) for songs with a non-empty name."""
    named = songs.where(F.col("song_name") != "").select(*SONG_KEY, F.col("song_name").alias("q"))
    return _text_hits(named, cat.name, k, stage and (lambda df, name: stage(df, f"name-{name}")))


def singer_hits(songs: DataFrame, named: DataFrame, cat: Catalogue, k: int = SINGER_MATCH_SIZE, stage=None) -> DataFrame:
    """First singer of every song without a name hit, top k."""
    rest = songs.join(named.select(*SONG_KEY).distinct(), SONG_KEY, "left_anti").select(*SONG_KEY, F.col("first_singer").alias("q"))
    return _text_hits(rest, cat.singer, k, stage and (lambda df, name: stage(df, f"singer-{name}")))


class Waterfall:
    """J2 -> J3 -> miss for a song table.

    Name misses: every song without a name hit (empty names included).
    Singer misses: songs that neither stage hit.  Each stage is built on
    first use; ``stage(df, name)`` materializes the hit tables that several
    branches read.
    """

    def __init__(self, songs: DataFrame, cat: Catalogue, name_k: int, singer_k: int, stage=None):
        self.songs, self.cat, self.name_k, self.singer_k = songs, cat, name_k, singer_k
        self._given = stage
        self._stage = stage or (lambda df, name: df)

    @cached_property
    def name(self) -> DataFrame:
        return self._stage(name_hits(self.songs, self.cat, self.name_k, self._given), "name-hits")

    @cached_property
    def singer(self) -> DataFrame:
        return self._stage(singer_hits(self.songs, self.name, self.cat, self.singer_k, self._given), "singer-hits")

    @cached_property
    def misses(self) -> DataFrame:
        """K10 rows (event_id, pos, kind, text)."""
        no_name = self.songs.join(self.name.select(*SONG_KEY).distinct(), SONG_KEY, "left_anti")
        name_miss = no_name.select(*SONG_KEY, F.lit("name").alias("kind"), F.col("song_name").alias("text"))
        singer_miss = no_name.join(self.singer.select(*SONG_KEY).distinct(), SONG_KEY, "left_anti").select(
            *SONG_KEY, F.lit("singer").alias("kind"), F.col("first_singer").alias("text")
        )
        return name_miss.unionByName(singer_miss)

    def outcomes(self) -> DataFrame:
        """One row per hit, or one ``miss`` row per song (event_id, pos, match_kind, item_id, fire, rank)."""
        n = self.name.select(*SONG_KEY, F.lit("name").alias("match_kind"), "item_id", "fire", "rank")
        s = self.singer.select(*SONG_KEY, F.lit("singer").alias("match_kind"), "item_id", "fire", "rank")
        m = self.misses.where(F.col("kind") == "singer").select(
            *SONG_KEY,
            F.lit("miss").alias("match_kind"),
            F.lit(None).cast("string").alias("item_id"),
            F.lit(None).cast("int").alias("fire"),
            F.lit(None).cast("int").alias("rank"),
        )
        return n.unionByName(s).unionByName(m)


def waterfall(
    songs: DataFrame,
    cat: Catalogue,
    name_k: int = NAME_MATCH_SIZE,
    singer_k: int = SINGER_MATCH_SIZE,
    stage=None,
) -> Waterfall:
    """J2 -> J3 -> miss, plus the K10 miss rows (stages built on first use)."""
    return Waterfall(songs, cat, name_k, singer_k, stage)


def merge_recalls(wf: Waterfall, songs: DataFrame, cap: int = RECALL_CAP) -> DataFrame:
    """A1 + A2: per event, distinct items, name hits before singer hits, capped.

    An item hit both ways counts as a name hit.  Order inside a priority is
    fire desc, item_id asc.  Events without any hit produce no rows.
    Returns (event_id, uid, item_id, fire, match_kind, rank).
    """
    ev = songs.select("event_id", "uid").distinct()
    hits = wf.name.select("event_id", "item_id", "fire", F.lit(0).alias("prio")).unionByName(
        wf.singer.select("event_id", "item_id", "fire", F.lit(1).alias("prio"))
    )
    # an event's hits are few, so all steps go by event: the rows are shuffled once
    per_item = hits.repartition("event_id").groupBy("event_id", "item_id").agg(F.min("prio").alias("prio"), F.max("fire").alias("fire"))
    w = Window.partitionBy("event_id").orderBy("prio", F.col("fire").desc(), "item_id")
    capped = per_item.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)
    return capped.join(ev, "event_id").select(
        "event_id",
        "uid",
        "item_id",
        "fire",
        F.when(F.col("prio") == 0, F.lit("name")).otherwise(F.lit("singer")).alias("match_kind"),
        "rank",
    )


def latest_per_user(recalls: DataFrame, version_col: str = "event_id") -> DataFrame:
    """Rows of each uid's newest event that has recalls (an event without hits hides nothing).

    Max version per uid is a partial aggregate, then an equi-join back on
    (uid, version): no window over a user's whole history, so one very active
    user does not become one task.
    """
    newest = recalls.groupBy("uid").agg(F.max(version_col).alias(version_col))
    return recalls.join(newest, ["uid", version_col])


def zset_rows(recalls: DataFrame, prefix: str = RECALL_KEY_PREFIX, version_col: str = "event_id") -> DataFrame:
    """K1 payload: (key, member, score DOUBLE, version) of each uid's newest recall list."""
    return latest_per_user(recalls, version_col).select(
        F.concat(F.lit(prefix), F.col("uid")).alias("key"),
        F.col("item_id").alias("member"),
        F.col("fire").cast("double").alias("score"),
        F.col(version_col).alias("version"),
    )


def miss_counts(misses: DataFrame) -> DataFrame:
    """K10 roll-up: (kind, text, n)."""
    return misses.groupBy("kind", "text").agg(F.count(F.lit(1)).alias("n"))
