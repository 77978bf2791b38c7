"""Versioned keyed tables: sorted sets, hashes, strings and wide-column cells.

A keyed store is kept as an append-only log of writes, one row per
(key, member/field, value) with a ``version`` that orders writes.  Read views
are computed, never updated in place:

* sorted set (K1 replace, K2 append): members whose latest write is not older
  than the key's last replace/delete barrier; with expiry (K5), not older than the
  beginning of the key's present life;
* hash (K3): the fields of each key's newest replace;
* string (K4, K5): newest write per key, alive while ``expires_at`` is in the
  future (a write without TTL clears the TTL);
* cells (K6): newest version per (row, family, qualifier).

Every view is "aggregate, then join the small aggregate back": per-member
(or per-cell) latest rows are partial aggregates (map-side combine), so a key
that holds a third of all writes is reduced to its distinct members before
any shuffle by key.  No window over a key's full history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldflow.session import stage_table

OP_REPLACE = "replace"
OP_PUT = "put"
OP_DELETE = "delete"

# The seven hash fields of a user configuration, in the
# reference's order; the first two are plain text, the others JSON text.
PROFILE_FIELDS = (
    "individual",
    "configName",
    "algorithmConfig",
    "historyConfig",
    "ctrConfig",
    "diversityConfig",
    "selectorConfig",
)


def zset_view(ops: DataFrame, key: str = "key", member: str = "member", score: str = "score") -> DataFrame:
    """(key, member, score, version) visible after applying ``ops`` in version order.

    ``ops`` has columns key, member, score, op in {replace, put, delete},
    version.  A replace at version R deletes the key's earlier members and
    adds its own rows (all rows of one replace share R); a put upserts one
    member; a delete is a barrier without members.
    """
    barrier = (
        ops.where(F.col("op").isin(OP_REPLACE, OP_DELETE))
        .groupBy(key)
        .agg(F.max("version").alias("_barrier"))
    )
    latest = (
        ops.where(F.col(member).isNotNull())
        .groupBy(key, member)
        .agg(F.max_by(F.col(score), F.col("version")).alias(score), F.max("version").alias("version"))
    )
    live = latest.join(barrier, key, "left").where(
        F.col("_barrier").isNull() | (F.col("version") >= F.col("_barrier"))
    )
    return live.drop("_barrier")


def zset_ttl_view(ops: DataFrame, now: Column | None = None, chunks: int | None = None, stage=stage_table) -> DataFrame:
    """K2 + K5: (key, member, score, expires_at) of sorted sets whose keys expire, as read at ``now``.

    ``ops(key, member, score, op, ttl, write_ts, version)``; the writes of a key are
    ordered by (write_ts, version).  A replace deletes the key first, a delete leaves nothing,
    a put upserts.  ttl > 0 lets the key expire that many seconds after the write; with ttl <= 0
    (or null) a put leaves the key's expiry as it is, a replace has none.  A
    key that expired before its next write starts again, empty and without expiry.

    What is visible depends on where the key's present life began: at its last replace or
    delete, or at the first write that found the key expired.  That is an ordered
    fold over the key's writes, done in two levels so that no key's history meets in
    one task:

    1. writes are range-partitioned into chunks of (key, write_ts, version).  Within a chunk,
       a write knows the last write before it that set or cleared the expiry (a *setter*);
       the first write at or after that expiry begins a new life.  The chunk's summary says what
       expiry it leaves, when its last life began, and up to what time it would let
       an expiry from outside run (its writes up to its first setter);
    2. the chunks' summaries (as many as a key has chunks) are folded the same way,
       which tells which chunk an outside expiry fell into; its first write at or after
       that time is looked up there.

    Members are partial aggregates (latest score per key and member), cut at the life's beginning.
    """
    at = F.struct("write_ts", "version")
    barrier = F.col("op").isin(OP_REPLACE, OP_DELETE)
    writes = ops.groupBy("key", "write_ts", "version").agg(F.max(barrier).alias("barrier"), F.max("ttl").alias("ttl"))
    n = chunks or int(ops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writes = stage(writes.repartitionByRange(n, "key", "write_ts", "version").withColumn("chunk", F.spark_partition_id()), "zset-writes")

    expiry = F.when(F.col("ttl") > 0, F.timestamp_add("SECOND", F.col("ttl"), F.col("write_ts")))
    w = Window.partitionBy("key", "chunk").orderBy("write_ts", "version")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    x = writes.withColumn("at", at).withColumn("setter", F.when(F.col("barrier") | (F.col("ttl") > 0), F.struct("at", expiry.alias("expiry"))))
    x = x.withColumn("prev", F.last("setter", ignorenulls=True).over(before))
    x = x.withColumn("late", F.coalesce(F.col("write_ts") >= F.col("prev.expiry"), F.lit(False)))
    x = x.withColumn("same", F.coalesce(F.lag("late").over(w) & (F.lag("prev.at").over(w) == F.col("prev.at")), F.lit(False)))
    x = x.withColumn("begins", F.col("late") & ~F.col("same"))
    chunk = x.groupBy("key", "chunk").agg(
        F.max("setter").alias("setter"),
        F.max(F.when(F.col("begins"), F.col("prev.at"))).alias("cut_of"),
        F.max(F.when(F.col("barrier") | F.col("begins"), F.col("at"))).alias("life"),
        F.max(F.when(F.col("prev").isNull(), F.col("write_ts"))).alias("open_until"),
    )
    left = F.when(F.col("cut_of") == F.col("setter.at"), F.lit(None)).otherwise(F.col("setter.expiry"))
    by_chunk = Window.partitionBy("key").orderBy("chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.withColumn("leaves", F.when(F.col("setter").isNotNull(), F.struct("chunk", left.alias("expiry"))))
    chunk = chunk.withColumn("prev", F.last("leaves", ignorenulls=True).over(earlier))
    chunk = chunk.withColumn("late", F.coalesce(F.col("open_until") >= F.col("prev.expiry"), F.lit(False)))
    same = F.coalesce(F.lag("late").over(by_chunk) & (F.lag("prev.chunk").over(by_chunk) == F.col("prev.chunk")), F.lit(False))
    chunk = chunk.withColumn("begins", F.col("late") & ~same)
    expires = F.when(F.col("leaves").isNotNull(), F.col("leaves.expiry")).when(~F.col("late"), F.col("prev.expiry"))
    chunk = stage(chunk.select("key", "chunk", "life", "begins", F.col("prev.expiry").alias("found"), expires.alias("expires_at")), "zset-chunks")

    fell = chunk.where("begins").select("key", "chunk", "found")
    first = writes.join(fell, ["key", "chunk"]).where(F.col("write_ts") >= F.col("found")).groupBy("key", "chunk").agg(F.min(at).alias("life"))
    lives = chunk.select("key", "life").unionByName(first.select("key", "life")).groupBy("key").agg(F.max("life").alias("life"))
    keys = chunk.groupBy("key").agg(F.max_by("expires_at", "chunk").alias("expires_at")).join(lives, "key")
    latest = ops.where(F.col("member").isNotNull()).groupBy("key", "member").agg(F.max_by("score", at).alias("score"), F.max(at).alias("_at"))
    seen = latest.join(keys, "key").where(F.col("life").isNull() | (F.col("_at") >= F.col("life")))
    if now is not None:
        seen = seen.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
    return seen.select("key", "member", "score", "expires_at")


def newest_write(ops: DataFrame, key: Sequence[str], version: str = "version") -> DataFrame:
    """Rows of each key's newest version (all rows sharing that version)."""
    key = list(key)
    newest = ops.groupBy(*key).agg(F.max(version).alias(version))
    return ops.join(newest, key + [version])


def newest_row(ops: DataFrame, key: Sequence[str], version: str = "version") -> DataFrame:
    """Each key's newest row, for writes of one row each: one ``max_by``, nothing is joined back."""
    rest = [c for c in ops.columns if c not in (*key, version)]
    best = ops.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"), F.max(version).alias(version))
    return best.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest], version)


def profile_fields(template: Column) -> Column:
    """ARRAY<STRUCT<field, value>> of the seven config fields of a JSON template.

    Nested objects keep their JSON text (``from_json`` to MAP<STRING,STRING>).
    """
    m = F.from_json(template, "map<string,string>")
    return F.array(
        *[F.struct(F.lit(f).alias("field"), F.try_element_at(m, F.lit(f)).alias("value")) for f in PROFILE_FIELDS]
    )


def hash_view(writes: DataFrame, now: Column | None = None) -> DataFrame:
    """K3 (+ K5): ``writes(key, field, value, version[, ttl, write_ts])``; every write replaces its key.

    A write deletes the key, sets its fields and expires the key only if its
    ttl > 0, so the newest write alone decides the expiry.  With ``now`` the
    view keeps keys alive at that time.
    """
    newest = newest_write(writes, ["key"])
    if now is None or "ttl" not in writes.columns:
        return newest.select("key", "field", "value", "version")
    exp = F.when(F.col("ttl") > 0, F.timestamp_add("SECOND", F.col("ttl"), F.col("write_ts")))
    alive = newest.withColumn("expires_at", exp).where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
    return alive.select("key", "field", "value", "version", "expires_at")


def kv_view(ops: DataFrame, now: Column) -> DataFrame:
    """K4 + K5: (key, value, expires_at) alive at ``now``.

    ``ops(key, value, ttl seconds, write_ts, version)``; ttl <= 0 means no
    expiry (and clears an earlier one, as a plain SET does).
    """
    last = ops.groupBy("key").agg(
        F.max_by(F.struct("value", "ttl", "write_ts"), F.col("version")).alias("w"),
    )
    exp = F.when(F.col("w.ttl") > 0, F.timestamp_add("SECOND", F.col("w.ttl"), F.col("w.write_ts")))
    view = last.select("key", F.col("w.value").alias("value"), exp.alias("expires_at"))
    return view.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


# ---------------------------------------------------------------------------
# Wide-column cells
# ---------------------------------------------------------------------------
def split_column(col: Column) -> tuple[Column, Column, Column]:
    """P10: ``family:qualifier`` -> (family, qualifier, reason).  Parts after a second ':' are dropped."""
    parts = F.split(col, ":", -1)
    reason = F.when(F.size(parts) < 2, F.lit("no_qualifier"))
    return F.get(parts, 0), F.get(parts, 1), reason


def cells_latest(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K6: newest version per (row_key, family, qualifier); malformed column names rejected."""
    fam, qual, reason = split_column(F.col("column"))
    c = cells.select("row_key", fam.alias("family"), qual.alias("qualifier"), "value", "version", reason.alias("reason"))
    bad = c.where(F.col("reason").isNotNull())
    good = c.where(F.col("reason").isNull()).drop("reason")
    return newest_cells(good), bad


def newest_cells(cells: DataFrame) -> DataFrame:
    """K6 over split columns: newest version per (row_key, family, qualifier)."""
    return cells.groupBy("row_key", "family", "qualifier").agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))


def row_lookup(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """All cells of each requested row (request row, family, qualifier, value); a missing row gives NULLs."""
    return requests.select("request_id", "row_key").join(latest, "row_key", "left")


def cell_lookup(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """Value of (row_key, family, qualifier) per request, NULL when missing."""
    return requests.join(latest.drop("version"), ["row_key", "family", "qualifier"], "left")


SALTS = 32


def row_uid(row_key: Column) -> Column:
    """Leading ``uid`` of a ``uid~algorithm~docid`` row key (the bucketing / join key)."""
    return F.split(row_key, "~", 2).getItem(0)


def prefix_newest(requests: DataFrame, latest: DataFrame, stage=None) -> tuple[DataFrame, DataFrame]:
    """A5: per request (uid, family, qualifier, limit) the full row keys in [uid~, uid~~).

    Only rows carrying the cell count.  With more rows than ``limit`` the
    top ``limit`` by numeric value (desc, then row key) are kept; limit 0 ->
    nothing, negative -> all.  Each request gets its own rows, told apart by
    ``limit``.  Values that are no number are rejected.

    The byte range is kept as a predicate (a row key whose next byte after
    ``uid~`` is '~' or above - e.g. any non-ASCII algorithm - is outside), and
    the derived uid is the equi-join key, so no scan over other users.
    ``stage(df, name)`` materializes the candidates, which three branches read.
    """
    stage = stage or (lambda df, name: df)
    key = ["uid", "family", "qualifier"]
    asked = requests.select(*key, "limit").distinct()
    cand = latest.select(row_uid(F.col("row_key")).alias("uid"), "row_key", "family", "qualifier", "value").join(
        asked.groupBy(*key).agg(F.max("limit").alias("top")), key
    )
    lo = F.concat(F.col("uid"), F.lit("~"))
    hi = F.concat(F.col("uid"), F.lit("~~"))
    cand = cand.where((F.col("row_key") >= lo) & (F.col("row_key") < hi))
    cand = stage(cand.withColumn("score", F.expr("try_cast(value AS DOUBLE)")), "prefix-candidates")
    rejects = cand.where(F.col("score").isNull()).drop("top").withColumn("reason", F.lit("not_a_number"))
    ok = cand.where(F.col("score").isNotNull())
    out = ["uid", "row_key", "score", "limit"]
    everything = ok.join(asked.where(F.col("limit") < 0), key).select(*out)
    # The best rows of each of SALTS shares of a key first, so no task ranks all rows of a user.
    newest = [F.col("score").desc(), F.col("row_key").asc()]
    share = Window.partitionBy(*key, "salt").orderBy(*newest)
    kept = ok.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS))).withColumn("rank", F.row_number().over(share))
    kept = kept.where(F.col("rank") <= F.col("top")).withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*newest)))
    ranked = kept.join(asked.where(F.col("limit") > 0), key).where(F.col("rank") <= F.col("limit"))
    return everything.unionByName(ranked.select(*out)), rejects
