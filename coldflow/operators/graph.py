"""Interest-graph jobs over node and edge tables.

The graph is two DataFrames: ``nodes(id, label, uid, name)`` and
``edges(src, dst, type, frequency, last_time BIGINT yyyyMMddHHmmss)``.
Pattern matches become equi-joins; "undirected" steps are the union of
both edge directions.  All users are answered in one job instead of one
round trip per user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from coldflow.operators.indexing import dense_index
from coldflow.operators.match import hot_keys, join_split

# Fixed values of the reference: names kept per user, edge age limit in days.
LIKE_ITEM_LIMIT = 50
EDGE_AGE_DAYS = 30


def users(nodes: DataFrame) -> DataFrame:
    """S8/S9 for USER: (id, uid) of user nodes with a uid."""
    return nodes.where((F.col("label") == "USER") & F.col("uid").isNotNull()).select("id", "uid")


def label_scan(nodes: DataFrame, label: str) -> DataFrame:
    """All nodes of a label."""
    return nodes.where(F.col("label") == label)


def all_uids(nodes: DataFrame) -> DataFrame:
    """Distinct non-null user ids."""
    return users(nodes).select("uid").distinct()


def undirected(edges: DataFrame, edge_type: str) -> DataFrame:
    """(a, b) for every edge of ``edge_type`` in both directions."""
    e = edges.where(F.col("type") == edge_type).select("src", "dst")
    both = F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")), F.struct(F.col("dst").alias("a"), F.col("src").alias("b")))
    return e.select(F.inline(both))  # one pass: edges may be costly to compute


def smallest_names(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """(key, name): the ``limit`` smallest distinct names of each key.

    ``dense_rank() <= limit`` gives equal names one rank, and Spark trims every map task to
    ``limit`` names a key before the shuffle, so no key's names ever meet in full.
    """
    w = Window.partitionBy(key).orderBy("name")
    return rows.select(key, "name").withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= F.lit(limit)).drop("_r").distinct()


HEAD = 3
# Names that the lists collected for one key may hold together; keys that may hold more are cut by ``smallest_names``.
LIST_NAMES = 200_000


def smallest_of(lists: Column, limit: int) -> Column:
    """The ``limit`` smallest distinct names of an array of arrays, sorted."""
    return F.slice(F.sort_array(F.array_distinct(F.flatten(lists))), 1, limit)


def name_lists(rows: DataFrame, key: str, limit: int, asked: DataFrame, stage) -> DataFrame:
    """(key, names): the ``limit`` smallest distinct names of each key in ``asked`` as a sorted array.

    A bounded heap a key keeps the smallest names, repeated ones too, so a key's names never
    meet in full.  Only an asked key whose full heap holds fewer than ``limit`` distinct names is
    looked at again, name by name.  Keys that are not asked may be among the result.
    """
    room = 2 * limit
    heaps = rows.groupBy(key).agg(InternalFunction.collect_top_k(F.col("name"), room, True).alias("_heap"))
    names = F.sort_array(F.array_distinct("_heap"))
    heaps = heaps.select(key, names.alias("names"), (F.size("_heap") < room).alias("_whole"))
    heaps = stage(heaps.select(key, F.slice("names", 1, limit).alias("names"), (F.col("_whole") | (F.size("names") >= limit)).alias("_sure")), f"{key}-names")
    found = heaps.where("_sure").drop("_sure")
    unsure = stage(heaps.where(~F.col("_sure")).select(key), f"{key}-unsure")
    if unsure.isEmpty():
        return found
    unsure = stage(asked.join(unsure, key).select(key).distinct(), f"{key}-unsure-asked")
    if unsure.isEmpty():
        return found
    again = smallest_names(rows.join(unsure, key, "left_semi"), key, limit)
    return found.unionByName(stage(again.groupBy(key).agg(F.sort_array(F.collect_list("name")).alias("names")), f"{key}-more-names"))


def liked_names(nodes: DataFrame, edges: DataFrame, limit: int = LIKE_ITEM_LIMIT, stage=None, lists: bool = False) -> DataFrame:
    """J8 + A3: (uid, name) - names of works a user LIKEs and of nodes ACTing with them.

    ``USER(uid) -[LIKE]- work -[ACT*0..1]- wc``, both steps undirected, the
    set of non-null names of ``work`` and ``wc``, at most ``limit`` names per
    user (first by name; the reference keeps arbitrary ones); ``limit`` None or
    negative keeps all.  With ``lists`` (uid, names): a user's names as one sorted array.

    The cut is by name, so it can be taken below the fan join: of a work's names only
    its ``limit`` smallest can be among a user's ``limit`` smallest.  They are kept
    as one sorted array per work.  Even those are not all paired with every fan:

    1. the first ``HEAD`` names of a user's works give a bound: once they hold
       ``limit`` distinct names, no larger name than the largest of these is kept;
    2. of the names behind the first ``HEAD``, each (fan, work) takes only those up to the fan's bound; pairs whose next
       name is larger do not meet the array again.

    Names stay in arrays until the end: a user's works meet once, with their first names and the next one, and give first
    names, bound and the works to ask again.  Users with so many works that these lists could hold more than
    ``LIST_NAMES`` names go name by name instead (``smallest_names``).
    Popular works are split by fan (``join_split``).  ``stage(df, name)`` materializes the
    tables that several steps read.
    """
    stage = stage or (lambda df, name: df)
    u = users(nodes).withColumnRenamed("id", "a")
    likes = u.join(undirected(edges, "LIKE"), "a").select("uid", F.col("b").alias("work"))
    names = nodes.select(F.col("id").alias("work"), "name")
    act = undirected(edges, "ACT").join(nodes.select(F.col("id").alias("b"), "name"), "b").select(
        F.col("a").alias("work"), "name"
    )
    work_names = names.unionByName(act).where(F.col("name").isNotNull())
    if limit is None or limit < 0:
        every = likes.distinct().join(work_names.distinct(), "work").select("uid", "name").distinct()
        return every.groupBy("uid").agg(F.sort_array(F.collect_list("name")).alias("names")) if lists else every
    likes = stage(likes, "likes")
    of_work = name_lists(work_names, "work", limit, likes, stage)
    hot = stage(hot_keys(likes, "work"), "hot-works")
    busy = stage(likes.groupBy("uid").count().where(F.col("count") * max(limit, HEAD) > LIST_NAMES).select("uid"), "busy-users")
    begin = of_work.select("work", F.slice("names", 1, HEAD).alias("head"), F.get("names", F.lit(HEAD)).alias("next"))
    heads = stage(join_split(likes, begin, "work", ["uid"], hot), "heads")
    rest = of_work.select("work", F.slice("names", F.lit(HEAD + 1), F.greatest(F.size("names") - HEAD, F.lit(0))).alias("names"))

    def bounded(first: DataFrame) -> DataFrame:
        return first.withColumn("bound", F.when(F.size("names") >= limit, F.element_at("names", -1)))

    def below(fans: DataFrame) -> DataFrame:
        kept = F.filter("names", lambda n: F.col("bound").isNull() | (n <= F.col("bound")))
        return join_split(fans, rest, "work", ["uid"], hot).select("uid", kept.alias("names"))

    def one_by_one(rows: DataFrame) -> DataFrame:
        return smallest_names(rows.select("uid", F.explode("names").alias("name")), "uid", limit)

    def collected(rows: DataFrame) -> DataFrame:
        return rows.groupBy("uid").agg(F.sort_array(F.collect_list("name")).alias("names"))

    open_ends = lambda next_name: next_name.isNotNull() & (F.col("bound").isNull() | (next_name <= F.col("bound")))
    met = heads.join(busy, "uid", "left_anti").groupBy("uid").agg(F.collect_list(F.struct("work", "head", "next")).alias("_w"))
    first = bounded(met.select("uid", "_w", smallest_of(F.col("_w.head"), limit).alias("names")))
    again = F.transform(F.filter("_w", lambda w: open_ends(w["next"])), lambda w: w["work"])
    first = stage(first.select("uid", "names", "bound", again.alias("again")), "first-names")
    pairs = below(first.select("uid", "bound", F.explode("again").alias("work")))
    few = first.select("uid", "names").unionByName(pairs).groupBy("uid").agg(smallest_of(F.collect_list("names"), limit).alias("names"))

    heads = heads.join(busy, "uid", "left_semi")
    first = bounded(collected(one_by_one(heads.withColumnRenamed("head", "names"))))
    pairs = below(heads.select("uid", "work", "next").join(first.select("uid", "bound"), "uid").where(open_ends(F.col("next"))).drop("next"))
    many = one_by_one(first.select("uid", "names").unionByName(pairs))
    if lists:
        return few.unionByName(collected(many))
    return few.select("uid", F.explode("names").alias("name")).unionByName(many)


def uid_file(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Per line the last whitespace-separated token, non-empty, distinct -> (uid)."""
    stripped = F.regexp_replace(F.col(value_col), r"\s+$", "")
    last = F.element_at(F.split(stripped, r"\s+", -1), -1)
    return lines.select(last.alias("uid")).where(F.col("uid").isNotNull() & (F.col("uid") != "")).distinct()


def export_lines(uids: DataFrame, liked: DataFrame) -> DataFrame:
    """K8: (uid, line) with ``line = "<uid>: a b c "`` (trailing blank kept; names sorted).

    ``liked`` holds (uid, name) or (uid, names), one sorted array a user.
    Users without names still get ``"<uid>: "``.  Names per user are capped
    upstream, so the per-user list is bounded.
    """
    per_user = liked if "names" in liked.columns else liked.groupBy("uid").agg(F.sort_array(F.collect_list("name")).alias("names"))
    j = uids.join(per_user, "uid", "left")
    items = F.array_join(F.transform(F.coalesce(F.col("names"), F.array().cast("array<string>")), lambda x: F.concat(x, F.lit(" "))), "")
    return j.select("uid", F.concat(F.col("uid"), F.lit(": "), items).alias("line"))


def write_export(lines: DataFrame, path: str) -> None:
    """K8: the lines as text files, one line per user."""
    lines.select("line").write.mode("overwrite").text(path)


def get_or_create(requested: DataFrame, nodes: DataFrame, label: str = "USER", id_prefix: str = "u:") -> DataFrame:
    """(uid, id, created) for requested uids; new nodes get the id ``prefix + uid``.

    Existing nodes are found by an equi-join on (label, uid); the rest are new.
    Deterministic ids make the job idempotent when rerun.
    """
    existing = nodes.where(F.col("label") == label).groupBy("uid").agg(F.min("id").alias("id"))
    req = requested.select("uid").where(F.col("uid").isNotNull()).distinct()
    j = req.join(existing, "uid", "left")
    return j.select(
        "uid",
        F.coalesce(F.col("id"), F.concat(F.lit(id_prefix), F.col("uid"))).alias("id"),
        F.col("id").isNull().alias("created"),
    )


def assign_celebrities(requested: DataFrame, nodes: DataFrame, now_stamp: int) -> DataFrame:
    """LIKE edges from each newly created user to a block of celebrities.

    c = #celebrities DIV #requested uids; the i-th new user (by uid) gets the
    celebrities with index [i*c, (i+1)*c) (by id).  Existing users get none
    and do not advance i.  c = 0 or no request -> no edges.  Both indexes are
    dense numberings computed without a single-partition window.
    """
    ids = get_or_create(requested, nodes)
    n_req = ids.count()
    celebs = label_scan(nodes, "CELEBRITY").select(F.col("id").alias("cid"))
    n_celeb = celebs.count()
    if n_req == 0 or n_celeb // n_req == 0:
        return _edge_frame(ids.sparkSession)
    c = n_celeb // n_req
    new_users = dense_index(ids.where("created").select("uid", "id"), ["uid"], out="i")
    cidx = dense_index(celebs, ["cid"], out="ci").withColumn("i", F.floor(F.col("ci") / F.lit(c)).cast("bigint"))
    e = new_users.join(cidx, "i")
    return e.select(
        F.col("id").alias("src"),
        F.col("cid").alias("dst"),
        F.lit("LIKE").alias("type"),
        F.lit(1).alias("frequency"),
        F.lit(now_stamp).cast("bigint").alias("last_time"),
    )


def _edge_frame(spark) -> DataFrame:
    return spark.createDataFrame([], "src string, dst string, type string, frequency int, last_time bigint")


def age_threshold(today: dt.date, days: int = EDGE_AGE_DAYS) -> int:
    """yyyyMMdd of (today - days) followed by 000000, as a number."""
    return int((today - dt.timedelta(days=days)).strftime("%Y%m%d") + "000000")


def expire_likes(nodes: DataFrame, edges: DataFrame, today: dt.date, days: int = EDGE_AGE_DAYS) -> DataFrame:
    """K7: outgoing LIKE edges of users with ``expired`` = last_time < threshold (strict; NULL time is kept)."""
    thr = age_threshold(today, days)
    u = label_scan(nodes, "USER").select(F.col("id").alias("src"))
    likes = edges.where(F.col("type") == "LIKE").join(u, "src")
    expired = F.coalesce(F.col("last_time") < F.lit(thr), F.lit(False))
    return likes.select("src", "dst", "frequency", "last_time", expired.alias("expired"))


def expire_users(nodes: DataFrame, edges: DataFrame, today: dt.date, days: int = EDGE_AGE_DAYS) -> tuple[DataFrame, DataFrame]:
    """(removed users, blocked users).

    A user with no kept outgoing LIKE is removed - including users that never
    had one.  If some other relationship still touches the node, a graph
    store would refuse the delete: such users are kept and reported as blocked.
    """
    u = label_scan(nodes, "USER").select("id", "uid")
    kept = expire_likes(nodes, edges, today, days).where(~F.col("expired")).select(F.col("src").alias("id")).distinct()
    candidates = u.join(kept, "id", "left_anti")
    other = edges.where(F.col("type") != "LIKE")
    # a LIKE that expires in this run no longer holds its end
    gone = expire_likes(nodes, edges, today, days).where("expired").select("src", "dst").distinct()
    incoming_like = edges.where(F.col("type") == "LIKE").join(gone, ["src", "dst"], "left_anti").select(F.col("dst").alias("id"))
    touching = (
        other.select(F.col("src").alias("id"))
        .unionByName(other.select(F.col("dst").alias("id")))
        .unionByName(incoming_like)
        .distinct()
    )
    blocked = candidates.join(touching, "id", "left_semi")
    removed = candidates.join(touching, "id", "left_anti")
    return removed, blocked


def merge_interests(stored: DataFrame, batch: DataFrame, rule: str = "as_written") -> DataFrame:
    """Merge a batch of (uid, word, frequency, last_time) into stored interest edges.

    ``as_written`` (the reference's dormant code): an existing edge whose
    stored time is later than the batch time adds the batch frequency and
    keeps its time; otherwise it is unchanged.  ``newer_wins``: frequencies
    add up and the later time wins.  Pairs only in the batch are created.
    Returns (uid, word, frequency, last_time, action).
    """
    s = stored.select("uid", "word", F.col("frequency").alias("sf"), F.col("last_time").alias("st"))
    b = batch.select("uid", "word", F.col("frequency").alias("bf"), F.col("last_time").alias("bt"))
    j = s.join(b, ["uid", "word"], "full_outer")
    both = F.col("sf").isNotNull() & F.col("bf").isNotNull()
    if rule == "as_written":
        upd = both & (F.col("st") > F.col("bt"))
        freq = F.when(upd, F.col("sf") + F.col("bf")).when(F.col("sf").isNotNull(), F.col("sf")).otherwise(F.col("bf"))
        time = F.coalesce(F.col("st"), F.col("bt"))
    elif rule == "newer_wins":
        upd = both
        freq = F.coalesce(F.col("sf"), F.lit(0)) + F.coalesce(F.col("bf"), F.lit(0))
        time = F.greatest(F.col("st"), F.col("bt"))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    action = (
        F.when(F.col("sf").isNull(), F.lit("created"))
        .when(upd, F.lit("updated"))
        .when(F.col("bf").isNull(), F.lit("untouched"))
        .otherwise(F.lit("unchanged"))
    )
    return j.select("uid", "word", freq.cast("int").alias("frequency"), time.alias("last_time"), action.alias("action"))


def stamp(ts: Column) -> Column:
    """yyyyMMddHHmmss of a timestamp as BIGINT."""
    return F.date_format(ts, "yyyyMMddHHmmss").cast("bigint")
