"""Mixing sources to target weights (2): min-cost flow over membership patterns, then seeded selection.

1. Documents are aggregated by membership pattern (the sorted set of sources
   they belong to) to one capacity per pattern.
2. A min-cost flow routes pattern capacity to source quotas.  The first epoch
   of a pattern costs 0 per unit, the second 1, the third 2, ...: convex
   repetition costs, so no pattern is repeated while another one that serves
   the same quota has unused documents.
3. Each pattern's flow is realised by whole documents: all of them
   ``floor(flow / size)`` times, and a seeded subset once more: first fit in md5
   order, that is, every document that fits into what its pattern still lacks when
   its turn comes.  So where the selection ends no document left fits.  It runs in rounds
   (``_first_fit``), each a prefix sum over the documents that fit.

The prefix sums run over (pattern, first three hex digits of the md5), so no
task ever holds a pattern: only the 4,096th part at the boundary is ordered
row by row.  A round is one aggregate and one pass over ids and sizes of the documents that still fit.  The flow runs on the driver on one number per pattern; more than
``MAX_PATTERNS`` patterns or sources fail loudly.

Defined cases: null source is a source of its own that sorts last; null and
empty texts have size 0 and are taken 0 words; a source whose documents hold
no word gets target 0; rows that repeat an id are one choice each (ties in
md5 order are broken by size); an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldflow.session import stage_table

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
MAX_PATTERNS = 20_000
FLOWS = pa.schema({"sources": pa.list_(pa.string()), "copies": pa.int64(), "rest": pa.int64(), "source_size": pa.int64(), "target": pa.float64()})


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess reshared by weight."""
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), total
    while free:
        share = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / share > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / share
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def min_cost_flow(capacity: Sequence[int], quota: Sequence[int], serves: Sequence[Sequence[int]], epochs: int) -> list[int]:
    """Units that each pattern sends: successive shortest paths on the bipartite graph.

    Pattern p may send ``capacity[p]`` units at cost e in epoch e (from 0 to
    ``epochs`` - 1) to the sources in ``serves[p]``; source s takes at most
    ``quota[s]``.  Augmenting along the cheapest path until none is left gives
    a maximum flow of least cost.
    """
    n_p = len(capacity)
    sent = [0] * n_p
    flow: list[dict[int, int]] = [{} for _ in capacity]
    got = [0] * len(quota)
    users: dict[int, set[int]] = {}
    while True:
        # cheapest pattern with room, by the epoch it is in; then a path of rerouted units to a source with room
        best: dict[int, tuple[int, int]] = {}  # source -> (cost, pattern it comes from)
        heap = [(sent[p] // capacity[p], p) for p in range(n_p) if capacity[p] and sent[p] < epochs * capacity[p]]
        heapq.heapify(heap)
        seen: set[int] = set()
        via: dict[int, int | None] = {p: None for _, p in heap}
        end = None
        while heap and end is None:
            cost, p = heapq.heappop(heap)
            if p in seen:
                continue
            seen.add(p)
            for s in serves[p]:
                if s in best:
                    continue
                best[s] = (cost, p)
                if got[s] < quota[s]:
                    end = s
                    break
                for other in users.get(s, ()):  # take units of s back from another pattern, which then sends them elsewhere
                    if other in seen or flow[other].get(s, 0) <= 0 or via.get(other) is not None:
                        continue
                    if other in via and sent[other] // capacity[other] <= cost:
                        continue  # its own fresh units are no dearer
                    via[other] = s
                    heapq.heappush(heap, (cost, other))
        if end is None:
            return sent
        path, s = [], end
        amount = quota[end] - got[end]
        while True:
            p = best[s][1]
            back = via[p]
            path.append((p, s, back))
            if back is None:
                amount = min(amount, capacity[p] - sent[p] % capacity[p])
                break
            amount = min(amount, flow[p][back])
            s = back
        for p, to, back in path:
            flow[p][to] = flow[p].get(to, 0) + amount
            users.setdefault(to, set()).add(p)
            if back is None:
                sent[p] += amount
            else:
                flow[p][back] -= amount
        got[end] += amount


def mix(docs: DataFrame, sizes: Column, sources: Column, weights: Sequence[int], share: float = 1.5, most: int = 2, id_column: str = "doc_id", seed: str = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """(the id, sources, size, source_size, target, copies, taken) for each row of ``docs``.

    ``sources`` is an array of source names (null elements allowed, sorted
    last); ``weights`` repeat over the sources in code-point order; together
    they share ``share`` times all sizes, none above ``most`` times its own.
    ``source_size`` and ``target`` are those of the first source.  ``carry`` names
    columns of ``docs`` that come with the result.  A null array is one without sources, of
    which nothing is taken.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    rows = stage_table(docs.select(F.col(id_column).alias("id"), *carry, F.coalesce(F.array_sort(F.array_distinct(sources)), F.array().cast("array<string>")).alias("sources"), sizes.alias("size"), key.alias("h"), F.monotonically_increasing_id().alias("row")), "mix-rows")
    per_pattern = rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(per_pattern) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = sorted(per_pattern, key=lambda r: [(s is None, s or "") for s in r["sources"]])
    names = sorted({s for r in patterns for s in r["sources"]}, key=lambda s: (s is None, s or ""))
    index = {s: i for i, s in enumerate(names)}
    source_size = [0] * len(names)
    for r in patterns:
        for s in r["sources"]:
            source_size[index[s]] += r["size"]
    target = targets(source_size, [weights[i % len(weights)] for i in range(len(names))], share * sum(r["size"] for r in patterns), most)
    sent = min_cost_flow([r["size"] for r in patterns], [int(t) for t in target], [[index[s] for s in r["sources"]] for r in patterns], most)
    plan = [(r["sources"], f // r["size"] if r["size"] else 0, f % r["size"] if r["size"] else 0, source_size[index[r["sources"][0]]] if r["sources"] else 0, target[index[r["sources"][0]]] if r["sources"] else 0.0) for r, f in zip(patterns, sent, strict=True)]
    return _select(spark, rows, plan, carry).withColumnRenamed("id", id_column)


def _same(a: str, b: str) -> Column:
    """Pattern equality that treats null elements as equal."""
    return F.col(a).eqNullSafe(F.col(b))


_ORDER = ("h", "size", "id", "row")


def _cuts(rows: DataFrame) -> DataFrame:
    """(sources, gap, used, edge_bin, last) for each pattern of ``rows``: how far its rows fit into ``gap`` together in md5 order.

    ``used`` is the sum of the rows before the first that does not fit, ``last`` the last of them in ``edge_bin``
    (null: none there); ``edge_bin`` is null where all rows fit.
    """
    by_bin = Window.partitionBy("sources").orderBy("bin")
    bins = rows.groupBy("sources", "gap", "bin").agg(F.sum("size").alias("n")).withColumn("before", F.sum("n").over(by_bin) - F.col("n"))
    bins = bins.withColumn("room", F.col("before") + F.col("n") <= F.col("gap"))
    edge = bins.where("NOT room AND before <= gap").select(F.col("sources").alias("edge_sources"), F.col("bin").alias("edge_bin"), "before")
    inside = (
        rows.join(F.broadcast(edge), _same("sources", "edge_sources") & (F.col("bin") == F.col("edge_bin")))  # one row per pattern at most
        .withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("sources").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)))
        .where("upto <= gap")
        .groupBy("sources")
        .agg(F.max(F.struct(*_ORDER)).alias("last"), F.max("upto").alias("upto"))
        .select(F.col("sources").alias("in_sources"), "last", "upto")
    )
    whole = bins.groupBy("sources", "gap").agg(F.coalesce(F.sum(F.when(F.col("room"), F.col("n"))), F.lit(0)).alias("whole"))
    cut = whole.join(edge, _same("sources", "edge_sources"), "left").join(inside, _same("sources", "in_sources"), "left")
    return cut.select("sources", "gap", F.coalesce("upto", "whole").alias("used"), "edge_bin", "last")


def _first_fit(rows: DataFrame) -> DataFrame:
    """Adds ``picked``: in md5 order, each document that fits into what its pattern still lacks.

    One round takes the documents that fit by their prefix sum, up to the first that does not fit behind the
    others.  That one and all larger ones stay out, as the room only shrinks, so
    the next round goes on behind it with those that fit into the room left, and with no others.
    """
    order = F.struct(*_ORDER)
    of_cut = _same("sources", "cut_sources")
    below = F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin")) | ((F.col("bin") == F.col("edge_bin")) & F.coalesce(order <= F.col("last"), F.lit(False)))
    fitting = rows.where("size > 0 AND size <= rest")
    left, first, later = fitting.select("sources", "bin", *_ORDER, F.col("rest").alias("gap")), None, []
    while not left.isEmpty():
        cuts = stage_table(_cuts(left), "mix-cuts")  # <= MAX_PATTERNS rows
        cut = F.broadcast(cuts.select(F.col("sources").alias("cut_sources"), (F.col("gap") - F.col("used")).alias("room"), "edge_bin", "last"))
        if first is None:
            first = cut
        else:  # all together less than one document a pattern
            later.append(left.join(cut, of_cut & below).select("row"))
        left = stage_table(left.join(cut, of_cut & ~below & (F.col("size") <= F.col("room"))).select("sources", "bin", *_ORDER, F.col("room").alias("gap")), "mix-left")
    if first is None:
        return rows.withColumn("picked", F.lit(False))
    rows = rows.join(first, of_cut, "left")
    rows = rows.withColumn("picked", F.col("cut_sources").isNotNull() & (F.col("size") > 0) & (F.col("size") <= F.col("rest")) & below)
    rows = rows.drop("cut_sources", "room", "edge_bin", "last")
    if not later:
        return rows
    more = stage_table(reduce(DataFrame.unionByName, later), "mix-more")
    n = more.count()
    more = more.withColumn("more", F.lit(True))
    rows = rows.join(F.broadcast(more) if n <= MAX_PATTERNS else more, "row", "left")
    return rows.withColumn("picked", F.col("picked") | F.col("more").isNotNull()).drop("more")


def _select(spark: SparkSession, rows: DataFrame, plan: list[tuple], carry: Sequence[str]) -> DataFrame:
    """Realise (pattern, whole copies, further words) with whole documents."""
    # <= MAX_PATTERNS rows; an Arrow table goes to the JVM as it is, a list of rows by a second set of Python workers
    columns = zip(*plan, strict=True) if plan else [[] for _ in FLOWS]
    flows = F.broadcast(spark.createDataFrame(pa.table([pa.array(list(c), t) for c, t in zip(columns, FLOWS.types, strict=True)], schema=FLOWS)))
    rows = rows.join(flows.withColumnRenamed("sources", "flow_sources"), _same("sources", "flow_sources")).drop("flow_sources")
    rows = _first_fit(stage_table(rows.withColumn("bin", F.substring("h", 1, 3)), "mix-flows"))
    copies = F.col("copies") + F.col("picked").cast("long")
    return rows.select("id", *carry, "sources", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
