"""Approximate nearest neighbours (3): adaptive dimension scan inside inverted lists.

Largest inner product becomes smallest distance by one more dimension:
x' = (x, sqrt(M^2 - |x|^2)), q' = (q, 0) with M the largest norm, so
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x.  Vectors are rotated by one random
orthogonal matrix, lists are the cells of centroids fitted (k-means) on a
bounded sample, and every vector is in the list of its nearest centroid.

A query scans its nearest lists: as many as held ``RECALL`` of the true
neighbours of sampled queries within the sample, or ``probes`` if given, and
further ones until they hold k + 1 different vectors.  The nearest list goes first and gives the bound for all others.  In a list the rotated vectors
are scanned as column blocks of ``BLOCK_DIMS`` dimensions, for many queries at once.  After d of D
dimensions the partial distance scaled by D / d estimates the full one with
error about EPSILON / sqrt(d); a candidate is abandoned as soon as the
hypothesis "it is no farther than the query's current k-th best" is rejected,
that is, when partial > bound * d / D * (1 + EPSILON / sqrt(d))^2.  Survivors
are scored by the exact double-precision inner product of the original
vectors.

Hot groups: equal vectors are one class, both as candidates (only the k + 1
smallest ids of a class can be among k nearest) and as queries (a class is
searched once; each member drops itself).  Neighbouring lists form bundles of
about ``CELL_ROWS`` vectors: a query goes to a bundle once, with the numbers of
the lists it asks there.  Larger bundles are cut into cells of ``CELL_ROWS``,
the queries of a bundle into groups of ``QUERY_ROWS``.

Memory: a task holds one cell and one group, distances of ``PAIRS`` (query,
vector) pairs or (vector, centroid) pairs, and output batches of ``BATCH_ROWS``,
whatever the number of lists, probes and rows.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part; of another length than the most frequent one fails
loudly; ties go to the smaller id; fewer than k candidates give all of them;
of rows that repeat an id with the same vector one counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from coldflow.session import stage_table

BLOCK_DIMS = 16
EPSILON = 2.1
SAMPLE_ROWS = 8192
CELL_ROWS = 4096
QUERY_ROWS = 4096
PAIRS = 1 << 17
BATCH_ROWS = 4096
LIST_ROWS = 512
MAX_LISTS = 16_384
RECALL = 0.97
TRIALS = 256


@dataclass(frozen=True)
class Index:
    """What is broadcast: rotation, centroids (rotated, augmented) and the largest norm; at most MAX_LISTS rows."""

    rotation: np.ndarray
    centroids: np.ndarray
    top: float
    probes: int = 1
    bundle: int = 1  # lists of a bundle

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Augmented and rotated vectors (float32)."""
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.top**2 - (x * x).sum(axis=1)))
        return (np.hstack([x, extra[:, None]]) @ self.rotation).astype(np.float32)

    def nearest_lists(self, placed: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest centroids of each row, nearest first."""
        step = max(1, PAIRS * 8 // len(self.centroids))
        square = (self.centroids**2).sum(axis=1)
        n = min(n, len(square))
        out = np.empty((len(placed), n), np.int32)
        for a in range(0, len(placed), step):
            d = square - 2 * placed[a : a + step] @ self.centroids.T
            at = np.argpartition(d, n - 1, axis=1)[:, :n] if n < d.shape[1] else np.tile(np.arange(n), (len(d), 1))
            out[a : a + step] = np.take_along_axis(at, np.take_along_axis(d, at, 1).argsort(axis=1, kind="stable"), 1)
        return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(ok)


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(cls, v, ids): equal vectors as one row with the k + 1 smallest ids, class id = the smallest."""
    key = vectors.withColumn("salt", F.pmod("vec_id", F.lit(16))).dropDuplicates(["vec_id", "v"])
    first = key.withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    return first.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids")).select(F.col("ids")[0].alias("cls"), "v", "ids")


def calibrated(index: Index, x: np.ndarray, placed: np.ndarray, k: int, recall: float = RECALL) -> int:
    """Fewest probes that find ``recall`` of the true k nearest within the sample, over its first TRIALS rows."""
    if len(x) < 2:
        return 1
    own = index.nearest_lists(placed, 1)[:, 0]
    rank = np.empty(len(index.centroids), np.int64)
    found = np.zeros(len(index.centroids), np.int64)
    asked = index.place(x[:TRIALS], query=True)
    order = index.nearest_lists(asked, len(index.centroids))
    for q in range(len(asked)):
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argpartition(-score, min(k, len(x) - 1) - 1)[: min(k, len(x) - 1)]
        rank[order[q]] = np.arange(len(rank))
        found += np.bincount(rank[own[near]], minlength=len(found))
    reached = np.cumsum(found) / found.sum()
    return int(np.searchsorted(reached, recall)) + 1


def fit(cls: DataFrame, k: int = 20, seed: int = 7, sample_rows: int = SAMPLE_ROWS, rounds: int = 8) -> Index | None:
    """Centroids of a bounded sample (``sample_rows`` classes with the smallest md5 of their id)."""
    n, top, dims, most = cls.select(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))), F.min(F.size("v")), F.max(F.size("v"))).first()
    if not n:
        return None
    if dims != most:
        raise ValueError(f"vectors of {dims} and {most} dimensions")
    sample = cls.orderBy(F.md5(F.col("cls").cast("string")), "cls").limit(sample_rows).select("cls", "v").toArrow()
    x = np.array(sample.column("v").to_pylist(), np.float64).reshape(-1, dims)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dims + 1, dims + 1)))[0]
    index = Index(rotation, np.zeros((1, dims + 1), np.float32), float(top))
    placed = index.place(x)
    lists = int(min(MAX_LISTS, max(1, n // LIST_ROWS), len(x)))
    centroids = placed[rng.permutation(len(x))[:lists]].copy()
    for _ in range(rounds):
        own = Index(rotation, centroids, top).nearest_lists(placed, 1)[:, 0]
        total = np.zeros_like(centroids, np.float64)
        np.add.at(total, own, placed)
        count = np.bincount(own, minlength=lists)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids).astype(np.float32)
    bundle = int(max(1, CELL_ROWS * lists // n))
    # neighbouring lists next to each other: those nearest to the same of a few centroids
    centroids = centroids[np.argsort(Index(rotation, centroids[: -(-lists // bundle)], top).nearest_lists(centroids, 1)[:, 0], kind="stable")]
    index = Index(rotation, centroids, float(top))
    return Index(rotation, centroids, float(top), calibrated(index, x, placed, k), bundle)


def scan(queries: np.ndarray, start: np.ndarray, rows: np.ndarray, originals: np.ndarray, query_originals: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adaptive scan of one list: (query positions, row positions, exact scores) of the survivors.

    ``start`` holds each query's squared-distance bound so far (inf if none), ``slack`` the rounding error of its
    distances.  Distances to all rows are summed block by block; once few pairs are left, only those go on.
    """
    dims = rows.shape[1]
    columns = [np.ascontiguousarray(rows[:, a : a + BLOCK_DIMS]) for a in range(0, dims, BLOCK_DIMS)]
    squares = [(c * c).sum(axis=1) for c in columns]
    step = max(1, PAIRS // len(rows))
    out = []
    for a in range(0, len(queries), step):
        asked, bound, extra = queries[a : a + step], start[a : a + step].copy(), slack[a : a + step]
        partial, alive, at = np.zeros((len(asked), len(rows)), np.float32), None, None
        for c, block in enumerate(columns):
            seen = min(dims, (c + 1) * BLOCK_DIMS)
            piece = np.ascontiguousarray(asked[:, c * BLOCK_DIMS : seen])
            if at is None:
                partial += np.maximum(squares[c] + (piece * piece).sum(axis=1)[:, None] - 2 * (piece @ block.T), 0)
            else:
                partial = partial + ((block[at[1]] - piece[at[0]]) ** 2).sum(axis=1)
            free = np.flatnonzero(~np.isfinite(bound))
            if c == 0 and len(rows) > k and len(free):
                # a first bound: exact distances of a few rows, those whose first block is nearest
                few = np.argpartition(partial[free], k - 1, axis=1)[:, :k]
                for q, near in zip(free, few, strict=True):
                    bound[q] = ((rows[near] - asked[q]) ** 2).sum(axis=1).max()
            part = (seen / dims) * (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-4
            limit = (bound * part + extra).astype(np.float32)
            if at is not None:
                keep = partial <= limit[at[0]]
                at, partial = (at[0][keep], at[1][keep]), partial[keep]
                continue
            keep = partial <= limit[:, None]
            alive = keep if alive is None else alive & keep
            if seen == dims or np.count_nonzero(alive) * 8 < alive.size:
                at = np.nonzero(alive)
                partial = partial[at]
        out.append((at[0] + a, at[1], np.einsum("ij,ij->i", originals[at[1]], query_originals[a + at[0]])))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def best_of(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` largest scores, of equal ones the smaller ids."""
    order = np.lexsort((ids, -score, query))
    new = np.flatnonzero(np.diff(query[order], prepend=-1))
    nth = np.arange(len(order)) - np.repeat(new, np.diff(new, append=len(order)))
    return order[nth < k]


def packed(x: np.ndarray) -> pa.Array:
    """Rows as binaries."""
    x = np.ascontiguousarray(x)
    width = x.itemsize * x.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])


def search(vectors: DataFrame, is_query, k: int = 20, probes: int | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query`` (a Column of vec_id) holds."""
    spark = vectors.sparkSession
    rows = stage_table(usable(vectors, id_column, vector_column), "ann-vectors")
    cls = stage_table(classes(rows, k), "ann-classes")
    index = fit(cls, k)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)

    probes = probes or index.probes
    # the bytes of a vector: as the column holds it, which is exact
    kind = np.float32 if isinstance(vectors.schema[vector_column].dataType.elementType, T.FloatType) else np.float64

    def slices(batches):
        for b in batches:
            for a in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(a, BATCH_ROWS)
                yield part.column("cls").to_numpy(), part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)

    def place_rows(batches):
        """Each vector's list."""
        ix = shared.value
        for cls, x in slices(batches):
            own = ix.nearest_lists(ix.place(x), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(own), pa.array(own // ix.bundle), packed(x.astype(kind))], ["cls", "list", "bundle", "v"])

    def place_queries(batches):
        """Each query's nearest list, and its ``probes`` nearest ones or more, until they hold k + 1 classes, by bundle."""
        ix = shared.value
        for cls, x in slices(batches):
            placed = ix.place(x, True)
            step = max(1, PAIRS // min(probes, len(held)))
            for a in range(0, len(x), step):
                lists = list(ix.nearest_lists(placed[a : a + step], probes))
                rows, bundles, first, numbers = [], [], [], []
                for i, own in enumerate(lists, a):
                    if held[own].sum() <= k:
                        order = ix.nearest_lists(placed[i : i + 1], len(held))[0]
                        own = order[: max(probes, int(np.searchsorted(np.cumsum(held[order]), k + 1)) + 1)]
                    later = np.sort(own[1:])
                    cuts = np.flatnonzero(np.diff(later // ix.bundle)) + 1
                    parts = [own[:1], *(np.split(later, cuts) if len(later) else [])]
                    rows += [i] * len(parts)
                    bundles += [int(p[0]) // ix.bundle for p in parts]
                    first += [True] + [False] * (len(parts) - 1)
                    numbers += [p.astype(np.int32).tobytes() for p in parts]
                for b in range(0, len(rows), BATCH_ROWS):
                    cut = slice(b, b + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(cls[rows[cut]]), pa.array(bundles[cut], pa.int32()), pa.array(first[cut]), pa.array(numbers[cut], pa.binary()), packed(x[rows[cut]].astype(kind))], ["cls", "bundle", "first", "lists", "v"])

    def one_cell(left, right):
        if not left.num_rows or not right.num_rows:
            return empty
        ix = shared.value
        vector = lambda t: np.frombuffer(b"".join(t.column("v").to_pylist()), kind).reshape(t.num_rows, -1).astype(np.float64)
        ids, asked_ids, own = left.column("cls").to_numpy(), right.column("cls").to_numpy(), left.column("list").to_numpy()
        x, qv = vector(left), vector(right)
        placed, asked = ix.place(x), ix.place(qv, True)
        reach = ix.top**2 + (qv * qv).sum(axis=1)
        bound = np.maximum(reach - 2 * right.column("floor").to_numpy(), 0)
        lists = [np.frombuffer(b, np.int32) for b in right.column("lists").to_pylist()]
        number, who = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(a) for a in lists])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for one in np.unique(own):
            at, qs = np.flatnonzero(own == one), who[number == one]
            if len(qs):
                q, r, score = scan(asked[qs], bound[qs], placed[at], x[at], qv[qs], k + 1, 4e-6 * reach[qs])
                found.append((qs[q], at[r], score))
        q, r, score = (np.concatenate(a) for a in zip(*found, strict=True))
        best = best_of(q, ids[r], score, k + 1)
        return pa.table({"query": asked_ids[q[best]], "cls": ids[r[best]], "score": score[best]}, schema=empty.schema)

    empty = pa.table({"query": pa.array([], pa.int64()), "cls": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    keys = ["bundle", "cell", "group"]
    indexed = stage_table(cls.select("cls", "v").mapInArrow(place_rows, "cls long, list int, bundle int, v binary"), "ann-index")
    members = stage_table(rows.where(is_query).select("vec_id", "v").join(cls.select("cls", "v"), "v").select(F.col("vec_id").alias("query_id"), "cls").distinct(), "ann-queries")
    held = np.zeros(len(index.centroids), np.int64)
    for r in indexed.groupBy("list").count().collect():  # <= MAX_LISTS rows
        held[r["list"]] = r["count"]
    # the work of a query grows with the lists, not with its bytes: as many tasks as the session shuffles to
    queries = cls.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", "v").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = stage_table(queries.mapInArrow(place_queries, "cls long, bundle int, first boolean, lists binary, v binary"), "ann-asked")
    cells = indexed.groupBy("bundle").count().select("bundle", F.ceil(F.col("count") / CELL_ROWS).alias("cells"))
    first_id = F.lit(0).cast("long")
    base = indexed.join(cells, "bundle").withColumn("cell", F.pmod(F.xxhash64("cls"), F.col("cells")))

    def scanned(part: DataFrame) -> DataFrame:
        """Hits of asked rows (with their floor, the (k + 1)-th best score known) in all cells of their bundles."""
        groups = part.groupBy("bundle").count().select("bundle", F.ceil(F.col("count") / QUERY_ROWS).alias("groups"))
        left = base.join(groups, "bundle").withColumn("group", F.explode(F.sequence(first_id, F.col("groups") - 1)))
        right = part.join(groups, "bundle").join(cells, "bundle").withColumn("group", F.pmod(F.xxhash64("cls"), F.col("groups"))).withColumn("cell", F.explode(F.sequence(first_id, F.col("cells") - 1)))
        return left.select(*keys, "cls", "list", "v").groupBy(*keys).cogroup(right.select(*keys, "cls", "lists", "v", "floor").groupBy(*keys)).applyInArrow(one_cell, "query long, cls long, score double")

    def kept(hits: DataFrame) -> DataFrame:
        return hits.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cls"))).where(F.col("r") <= k + 1)

    near = stage_table(kept(scanned(asked.where("first").withColumn("floor", F.lit(float("-inf"))))), "ann-near")
    floors = near.where(F.col("r") == k + 1).select(F.col("query").alias("cls"), F.col("score").alias("known"))
    others = asked.where("not first").join(floors, "cls", "left").withColumn("floor", F.coalesce("known", F.lit(float("-inf"))))
    hits = near.drop("r").unionByName(scanned(others))
    # k + 1 classes per query class are enough: each holds a member at least, the query's own class may hold itself only
    best = stage_table(kept(hits).drop("r"), "ann-hits")
    expanded = best.join(cls.select("cls", "ids"), "cls").select("query", F.explode("ids").alias("vec_id"), "score")
    top = expanded.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    top = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("near"))
    out = members.join(top, members["cls"] == top["query"]).withColumn("near", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k))
    return out.select("query_id", F.posexplode("near").alias("pos", "n")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.s")).alias("score"))
