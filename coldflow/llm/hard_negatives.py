"""Hard-negative mining (13): exact integer inner products by Kronecker packing.

Every anchor is scored against every other row, in blocks.  Components become
integers, and the components of several candidates are packed into one number:
biased so that none is negative, candidate j's component is shifted by
j * width bits.  One multiplication by the anchor's (biased) component then
multiplies all of them, and the sum over the dimensions holds the candidates'
sums side by side: a field never overflows into the next one, because
``width`` bits hold the largest possible sum.  The fields are cut out and the
bias, which depends on the two component sums alone, is taken off again.

``width`` follows the largest component and the dimensions.  While at least
one field fits into the 53 bits that a double holds exactly, the packed integers
are doubles and BLAS does the multiplications; beyond, they are Python integers of
``WIDE_FIELDS`` fields.  Both are exact.

1. Valid rows are packed into cells, anchors into groups, of bounded rows each;
   every pair (group, cell) is one unit of work.
2. Positives: the best rows of the anchor's label in each cell, then over all.
3. Negatives: each cell's best rows of other labels inside the window that every
   positive's score opens, then over all.

Scale: the work is (anchors x rows), as asked, spread evenly over the pairs; no
row is dealt by a value, so a hot label, vector or id falls into no common task.
A pair gives at most a few rows for each anchor.  Cells and groups grow with the table
(up to ``MAX_CELL`` and ``MAX_GROUP`` rows), so that blocks are copied less often.

Defined cases: rows with a null vec_id, label or vector, or a null or
non-finite component take no part; a shorter vector counts as filled up with zeros;
rows with the anchor's vec_id are the anchor itself, otherwise rows that repeat a vec_id
count each; a repeated anchor row has its results again; scaled components beyond
64 bits stop at the largest 64-bit number, and so do scores; a window without rows gives none; an empty table
gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldflow.session import stage_table

SCALE = 256
MIN_CELL, MAX_CELL = 4096, 32_768
MIN_GROUP, MAX_GROUP = 2048, 8192
CELLS = 256
STEP_SCORES = 1 << 20  # scores held at once
DOUBLE_BITS = 53
WIDE_FIELDS = 64
LONG = (-(1 << 63), (1 << 63) - 1)

_BLOCK = "number long, ids binary, labels binary, components binary"


class Packed:
    """Candidates packed for exact inner products with anchors of the same dimensions; all components within +-bound."""

    def __init__(self, candidates: np.ndarray, bound: int):
        self.n, self.dims = candidates.shape
        self.bound = bound
        self.width = max(1, (self.dims * 4 * bound * bound).bit_length())
        fits = DOUBLE_BITS // self.width
        self.kind, self.whole, self.fields = (np.float64, np.int64, fits) if fits else (object, object, WIDE_FIELDS)
        self.sums = candidates.sum(axis=1, dtype=self.whole)
        biased = np.zeros((-(-self.n // self.fields) * self.fields, self.dims), self.kind)
        biased[: self.n] = candidates.astype(self.kind) + bound
        by_field = biased.reshape(self.fields, -1, self.dims)  # candidate j * rows + r is field j of packed number r
        self.numbers = sum(by_field[j] * (1 << (j * self.width)) for j in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors x candidates) inner products; int64, or Python integers where those could not hold them."""
        total = ((anchors.astype(self.kind) + self.bound) @ self.numbers.T).astype(self.whole)
        mask = (1 << self.width) - 1
        out = np.concatenate([(total >> (j * self.width)) & mask for j in range(self.fields)], axis=1)[:, : self.n]
        own = anchors.sum(axis=1, dtype=self.whole)
        return out - self.bound * self.sums[None, :] - self.bound * own[:, None] - self.dims * self.bound * self.bound


def _pack(dims: int, kind: str):
    """One row for the rows of a partition: ids ascending, labels, components filled up with zeros."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows = [], [], []
        for b in batches:
            ids.append(b.column("vec_id").to_numpy())
            labels.append(b.column("label").to_numpy())
            vectors = b.column("x")
            size = vectors.value_lengths().to_numpy()
            x = np.zeros((len(size), dims), kind)
            x[np.arange(dims) < size[:, None]] = vectors.flatten().to_numpy()
            rows.append(x)
        if sum(map(len, ids)):
            all_ids = np.concatenate(ids)
            order = np.argsort(all_ids, kind="stable")
            out = {"number": [TaskContext.get().partitionId()], "ids": [all_ids[order].astype("<i8").tobytes()], "labels": [np.concatenate(labels)[order].astype("<i8").tobytes()], "components": [np.concatenate(rows)[order].tobytes()]}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("number", pa.int64()), *((k, pa.binary()) for k in ("ids", "labels", "components"))]))

    return pack


def _block(table: pa.Table, dims: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, x = (table.column(k)[0].as_py() for k in ("ids", "labels", "components"))
    return np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), np.frombuffer(x, kind).reshape(-1, dims)


def best(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the k highest wanted scores of each row, ties to the smaller column; rows may have fewer."""
    n = scores.shape[1]
    if scores.dtype == object or n * int(np.abs(scores).max(initial=0)) >= 1 << 62:
        row, col = np.nonzero(wanted)
        order = sorted(range(len(row)), key=lambda i: (row[i], -scores[row[i], col[i]], col[i]))
        row, col = row[order], col[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        return row[keep], col[keep]
    key = np.where(wanted, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
    top = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    row = np.repeat(np.arange(len(key)), top.shape[1])
    col = top.ravel()
    keep = wanted[row, col]
    return row[keep], col[keep]


def _clipped(x: np.ndarray) -> pa.Array:
    return pa.array([min(max(int(v), LONG[0]), LONG[1]) for v in x] if x.dtype == object else x, pa.int64())


def _cell_rows(dims: int, kind: str, bound: int, pick, columns: list[str]):
    """Applies ``pick`` to slices of a group's anchors against one cell."""

    def rows(group: pa.Table, cell: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in columns]
        if group.num_rows and cell.num_rows:
            ids, labels, x = _block(cell, dims, kind)
            packed = Packed(x, bound)
            anchor_ids, anchor_labels, a = _block(group, dims, kind)
            step = max(1, STEP_SCORES // len(ids))
            for i in range(0, len(a), step):
                own = slice(i, i + step)
                same = anchor_labels[own, None] == labels[None, :]
                itself = anchor_ids[own, None] == ids[None, :]
                for part in pick(group, i, packed.scores(a[own]), same, itself, ids, anchor_ids[own]):
                    for k, v in enumerate(part):
                        out[k].append(v)
            group_no = group.column("number")[0].as_py()
            return pa.table([pa.array(np.full(sum(map(len, out[0])), group_no), pa.int64()), *(_clipped(np.concatenate(v)) if v else pa.array([], pa.int64()) for v in out)], names=["grp", *columns])
        return pa.table([pa.array([], pa.int64())] * (len(columns) + 1), names=["grp", *columns])

    return rows


def _positives(k: int):
    def pick(group, i, scores, same, itself, ids, anchor_ids):
        row, col = best(scores, same & ~itself, k)
        yield i + row, anchor_ids[row], ids[col], scores[row, col]

    return pick


def _negatives(k: int, low: int, high: int):
    def pick(group, i, scores, same, itself, ids, anchor_ids):
        """For every rank of positives at once: the window of each anchor's positive of that rank."""
        at, rank, of, value = (np.array(group.column(c)[0].as_py(), object if scores.dtype == object else np.int64) for c in ("at", "prank", "pid", "pscore"))
        mine = (at >= i) & (at < i + len(scores))
        for r in sorted(set(rank[mine].tolist())):
            now = mine & (rank == r)
            rows = (at[now] - i).astype(np.int64)
            score = value[now]
            own = scores[rows]
            wanted = ~same[rows] & ~itself[rows] & (low * score[:, None] <= 100 * own) & (100 * own <= high * score[:, None])
            row, col = best(own, wanted.astype(bool), k)
            yield at[now][row], anchor_ids[rows[row]], np.full(len(row), r), of[now][row], score[row], ids[col], own[row, col]

    return pick


def _paired(groups: DataFrame, cells: DataFrame, n_groups: int, n_cells: int):
    """Each group with each cell, dealt by the pair."""
    every = lambda n: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: k.cast("long")))
    left = groups.withColumn("cell", every(n_cells)).withColumn("pair", F.struct("number", "cell"))
    right = cells.withColumnRenamed("number", "cell").withColumn("number", every(n_groups)).withColumn("pair", F.struct("number", "cell"))
    return left.groupBy("pair").cogroup(right.groupBy("pair"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = SCALE) -> DataFrame:
    """Hard negatives of every anchor's positives.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition on vec_id.  An anchor's
    positives are its best ``positives`` other rows of its label.  For each, the best ``negatives`` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score are returned:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).
    """
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    finite = F.forall(F.col("embedding").cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.when(finite, x).alias("x"))
    rows = stage_table(rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL"), "negatives-rows")
    largest = F.max(F.greatest(F.abs(F.array_max("x").cast("decimal(20)")), F.abs(F.array_min("x").cast("decimal(20)"))))
    n, n_anchors, dims, bound = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("x")), largest).collect()[0]
    out = "grp long, at long, anchor_id long, prank long, pid long, pscore long, nid long, nscore long"
    if not n_anchors:
        return _named(rows.sparkSession.createDataFrame([], out).withColumn("rank", F.lit(0)))
    dims, bound = max(1, dims), max(1, int(bound or 0))
    kind = "<i4" if bound < 1 << 31 else "<i8"
    n_cells = -(-n // min(MAX_CELL, max(MIN_CELL, n // CELLS)))
    n_groups = -(-n_anchors // min(MAX_GROUP, max(MIN_GROUP, n_anchors // CELLS)))
    cells = stage_table(rows.repartition(n_cells).mapInArrow(_pack(dims, kind), _BLOCK), "negatives-cells")
    groups = stage_table(rows.where(is_anchor).repartition(n_groups).mapInArrow(_pack(dims, kind), _BLOCK), "negatives-anchors")

    first = ["at", "anchor_id", "pid", "pscore"]
    found = _paired(groups, cells, n_groups, n_cells).applyInArrow(_cell_rows(dims, kind, bound, _positives(positives), first), ", ".join(f"{c} long" for c in ["grp", *first]))
    w = Window.partitionBy("grp", "at").orderBy(F.col("pscore").desc(), "pid")
    found = found.withColumn("prank", F.row_number().over(w)).where(F.col("prank") <= positives)
    lists = stage_table(found.groupBy("grp").agg(*(F.collect_list(c).alias(c) for c in ("at", "prank", "pid", "pscore"))), "negatives-positives")  # a group has MAX_GROUP * positives entries at most

    told = groups.join(lists.withColumnRenamed("grp", "number"), "number")
    second = ["at", "anchor_id", "prank", "pid", "pscore", "nid", "nscore"]
    found = _paired(told, cells, n_groups, n_cells).applyInArrow(_cell_rows(dims, kind, bound, _negatives(negatives, low, high), second), out)
    w = Window.partitionBy("grp", "at", "prank").orderBy(F.col("nscore").desc(), "nid")
    return _named(found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives))


def _named(found: DataFrame) -> DataFrame:
    return found.select(
        "anchor_id", F.col("pid").alias("positive_id"), "rank", F.col("nid").alias("negative_id"), F.col("pscore").alias("positive_score"), F.col("nscore").alias("negative_score"), F.col("prank").cast("int").alias("positive_rank")
    )
