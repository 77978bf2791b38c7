"""Which of a document's items does any other owner hold?  One packed shuffle, no task per item.

``shared_counts`` counts, for every set, its 64-bit items that a set of
another owner holds too.  Items of one Arrow batch (in slices of about BATCH_BYTES) are first combined: items
that two owners of the batch hold are counted there and leave the batch once,
without owners; only items with one owner in the batch leave with it.  So a
hot item reaches its bucket once per batch, however many sets hold it.

Buckets are ranges of the items' leading bits, their number grows with the
items.  Inside a bucket an item is its next 32 bits: two different items are
taken for one with probability of about bucket size / 2^32 per item.  Counts
are therefore upper bounds; callers use them to rule sets out only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_ITEMS = 1 << 21
MIN_BUCKETS = 64
BATCH_BYTES = 1 << 23
_PAYLOAD = "bucket int, owners binary, sets binary, items binary, at binary, known binary"


def bucket_bits(items: int) -> int:
    """log2 of the number of buckets for about ``items`` items."""
    return max(MIN_BUCKETS.bit_length() - 1, int(-(-items // BUCKET_ITEMS) - 1).bit_length())


def _planes(x: np.ndarray) -> bytes:
    """Byte planes of the differences of ascending 32-bit numbers, compressed."""
    return zstandard.compress(np.diff(x, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unplanes(raw: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(d, dtype=np.uint32)


def _payloads(sets: np.ndarray, owners: np.ndarray, items: np.ndarray, of: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows for one batch: set k (id ``sets[k]``, owner ``owners[k]``) holds the items at which ``of`` is k."""
    order = np.argsort(items, kind="stable")
    items, of = items[order], of[order]
    owner_no = np.unique(owners, return_inverse=True)[1]
    first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(items)))
    low, high = (np.minimum.reduceat(owner_no[of], first), np.maximum.reduceat(owner_no[of], first)) if len(first) else (first, first)
    several = low != high
    local = np.repeat(several, size)
    known = np.bincount(of[local], minlength=len(sets))
    # single-owner items: one entry per (set, item); several-owner items: one entry without a set
    gone = len(sets)
    keep = ~local
    keep[first[several]] = True
    at = np.where(local, gone, of)[keep].astype("<u4")
    items = items[keep]
    bucket = (items >> np.uint64(64 - bits)).astype(np.int64)
    rest = ((items << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    end = np.append(cut[1:], len(bucket))
    home = np.zeros(len(sets), bool)
    rows: dict[str, list] = {k: [] for k in ("bucket", "owners", "sets", "items", "at", "known")}
    for a, z in zip(cut.tolist(), end.tolist(), strict=True):
        used, local_at = np.unique(at[a:z], return_inverse=True)
        real = used[used < gone]
        told = real[(known[real] > 0) & ~home[real]]  # each set's local count travels with the first bucket it is in
        home[told] = True
        rows["bucket"].append(int(bucket[a]))
        rows["owners"].append(owners[real].astype("<i8").tobytes())
        rows["sets"].append(sets[real].astype("<i8").tobytes())
        rows["items"].append(_planes(rest[a:z]))
        rows["at"].append(zstandard.compress(local_at.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1))
        rows["known"].append(np.concatenate([sets[told], known[told]]).astype("<i8").tobytes())
    left = np.flatnonzero((known > 0) & ~home)
    if len(left):  # sets whose items are all local
        rows["bucket"].append(int(sets[left[0]]) & ((1 << bits) - 1))
        for k in ("owners", "sets"):
            rows[k].append(b"")
        rows["items"].append(_planes(np.zeros(0, np.uint32)))
        rows["at"].append(zstandard.compress(b"", 1))
        rows["known"].append(np.concatenate([sets[left], known[left]]).astype("<i8").tobytes())
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), *((k, pa.binary()) for k in ("owners", "sets", "items", "at", "known"))]))


def _bucket_counts(table: pa.Table) -> pa.Table:
    owners, sets, items, at, out_sets, out_counts, base = [], [], [], [], [], [], 0
    for r in table.to_pylist():
        o, s, i = np.frombuffer(r["owners"], "<i8"), np.frombuffer(r["sets"], "<i8"), _unplanes(r["items"])
        k = np.ascontiguousarray(np.frombuffer(zstandard.decompress(r["at"]), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        owners.append(o)
        sets.append(s)
        items.append(i)
        at.append(np.where(k < len(s), k + base, -1))  # -1: held by several owners already
        base += len(s)
        known = np.frombuffer(r["known"], "<i8").reshape(2, -1)
        out_sets.append(known[0])
        out_counts.append(known[1])
    owners, sets, items, at = (np.concatenate(x) for x in (owners, sets, items, at))
    order = np.argsort(items, kind="stable")
    items, at = items[order], at[order]
    if len(items):
        owner = np.where(at >= 0, np.unique(owners, return_inverse=True)[1][np.maximum(at, 0)] if len(owners) else 0, -1)
        first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
        several = (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)) | (np.minimum.reduceat(owner, first) < 0)
        hit = np.repeat(several, np.diff(np.append(first, len(items)))) & (at >= 0)
        found, count = np.unique(sets[at[hit]], return_counts=True)
        out_sets.append(found)
        out_counts.append(count)
    return pa.table({"set": pa.array(np.concatenate(out_sets), pa.int64()), "n": pa.array(np.concatenate(out_counts).astype(np.int64))})


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of about BATCH_BYTES, which bounds what a worker holds (a longer row is one slice)."""
    for b in batches:
        rows = max(1, b.num_rows * BATCH_BYTES // max(b.nbytes, 1))
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def shared_counts(df: DataFrame, parse: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], items: int) -> DataFrame:
    """(set, shared): how many of each set's items some other owner holds; sets without any are left out.

    ``parse`` turns an Arrow batch of ``df`` into (set ids, owner ids, items,
    index of each item's set); a set id must not occur twice in it and a
    set must not hold an item twice.  ``items`` is their approximate number.
    """
    bits = bucket_bits(items)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            sets, owners, values, of = parse(b)
            if len(sets):
                yield _payloads(sets, owners, values, of, bits)

    packed = df.mapInArrow(pack, _PAYLOAD)
    counts = packed.groupBy("bucket").applyInArrow(lambda table: _bucket_counts(table), "set long, n long")
    return counts.groupBy("set").agg(F.sum("n").alias("shared"))
