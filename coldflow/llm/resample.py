"""Target-distribution importance resampling (12): array-scored weights, then a distributed LSD radix sort.

Features are the runs of 1 to 2 consecutive words of a text; a feature's bucket
is its crc32 modulo ``BUCKETS``.  A bucket's gain compares its share of the
target texts with its share of all documents; a document's weight is the mean
gain of its features, its score adds Gumbel noise drawn from a hash of its id,
so the best scores are a sample without replacement.

1. Two arrays of ``BUCKETS`` counts (documents, target) are added up per task
   and then by Spark; the driver turns them into one array of gains, and
   documents are scored by looking their buckets up in it.
2. Ranks come from stable counting-sort passes over the digits of the composite
   key (score descending, then doc_id), least significant digit first.  Records
   lie in packed blocks.  A pass counts each block's digits; a digit's first
   place is the number of records with smaller digits, a block's first place
   within it the number of that digit in earlier blocks.  So every record
   knows its place after the pass, is sent to the block that holds it, and
   the place after the last pass is its rank.

Scale: places are exact, so blocks after a pass are equally large whatever the
keys are (a third of all records with one key is spread like any other).  A
record crosses the network once a pass; there are as many passes as the key's
bits need (keys are taken relative to their smallest value).  To the driver
come the counts of ``BUCKETS`` buckets and, in each pass, of 2 ** DIGIT digits.

Defined cases: a null text has no words; a null doc_id is hashed as an empty
string and comes after all others among ties; rows that repeat another are
documents of their own, tied copies get consecutive ranks; only doc_id and text
are read, so other columns may have any name; empty tables count as no feature.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldflow.llm.text import LOWER, blocks, column_bytes, runs
from coldflow.session import stage_table

BUCKETS = 10_000
SEED = "7"
DIGIT = 12
MIN_BLOCK, MAX_BLOCK, BLOCKS = 1 << 14, 1 << 20, 256
STEP_BYTES = 8 << 20

KEEP = np.zeros(256, bool)
KEEP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

RECORD = np.dtype([("id", "<u8"), ("score", "<u8"), ("n_features", "<i8"), ("weight", "<i8"), ("null", "?")])

# ---------------------------------------------------------------------------
# crc32 of many spans at once
# ---------------------------------------------------------------------------
SHORT = 48  # longer words go through zlib
_TABLE = np.zeros(256, np.uint32)
for _b in range(256):
    _c = _b
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _TABLE[_b] = _c


def _zero_tables(n: int) -> np.ndarray:
    """[k, j, x]: the crc register that holds x in its byte j, after k zero bytes (the register is linear in x)."""
    out = np.zeros((n + 1, 4, 256), np.uint32)
    for j in range(4):
        out[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    for k in range(n):
        out[k + 1] = _TABLE[out[k] & np.uint32(255)] ^ (out[k] >> np.uint32(8))
    return out


_ZEROS = _zero_tables(SHORT).reshape(-1)


def _after_zeros(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(register), np.uint32)
    for j in range(4):
        out ^= _ZEROS[n * 1024 + (j * 256 + ((register >> np.uint32(8 * j)) & np.uint32(255)))]
    return out


def _registers(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc registers of short spans, begun at 0."""
    order = np.argsort(-size, kind="stable")
    begin = start[order]
    longer = len(size) - np.cumsum(np.bincount(size, minlength=SHORT + 1))  # [k]: spans of more than k bytes
    c = np.zeros(len(size), np.uint32)
    for k in range(SHORT):
        m = int(longer[k])
        if not m:
            break
        c[:m] = _TABLE[(c[:m] ^ data[begin[:m] + k]) & np.uint32(255)] ^ (c[:m] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = c
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(crc32 of every word, crc32 of every word, a blank and the next word of the same document); the latter at its first word's index, 0 elsewhere."""
    size = (end - start).astype(np.int64)
    short = size <= SHORT
    length = np.where(short, size, 0)
    begun = _registers(data, start, length)
    all_ones = np.full(len(size), 0xFFFFFFFF, np.uint32)
    one = ~(_after_zeros(all_ones, length) ^ begun)
    long = {int(k): data[start[k] : end[k]].tobytes() for k in np.flatnonzero(~short)}
    for k, word in long.items():
        one[k] = zlib.crc32(word)
    two = np.zeros(len(size), np.uint32)
    if len(size) > 1:
        register = ~one[:-1]
        register = _TABLE[(register ^ np.uint32(0x20)) & np.uint32(255)] ^ (register >> np.uint32(8))
        two[:-1] = ~(_after_zeros(register, length[1:]) ^ begun[1:])
        for k, word in long.items():
            if k:
                two[k - 1] = zlib.crc32(word, int(~register[k - 1]))
    return one, two


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all features, their documents, number of words of each document) of texts ``data[offsets[i]:offsets[i + 1]]``."""
    base = offsets[0]
    text = LOWER[data[base : offsets[-1]]]
    start, end = runs(text, offsets - base, KEEP)
    n_words = np.diff(np.searchsorted(start, offsets - base))
    doc = np.repeat(np.arange(len(n_words)), n_words)
    one, two = word_crcs(text, start, end, doc)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    return np.concatenate([one, two[pair]]) % np.uint32(BUCKETS), np.concatenate([doc, doc[pair]]), n_words


# ---------------------------------------------------------------------------
# Weights
# ---------------------------------------------------------------------------
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(2 * BUCKETS, np.int64)
    for b in batches:
        data, offsets = column_bytes(b.column("text"))
        side = np.array(b.column("side").to_pylist(), np.int64)
        for i, j in blocks(offsets, STEP_BYTES):
            bucket, doc, _ = features(data, offsets[i : j + 1])
            n += np.bincount(side[i + doc] * BUCKETS + bucket, minlength=2 * BUCKETS)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at // BUCKETS), pa.array(at % BUCKETS), pa.array(n[at])], ["side", "bucket", "n"])


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; ``docs`` and ``target`` have a text column."""
    texts = docs.select("text", F.lit(0).alias("side")).unionByName(target.select("text", F.lit(1).alias("side")))
    sums = texts.mapInArrow(_count, "side long, bucket long, n long").groupBy("side", "bucket").agg(F.sum("n").alias("n"))
    n = np.zeros((2, BUCKETS), np.int64)
    for r in sums.collect():  # 2 * BUCKETS rows at most
        n[r["side"], r["bucket"]] = r["n"]
    all_s, all_t = (float(x) + BUCKETS for x in n.sum(axis=1))
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in n.T.tolist()], np.int64)


def noise(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            drawn = np.array([noise(h) for h in b.column("h").to_pylist()], np.int64)
            for i, j in blocks(offsets, STEP_BYTES):
                bucket, doc, n_words = features(data, offsets[i : j + 1])
                n = np.bincount(doc, minlength=j - i)
                total = np.zeros(j - i, np.int64)
                np.add.at(total, doc, gain[bucket])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight, weight + drawn[i:j]))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return score


def scores(docs: DataFrame, target: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    doc_id = F.col("doc_id").cast("long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    gain = gains(docs.select(text), target.select(text))
    return docs.select(doc_id.alias("doc_id"), text, h.alias("h")).mapInArrow(_score(gain), "doc_id long, n_words long, n_features long, weight long, score long")


# ---------------------------------------------------------------------------
# Radix sort
# ---------------------------------------------------------------------------
def digit(records: np.ndarray, at: int, id_bits: int, width: int = DIGIT) -> np.ndarray:
    """Bits at, .., at + width - 1 of the composite key score * 2 ** id_bits + id."""
    out = np.zeros(len(records), np.uint64)
    if at < id_bits:
        out |= records["id"] >> np.uint64(at)
        if id_bits - at < width:
            out |= records["score"] << np.uint64(id_bits - at)
    else:
        out |= records["score"] >> np.uint64(at - id_bits)
    return (out & np.uint64((1 << width) - 1)).astype(np.int64)


def _to_blocks(size: int, first_id: int, null_id: int, top: int):
    """Rows into records whose id and score are differences from the smallest id and the highest score."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids = b.column("doc_id")
            r = np.zeros(b.num_rows, RECORD)
            r["null"] = np.asarray(ids.is_null())
            low = ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) - np.uint64(first_id % (1 << 64))
            r["id"] = np.where(r["null"], np.uint64(null_id), low)
            r["score"] = (top - b.column("score").to_numpy()).astype(np.uint64)
            for k in ("n_features", "weight"):
                r[k] = b.column(k).to_numpy()
            for k in range(0, len(r), size):
                yield pa.RecordBatch.from_pydict({"block": [number], "records": [r[k : k + size].tobytes()]}, schema=pa.schema([("block", pa.int64()), ("records", pa.binary())]))
                number += 1

    return pack


def _histogram(at: int, id_bits: int):
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, raw in zip(b.column("block").to_pylist(), b.column("records").to_pylist(), strict=True):
                n = np.bincount(digit(np.frombuffer(raw, RECORD), at, id_bits))
                d = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), number)), pa.array(d), pa.array(n[d])], ["block", "digit", "n"])

    return histogram


def _scatter(at: int, id_bits: int, first: np.ndarray, size: int):
    """Records with their places, cut by the block that they go to; ``first`` has each digit's first place."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, before in zip(b.column("records").to_pylist(), b.column("before").to_pylist(), strict=True):
                r = np.frombuffer(raw, RECORD)
                d = digit(r, at, id_bits)
                order = np.argsort(d, kind="stable")
                d = d[order]
                start = np.zeros(len(first), np.int64)
                for x in before:
                    start[x["digit"]] = first[x["digit"]] + x["before"]
                run = np.flatnonzero(np.diff(d, prepend=-1))
                local = np.arange(len(d)) - np.repeat(run, np.diff(np.append(run, len(d))))
                place = start[d] + local
                cut = np.flatnonzero(np.diff(place // size, prepend=-1))
                by_block: dict[int, list[tuple[int, int]]] = {}
                for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(d)], strict=True):
                    by_block.setdefault(int(place[a]) // size, []).append((a, z))
                moved = r[order]
                rows = {"block": list(by_block), "places": [], "records": []}
                for own in by_block.values():
                    rows["places"].append(b"".join((place[a:z] % size).astype("<u4").tobytes() for a, z in own))
                    rows["records"].append(b"".join(moved[a:z].tobytes() for a, z in own))
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("block", pa.int64()), ("places", pa.binary()), ("records", pa.binary())]))

    return scatter


def _gather(table: pa.Table) -> pa.Table:
    places = np.frombuffer(b"".join(table.column("places").to_pylist()), "<u4")
    out = np.empty(len(places), RECORD)
    out[places] = np.frombuffer(b"".join(table.column("records").to_pylist()), RECORD)
    return pa.table({"block": table.column("block")[:1], "records": pa.array([out.tobytes()], pa.binary())})


def _to_rows(size: int, first_id: int, top: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, raw in zip(b.column("block").to_pylist(), b.column("records").to_pylist(), strict=True):
                r = np.frombuffer(raw, RECORD)
                ids = pa.array((r["id"] + np.uint64(first_id % (1 << 64))).view(np.int64), mask=r["null"])
                rank = number * size + 1 + np.arange(len(r))
                yield pa.RecordBatch.from_arrays([ids, pa.array(r["n_features"]), pa.array(r["weight"]), pa.array(top - r["score"].astype(np.int64)), pa.array(rank)], ["doc_id", "n_features", "weight", "score", "rank"])

    return unpack


def ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """(rows with their rank by score descending and doc_id ascending, their number).

    ``rows`` (doc_id, n_features, weight, score) should be a staged table: it is read twice.
    """
    found = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id"), F.min("score"), F.max("score")).collect()[0]
    n, first_id, last_id, low, top = found
    if not n:
        return rows.withColumn("rank", F.lit(None).cast("long")), 0
    first_id, last_id = first_id or 0, last_id or 0
    size = min(MAX_BLOCK, max(MIN_BLOCK, n // BLOCKS))
    null_id = min(last_id - first_id + 1, (1 << 64) - 1)
    id_bits, bits = null_id.bit_length(), null_id.bit_length() + (top - low).bit_length()
    state = stage_table(rows.mapInArrow(_to_blocks(size, first_id, null_id, top), "block long, records binary"), "radix-0")
    for at in range(0, max(bits, 1), DIGIT):
        counts = stage_table(state.mapInArrow(_histogram(at, id_bits), "block long, digit long, n long"), "radix-counts")
        total = np.zeros(1 << DIGIT, np.int64)
        for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).collect():  # 2 ** DIGIT rows at most
            total[r["digit"]] = r["n"]
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select("block", F.struct("digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).alias("x"))
        before = before.groupBy("block").agg(F.collect_list("x").alias("before"))  # 2 ** DIGIT entries a block at most
        moved = state.join(before, "block").mapInArrow(_scatter(at, id_bits, np.cumsum(total) - total, size), "block long, places binary, records binary")
        state = stage_table(moved.groupBy("block").applyInArrow(_gather, "block long, records binary"), "radix-blocks")
    return state.mapInArrow(_to_rows(size, first_id, top), "doc_id long, n_features long, weight long, score long, rank long"), n


def resample(docs: DataFrame, target: DataFrame, min_words: int = 20, percent: int = 25, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): the documents with their rank in the draw, null for those not drawn.

    Of the N documents with at least ``min_words`` words, floor(percent * N / 100) are drawn.
    """
    scored = stage_table(scores(docs, target, seed), "resample-scores")
    out = ["doc_id", "n_features", "weight", "score"]
    order, n = ranked(scored.where(F.col("n_words") >= min_words).select(*out))
    drawn = order.select(*out, F.when(F.col("rank") <= percent * n // 100, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank")))
