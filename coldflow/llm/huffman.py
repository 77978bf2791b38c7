"""Token-ID output (8): canonical length-limited Huffman coding with block checkpoints.

Whole texts are encoded once (``encode_ids``, end id appended) into a staged
table, one row per document; each task adds a row with its own id counts, so
the code needs no second pass over the ids.  Counts are summed by id in
Spark; at most ``vocabulary size`` numbers reach the driver, where
package-merge gives code lengths of at most ``MAX_BITS``.

File format: a Parquet folder written by Spark's committing writer, in
ascending id order over its parts.  A part is one task's range of documents
(about ``PART_BYTES`` of ids, at most ``MAX_PARTS`` parts; beyond that parts grow, which
costs no memory: they are sorted by Spark and coded as they stream by).  Each
row is one independent block of whole documents (about ``BLOCK_IDS`` ids; a
longer document is a block of its own): ``part, block, doc_ids, counts, payload,
marks``.  ``payload`` holds the codes
in 16-bit big-endian words; ``marks`` the number of bits of every
``CHECKPOINT`` ids, from which each lane's bit offset follows.  The code
lengths themselves are one more file, ``code`` (id, length).

Decoding looks ``MAX_BITS`` bits up in one table, for all checkpoints of a
block in parallel; coding and decoding go through ``RUN_IDS`` ids at a time.

Defined cases: null and empty texts hold only the end id; repeated rows and
repeated ids each keep their own ids (ties in doc_id are ordered by the crc32 of the ids, and
may go to several parts); rows with null doc_id come first; an empty table gives empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldflow.llm.encode import BLOCK_BYTES, encoder
from coldflow.llm.text import blocks, column_bytes
from coldflow.llm.workers import cache
from coldflow.session import scratch_path

MAX_BITS = 20
BLOCK_IDS = 1 << 16
CHECKPOINT = 64
END_ID = 2
RUN_IDS = 1 << 20
PART_BYTES = 16 << 20
MAX_PARTS = 50_000


ENCODED = "doc_id long, tie long, nth long, n long, ids binary, seen array<int>, seen_n array<long>"


def encode_ids(docs: DataFrame, vocabulary: str, end_id: int = END_ID, id_column: str = "doc_id") -> DataFrame:
    """Ids of whole texts, end id last, and one row of id counts per task.

    A document's row has ``ids`` (little-endian, 16 bits each or 32 if the
    vocabulary needs them), their number ``n`` and crc32 ``tie``, and ``nth`` of its
    task; a task's last row has only ``seen`` and ``seen_n``.
    """

    def run(batches):
        enc = encoder(vocabulary)
        total = np.zeros(max(len(enc.id_bytes), end_id + 1), np.int64)
        nth = 0
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            for i, j in blocks(offsets, BLOCK_BYTES):
                ids, count = enc.block(data, offsets[i : j + 1])
                count = count + 1
                upto = np.cumsum(count)
                own = np.full(upto[-1], end_id, enc.dtype)
                kept = np.ones(len(own), bool)
                kept[upto - 1] = False
                own[kept] = ids
                total += np.bincount(own, minlength=len(total))
                at = np.concatenate([[0], upto])
                wide = own.astype("<u4", copy=False).data
                tie = [zlib.crc32(wide[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                none = pa.nulls(j - i, pa.list_(pa.int32())), pa.nulls(j - i, pa.list_(pa.int64()))
                packed = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((at * own.itemsize).astype(np.int32)), pa.py_buffer(own)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(tie, pa.int64()), pa.array(np.arange(nth, nth + j - i)), pa.array(count), packed, *none], names)
                nth += j - i
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.binary()), pa.array([seen.astype(np.int32)]), pa.array([total[seen]])], names)

    names = ["doc_id", "tie", "nth", "n", "ids", "seen", "seen_n"]
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ENCODED)


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, n) over all documents, from the tasks' own counts."""
    pairs = encoded.where("seen is not null").select(F.inline(F.arrays_zip("seen", "seen_n")))
    return pairs.groupBy(F.col("seen").cast("long").alias("id")).agg(F.sum("seen_n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``limit`` bits (package-merge); ``counts`` are positive."""
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.int64)
    # level by level: merge the coins with the packages of the level below; remember which merged items were packages
    merged, is_package = weight, [np.zeros(n, bool)]
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_package.append(rank >= n)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for kind in reversed(is_package):
        package = int(kind[:take].sum())
        lengths[: take - package] += 1  # the cheapest coins of this level
        take = 2 * package
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: shorter first, then by symbol."""
    code = np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    length = lengths[order]
    step = np.int64(1) << (length.max(initial=1) - length)
    first = np.concatenate([[0], np.cumsum(step)[:-1]]) if len(length) else np.zeros(0, np.int64)
    code[order] = first >> (length.max(initial=1) - length)
    return code


class Code:
    """Encoder and decoder of one canonical code (symbols ``ids`` ascending, their ``lengths``)."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids.astype(np.int64), lengths.astype(np.int64)
        self.bits = int(lengths.max(initial=1))
        codes = canonical(self.lengths)
        size = int(ids.max(initial=0)) + 1
        self.code_of, self.length_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = codes, self.lengths
        order = np.lexsort((self.ids, self.lengths))
        span = 1 << (self.bits - self.lengths[order])
        table = np.repeat(np.arange(len(order)), span)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.width = np.ones(1 << self.bits, np.uint8)
        self.symbol[: len(table)] = self.ids[order][table]
        self.width[: len(table)] = self.lengths[order][table]

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(payload, bits of each run of CHECKPOINT ids as uint16)."""
        payload, marks, bit, carry = [], [], 0, 0.0
        for i in range(0, len(ids), RUN_IDS):
            run = ids[i : i + RUN_IDS]
            length = self.length_of[run]
            end = bit + np.cumsum(length)
            start = end - length
            word, shift = start >> 4, 48 - (start & 15) - length
            value = self.code_of[run] << shift  # up to 35 of 48 bits, over three 16-bit words
            full = int(end[-1] >> 4)
            words = sum(np.bincount(word + k, (value >> (32 - 16 * k)) & 0xFFFF, full + 4) for k in range(3))
            words[0] += carry
            payload.append(words[:full].astype(">u2").tobytes())
            marks.append(np.add.reduceat(length, np.arange(0, len(run), CHECKPOINT)).astype("<u2").tobytes())
            bit, carry = int(end[-1] & 15), words[full]  # the last word may go on in the next run
        payload.append(np.array([carry, 0, 0, 0]).astype(">u2").tobytes())
        return b"".join(payload), b"".join(marks)

    def decode(self, payload: bytes, marks: bytes, n: int) -> np.ndarray:
        words = np.frombuffer(payload, ">u2")
        bits = np.frombuffer(marks, "<u2").astype(np.int64)
        begin = np.cumsum(bits) - bits
        out = np.zeros((len(begin), CHECKPOINT), np.uint32)
        mask = (1 << self.bits) - 1
        step = RUN_IDS // CHECKPOINT
        for i in range(0, len(begin), step):
            at = begin[i : i + step].copy()
            first = int(at[0] >> 4)
            last = int(at[-1] + bits[min(i + step, len(bits)) - 1] >> 4)
            own = np.concatenate([words[first : last + 3].astype(np.int64), np.zeros(3, np.int64)])
            at -= first << 4
            ids = min(step * CHECKPOINT, n - i * CHECKPOINT)
            for k in range(min(CHECKPOINT, ids)):
                lanes = len(at) if ids - (len(at) - 1) * CHECKPOINT > k else len(at) - 1
                pos = at[:lanes]
                w = pos >> 4
                look = ((own[w] << 32 | own[w + 1] << 16 | own[w + 2]) >> (48 - self.bits - (pos & 15))) & mask
                out[i : i + lanes, k] = self.symbol[look]
                at[:lanes] += self.width[look]
        return out.ravel()[:n]


def build_code(encoded: DataFrame) -> Code:
    """The code of all ids of a staged ``encode_ids`` table (at most one row per vocabulary id reaches the driver)."""
    rows = id_counts(encoded).orderBy("id").toArrow()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
    return Code(ids, code_lengths(n))


BLOCKS = "part int, block int, doc_ids array<long>, counts array<long>, payload binary, marks binary"


def coded_blocks(batches: Iterator[pa.RecordBatch], code: Code, part: int) -> Iterator[pa.RecordBatch]:
    """Block rows of documents that stream by in order; at most one block's ids are held."""
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # (doc ids, counts, ids) of the block to come
    size = block = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, size, block
        docs, counts = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
        payload, marks = code.encode(np.concatenate([h[2] for h in held]))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), x) for x in (docs, pa.array(counts, pa.int64()))]
        row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), *lists, pa.array([payload], pa.binary()), pa.array([marks], pa.binary())], ["part", "block", "doc_ids", "counts", "payload", "marks"])
        held, size, block = [], 0, block + 1
        return row

    for b in batches:
        if not b.num_rows:
            continue
        data, offsets = column_bytes(b.column("ids"))
        counts = b.column("n").to_numpy()
        width = int(offsets[1] - offsets[0]) // int(counts[0])
        ids = data[offsets[0] : offsets[-1]].view(f"<u{width}")
        upto = np.concatenate([[0], np.cumsum(counts)])
        i = 0
        while i < len(counts):
            j = int(np.searchsorted(upto, upto[i] + BLOCK_IDS - size, side="right")) - 1
            j = max(j, i + 1) if not held else max(j, i)
            if j > i:
                # copies, so that the block to come does not hold on to its batches
                held.append((b.column("doc_id").take(pa.array(np.arange(i, j))), counts[i:j].copy(), ids[upto[i] : upto[j]].copy()))
                size += int(upto[j] - upto[i])
            if j < len(counts):
                yield flush()
            i = j
    if held:
        yield flush()


def write(encoded: DataFrame, path: str, code: Code) -> None:
    """Write the block files (``path``/blocks) and the code (``path``/code)."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast((code.ids, code.lengths))  # at most one pair per vocabulary id

    def run(batches):
        yield from coded_blocks(batches, decoder(*shared.value), TaskContext.get().partitionId())

    rows = encoded.where("ids is not null").select("doc_id", "tie", "nth", "n", "ids")
    size = rows.agg(F.sum("n")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, min(MAX_PARTS, -(-2 * size // PART_BYTES)))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("nth")]
    out = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, BLOCKS)
    out.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame(pa.table({"id": code.ids, "length": code.lengths})).coalesce(1).write.mode("overwrite").parquet(f"{path}/code")


def decoder(ids: np.ndarray, lengths: np.ndarray) -> Code:
    """The code of a broadcast pair, its tables built once per worker."""
    key = zlib.crc32(lengths.tobytes(), zlib.crc32(ids.tobytes()))
    kept = cache("token-ids")
    if kept.get("code", (None,))[0] != key:
        kept["code"] = key, Code(ids, lengths)
    return kept["code"][1]


def read_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.parquet(f"{path}/code").orderBy("id").toArrow()
    return Code(rows.column("id").to_numpy(), rows.column("length").to_numpy())


def decoded_blocks(batches: Iterator[pa.RecordBatch], code: Code) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """(part, block, doc ids, counts, ids) of each block row."""
    for b in batches:
        for r in b.to_pylist():
            counts = np.array(r["counts"], np.int64)
            yield r["part"], r["block"], r["doc_ids"], counts, code.decode(r["payload"], r["marks"], int(counts.sum()))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: (part, block, nth, doc_id, n_tokens, ids_crc32, start); ``start`` counts the ids of all documents before."""
    code = read_code(spark, path)
    shared = spark.sparkContext.broadcast((code.ids, code.lengths))

    def run(batches):
        c = decoder(*shared.value)
        for part, block, docs, counts, ids in decoded_blocks(batches, c):
            at = np.concatenate([[0], np.cumsum(counts)]) * 4
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            n = len(docs)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(counts), pa.array(crc, pa.int64()), pa.array(at[:-1] // 4, pa.int64())], ["part", "block", "doc_id", "n_tokens", "ids_crc32", "inside"])

    files = spark.read.parquet(f"{path}/blocks")
    rows = files.mapInArrow(run, "part int, block int, doc_id long, n_tokens long, ids_crc32 long, inside long")
    # ids before each block, in two steps: blocks of a part, then one row per part
    per_block = files.select("part", "block", F.expr("aggregate(counts, 0L, (a, x) -> a + x)").alias("n"))
    per_part = per_block.groupBy("part").agg(F.sum("n").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    in_part = per_block.withColumn("start0", F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")).select("part", "block", "start0")
    at = in_part.join(per_part, "part").select("part", "block", (F.col("start0") + F.col("before")).alias("before"))
    return rows.join(at, ["part", "block"]).withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")


def write_documents(docs: DataFrame, vocabulary: str, path: str | None = None, end_id: int = END_ID) -> str:
    """Encode, count, code and write ``docs``; returns the folder of the files."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    staged = scratch_path(spark, "encoded")
    encode_ids(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(staged)
    encoded = spark.read.parquet(staged)
    write(encoded, path, build_code(encoded))
    return path
