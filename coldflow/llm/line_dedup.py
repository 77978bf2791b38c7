"""Line dedup (11): a sharded minimal perfect hash over distinct line hashes.

A line's key is the line without ``\\x20 \\x09-\\x0D`` at its ends, A-Z in lower
case.  Keys of at least ``min_chars`` code points that at least ``min_docs``
documents hold lose all their lines but those of the largest doc_id that holds
them.

1. Parse: every task cuts its documents into lines and packs those of long keys
   in blocks of about ``BLOCK_LINES`` lines: the block's distinct keys (a 64-bit
   hash and a 32-bit fingerprint, both of one 128-bit hash) with the number of
   its documents and the largest doc_id, cut by shard (leading bits of the
   hash), and, apart from them, which line of which document has which key.
2. Build: a shard adds its keys up and stores them without the hashes: cascading
   bit arrays (level k holds the keys that met no other key in level k; the rank
   of a key's bit is its number) over arrays of fingerprints, counts (up to
   ``min_docs``) and largest doc_ids.
3. Probe: the blocks' keys go to the arrays of their shard, once per block
   however many lines have them, and the numbers of the keys that must go come
   back to the block, which marks the lines of its documents.
4. Documents that lose lines get their marks by a join on (doc_id, text hash).
   Lines themselves are never joined or shuffled.

Scale: the number of shards follows the bytes of all texts (a key takes at
least ``min_chars`` + 1 of them), so a shard holds about ``SHARD_KEYS`` keys at
most; a key in a third of all documents reaches its shard once per block.  Two
lines are taken for one if 96 bits of their hashes agree; equal 64-bit hashes
with different fingerprints are kept apart in a list.

Defined cases: every row is a document of its own, also one that repeats
another; a null doc_id is smaller than all others; a null or empty text is one
empty line; only doc_id and text are read, so other columns may have any name;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldflow.llm.text import U, column_bytes, mix
from coldflow.session import stage_table

SPACE = b" \t\n\v\f\r"
BLOCK_LINES = 1 << 18
BLOCK_BYTES = 32 << 20
PIECE_BYTES = 4 << 20
SHARD_KEYS = 1 << 20
MIN_SHARD_BITS = 5
LEVELS = 40
NO_ID = -(1 << 63)  # stands for a null doc_id

_CONTINUATION = bytes(range(0x80, 0xC0))
_PACKED = "block long, shard int, base long, keys binary, docs binary, last binary, rows binary, lines binary"
_SHARD = "shard int, sizes binary, levels binary, prints binary, counts binary, last binary, odd binary"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def lines_of(text: bytes) -> Iterator[bytes]:
    """The lines of a text, split in pieces of about PIECE_BYTES so that a long text never is one list of lines."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        cut = text.find(b"\n", start + PIECE_BYTES)
        if cut < 0:
            break
        yield from text[start:cut].split(b"\n")
        start = cut + 1
    yield from (text[start:] if start else text).split(b"\n")


def _pack(x: np.ndarray, kind: str) -> bytes:
    """Little-endian numbers in byte planes, compressed."""
    x = np.ascontiguousarray(x.astype(kind))
    return zstandard.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    n = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(n, -1).T).view(kind).ravel()


def _cuts(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges [a, z) of equal neighbours."""
    first = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
    return zip(first, [*first[1:], len(x)][: len(first)], strict=True)


def _keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, fingerprints) of packed keys."""
    n = len(raw) // 12
    return np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<u4", n, 8 * n)


class _Block:
    """Lines of long keys of consecutive documents."""

    def __init__(self, min_chars: int, bits: int):
        self.min_chars, self.bits = min_chars, bits
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.marks: list[int] = []
        self.sizes: list[int] = []
        self.hashes: list[bytes] = []
        self.row: list[int] = []
        self.at: list[int] = []
        self.bytes = 0

    def add(self, doc_id: int | None, mark: int, text: bytes) -> None:
        row, least, at = len(self.ids), self.min_chars, 0
        for at, line in enumerate(lines_of(text)):
            if len(line) < least:
                continue
            key = line.strip(SPACE).lower()
            if len(key) >= least and (key.isascii() or len(key.translate(None, _CONTINUATION)) >= least):
                self.hashes.append(xxhash.xxh3_128_digest(key))
                self.row.append(row)
                self.at.append(at)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.marks.append(mark)
        self.sizes.append(at + 1)
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.hashes) >= BLOCK_LINES or self.bytes >= BLOCK_BYTES

    def rows(self, number: int) -> pa.RecordBatch:
        """A row for each shard that has keys here, and one (without shard) with the lines."""
        both = np.frombuffer(b"".join(self.hashes), ">u8").reshape(-1, 2)
        pair = np.empty(len(both), [("h", "<u8"), ("f", "<u4")])
        pair["h"], pair["f"] = both[:, 0], both[:, 1] & U(0xFFFFFFFF)
        keys, key = np.unique(pair, return_inverse=True)
        row, ids = np.array(self.row, np.int64), np.array(self.ids, np.int64)
        held = np.unique(key * len(ids) + row)  # once for each (key, document)
        docs = np.bincount(held // max(1, len(ids)), minlength=len(keys))
        last = np.full(len(keys), NO_ID, np.int64)
        np.maximum.at(last, key, ids[row])
        shard = (keys["h"] >> U(64 - self.bits)).astype(np.int64)
        out: dict[str, list] = {k: [] for k in ("block", "shard", "base", "keys", "docs", "last", "rows", "lines")}
        for a, z in _cuts(shard):
            part = (number, int(shard[a]), a, keys["h"][a:z].tobytes() + keys["f"][a:z].tobytes(), _pack(docs[a:z], "<u4"), _pack(last[a:z], "<i8"), None, None)
            for k, v in zip(out, part, strict=True):
                out[k].append(v)
        refs = np.concatenate([row, np.array(self.at, np.int64), key]).astype("<u4")
        whole = (number, None, None, None, None, None, np.concatenate([ids, np.array(self.marks, np.int64), np.array(self.sizes, np.int64)]).astype("<i8").tobytes(), _pack(refs, "<u4"))
        for k, v in zip(out, whole, strict=True):
            out[k].append(v)
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("base", pa.int64()), *((k, pa.binary()) for k in ("keys", "docs", "last", "rows", "lines"))]))


def _parse(min_chars: int, bits: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(min_chars, bits)
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            for k, (doc_id, mark) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("mark").to_pylist(), strict=True)):
                block.add(doc_id, mark, data[offsets[k] : offsets[k + 1]].tobytes())
                if block.full:
                    yield block.rows(number)
                    number += 1
                    block.clear()
        if block.hashes:
            yield block.rows(number)

    return parse


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return ((mix(keys + U(level * 0x9E3779B97F4A7C15 % (1 << 64))) >> U(32)) * U(size) >> U(32)).astype(np.int64)


class PerfectHash:
    """Numbers 0 .. n - 1 of n distinct 64-bit keys, from about three bits a key.

    A key's place in level k is a hash of it; the bit there is set if no other
    key that reached the level has that place.  A key's number is the rank of
    its first set bit.  Keys left after ``LEVELS`` levels stand in a list.
    A key of another set gets any number or -1.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest, self.n = levels, rest, 0
        self.rank = []
        for bits in levels:
            self.rank.append(self.n + np.cumsum(bits, dtype=np.int64) - 1)
            self.n += int(bits.sum())

    @classmethod
    def of(cls, keys: np.ndarray, levels: int = LEVELS) -> PerfectHash:
        made, left = [], keys
        while len(left) and len(made) < levels:
            size = max(64, 2 * len(left))
            at = _slot(left, len(made), size)
            bits = np.bincount(at, minlength=size) == 1
            made.append(bits)
            left = left[~bits[at]]
        return cls(made, np.sort(left))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = _slot(keys[todo], k, len(bits))
            hit = bits[at]
            out[todo[hit]] = self.rank[k][at[hit]]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            hit = self.rest[at] == keys[todo]
            out[todo[hit]] = self.n + at[hit]
        return out

    def dump(self) -> tuple[bytes, bytes]:
        """(level sizes, bits of the levels and then the rest)."""
        sizes = np.array([*(len(b) for b in self.levels), len(self.rest)], "<i8")
        return sizes.tobytes(), b"".join([*(np.packbits(b).tobytes() for b in self.levels), self.rest.astype("<u8").tobytes()])

    @classmethod
    def load(cls, sizes: bytes, raw: bytes) -> PerfectHash:
        made, at = [], 0
        *levels, rest = np.frombuffer(sizes, "<i8").tolist()
        for n in levels:
            made.append(np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at), count=n).astype(bool))
            at += (n + 7) // 8
        return cls(made, np.frombuffer(raw, "<u8", rest, at))


def _build(min_docs: int):
    """A shard's arrays from its keys: counts are kept up to min_docs, which is all that a probe asks."""
    count_kind = "<u1" if min_docs < 256 else "<u4"

    def build(table: pa.Table) -> pa.Table:
        h, f, docs, last = [], [], [], []
        for r in zip(*(table.column(k).to_pylist() for k in ("keys", "docs", "last")), strict=True):
            own = _keys(r[0])
            h.append(own[0])
            f.append(own[1])
            docs.append(_unpack(r[1], "<u4"))
            last.append(_unpack(r[2], "<i8"))
        h, f, docs, last = (np.concatenate(x) for x in (h, f, docs, last))
        order = np.lexsort((f, h))
        h, f, docs, last = h[order], f[order], docs[order], last[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (f[1:] != f[:-1])]))
        h, f = h[new], f[new]
        docs = np.minimum(np.add.reduceat(docs.astype(np.int64), new), min_docs)
        last = np.maximum.reduceat(last, new)
        odd = np.zeros(len(h), bool)  # a hash that an earlier fingerprint has already
        odd[1:] = h[1:] == h[:-1]
        number = PerfectHash.of(h[~odd])
        at = number(h[~odd])
        prints, counts, lasts = np.zeros(len(at), "<u4"), np.zeros(len(at), count_kind), np.zeros(len(at), "<i8")
        prints[at], counts[at], lasts[at] = f[~odd], docs[~odd], last[~odd]
        sizes, levels = number.dump()
        extra = np.stack([h[odd].view(np.int64), f[odd].astype(np.int64), docs[odd], last[odd]]).astype("<i8").tobytes()
        row = (table.column("shard")[0].as_py(), sizes, levels, prints.tobytes(), counts.tobytes(), lasts.tobytes(), extra)
        return pa.table([pa.array([v], pa.int32() if k == 0 else pa.binary()) for k, v in enumerate(row)], names=["shard", "sizes", "levels", "prints", "counts", "last", "odd"])

    return build


def _probe(min_docs: int):
    count_kind = "<u1" if min_docs < 256 else "<u4"

    def probe(keys: pa.Table, shard: pa.Table) -> pa.Table:
        """(block, numbers of its keys that must go, the doc_ids that keep them)."""
        a = {k: shard.column(k)[0].as_py() for k in shard.column_names}
        number = PerfectHash.load(a["sizes"], a["levels"])
        prints, counts, last = np.frombuffer(a["prints"], "<u4"), np.frombuffer(a["counts"], count_kind), np.frombuffer(a["last"], "<i8")
        odd = {(int(h), int(f)): (n, z) for h, f, n, z in np.frombuffer(a["odd"], "<i8").reshape(4, -1).T.tolist()}
        out: dict[str, list] = {"block": [], "at": [], "last": []}
        for block, base, raw in zip(*(keys.column(k).to_pylist() for k in ("block", "base", "keys")), strict=True):
            h, f = _keys(raw)
            at = number(h)
            known = prints[at] == f
            gone, keeper = known & (counts[at] >= min_docs), last[at].copy()
            for k in np.flatnonzero(~known).tolist():
                n, keeper[k] = odd[(int(h[k : k + 1].view(np.int64)[0]), int(f[k]))]
                gone[k] = n >= min_docs
            if gone.any():
                out["block"].append(block)
                out["at"].append((base + np.flatnonzero(gone)).astype("<i8").tobytes())
                out["last"].append(keeper[gone].astype("<i8").tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int64()), "at": pa.array(out["at"], pa.binary()), "last": pa.array(out["last"], pa.binary())})

    return probe


def _marks(lines: pa.Table, answers: pa.Table) -> pa.Table:
    """(doc_id, mark, gone) of a block's documents that lose lines; gone has a boolean for each line."""
    out: dict[str, list] = {"doc_id": [], "mark": [], "gone": []}
    if answers.num_rows and lines.num_rows:
        ids, marks, sizes = np.frombuffer(lines.column("rows")[0].as_py(), "<i8").reshape(3, -1)
        row, at, key = _unpack(lines.column("lines")[0].as_py(), "<u4").reshape(3, -1).astype(np.int64)
        goes, keeper = np.zeros(int(key.max()) + 1, bool), np.zeros(int(key.max()) + 1, np.int64)
        for numbers, last in zip(answers.column("at").to_pylist(), answers.column("last").to_pylist(), strict=True):
            n = np.frombuffer(numbers, "<i8")
            goes[n], keeper[n] = True, np.frombuffer(last, "<i8")
        hit = goes[key] & (keeper[key] != ids[row])
        row, at = row[hit], at[hit]
        for a, z in _cuts(row):
            r = int(row[a])
            gone = np.zeros(sizes[r], bool)
            gone[at[a:z]] = True
            out["doc_id"].append(int(ids[r]))
            out["mark"].append(int(marks[r]))
            out["gone"].append(gone)
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "mark": pa.array(out["mark"], pa.int64()), "gone": pa.array(out["gone"], pa.list_(pa.bool_()))})


def shard_bits(text_bytes: int, min_chars: int) -> int:
    """log2 of the number of shards: a key takes min_chars bytes and a line end at least."""
    keys = text_bytes // (min_chars + 1) + 1
    return max(MIN_SHARD_BITS, (-(-keys // SHARD_KEYS) - 1).bit_length())


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, mark, gone): the documents that lose lines; ``docs`` has doc_id (long, NO_ID for null), text and mark."""
    total = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    bits = shard_bits(total, min_chars)
    packed = stage_table(docs.mapInArrow(_parse(min_chars, bits), _PACKED), "line-blocks")
    keys = packed.where("shard IS NOT NULL")
    shards = stage_table(keys.select("shard", "keys", "docs", "last").groupBy("shard").applyInArrow(_build(min_docs), _SHARD), "line-shards")
    answers = keys.select("shard", "block", "base", "keys").groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(_probe(min_docs), "block long, at binary, last binary")
    lines = packed.where("shard IS NULL").select("block", "rows", "lines")
    marked = lines.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_marks, "doc_id long, mark long, gone array<boolean>")
    # rows that repeat another (same id, same text) lose the same lines
    return marked.groupBy("doc_id", "mark").agg(F.first("gone").alias("gone"))


def deduplicate(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): the texts without their dropped lines, kept lines joined by ``\\n``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    gone = dropped_lines(own, min_chars, min_docs)
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "gone")
    rows = docs.join(gone, (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("_id")) & (F.xxhash64("text") == F.col("_mark")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, k: ~F.get(F.col("gone"), k)), "\n")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size(F.filter("gone", lambda x: x)))
    return rows.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )
