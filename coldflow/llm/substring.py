"""Substring dedup (10): repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  A word goes when a
window that covers it has a word sequence that also starts anywhere else.

1. Anchors: the anchor of a window is its smallest ``ANCHOR``-word hash
   (leftmost on ties), a function of the window alone; about one word in
   fourteen starts one.  Equal windows have equal anchors at two places, so
   only windows whose anchor value starts twice or more somewhere can recur.
2. Confirmation: the windows with such anchors, of the documents that hold
   any, are counted by their 64-bit hash.  Documents are dealt to blocks; each
   block sends its distinct windows once (with a mark for those it holds
   twice) in packed buckets, and gets one bit for each back.  A hot window
   reaches its bucket once per block, however often it occurs.
3. Passages: the maximal runs of recurring windows are cut out as texts, and
   equal ones are put together: from here on only the distinct passages
   count, not where they came from.  A passage is filed under its rarest anchor.
4. Automata: a document can hold a passage only if it holds the passage's
   anchor, so each block of documents gets the passages filed under its
   documents' anchors, from wherever they were cut.  They are compiled into
   Aho-Corasick automata over word numbers (pyahocorasick) of at most about
   ``SHARD_WORDS`` words each, and all documents of the block are streamed through every
   one.  The words of the occurrences found go, and nothing else.

Every occurrence of a recurring window lies in a recurring passage of its own
document, so none is missed; a passage is recurring windows throughout, so
wherever it is found its words go rightly.  A hot passage is sent once per
block that holds its rarest anchor.

Defined cases: null, empty and short texts lose nothing; rows that repeat
another (same id, same text) are documents of their own, so their windows
recur; the hash of no words is the SHA-256 of the empty string; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldflow.llm.jaccard import small
from coldflow.llm.shared import bucket_bits
from coldflow.llm.text import Words, blocks, column_bytes, sequence_hashes
from coldflow.session import stage_table

WINDOW = 35
ANCHOR = 8
BLOCK_WORDS = 1 << 19
SHARD_WORDS = 1 << 18


def window_anchors(words: Words, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(first word of every window inside one document, first word of its anchor); plus the hashes via ``anchor_hashes``."""
    h = words.hash
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = sequence_hashes(h, anchor)
    at = np.arange(len(value))
    need, have = window - anchor + 1, 1
    while have < need:  # leftmost minimum over ``have`` neighbours, doubled until it spans the window
        step = min(have, need - have)
        n = len(at) - step
        later = value[at[step : step + n]] < value[at[:n]]
        at = np.where(later, at[step : step + n], at[:n])
        have += step
    last = np.repeat(words.offset[1:], words.counts)[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + window <= last)
    return start, at[start]


def joined(words: Words, kept: np.ndarray | None = None) -> tuple[bytes, np.ndarray]:
    """(kept words of all documents, each followed by a blank; offsets of the documents in it)."""
    start, size = words.start, words.end - words.start + 1
    if kept is not None:
        start, size = start[kept], size[kept]
        per_doc = np.add.reduceat(np.append(kept, False).astype(np.int64), np.minimum(words.offset[:-1], len(kept))) * (words.counts > 0) if len(words.counts) else words.counts
    else:
        per_doc = words.counts
    end = np.cumsum(size)
    source = np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)
    out = words.data[np.minimum(source, len(words.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[end - 1] = 32
    return out.tobytes(), np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(per_doc)])]


def digests(words: Words, kept: np.ndarray | None = None) -> list[str]:
    """SHA-256 of each document's kept words joined by one blank."""
    raw, cut = joined(words, kept)
    return [hashlib.sha256(raw[a : max(a, z - 1)]).hexdigest() for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _anchor_rows(batches):
    """(uid, doc_id, n_words, sha, anchors): anchors as many times as they start in the text."""
    for b in batches:
        data, offsets = column_bytes(b.column("text"))
        for i, j in blocks(offsets):
            w = Words(data, offsets[i : j + 1])
            _, at = window_anchors(w)
            at = np.unique(at)
            value = sequence_hashes(w.hash, ANCHOR)[at] if len(at) else np.zeros(0, np.uint64)
            cut = np.searchsorted(at, w.offset)
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("uid").slice(i, j - i), b.column("doc_id").slice(i, j - i), pa.array(w.counts), pa.array(digests(w)), lists], ["uid", "doc_id", "n_words", "sha", "anchors"])


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column as one numpy array a row."""
    out = []
    for chunk in column.chunks:
        at, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [values[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return out


BLOCK_FIELDS = pa.schema([("block", pa.int64()), ("uids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())), ("anchors", pa.list_(pa.binary())), ("starts", pa.list_(pa.binary()))])


def _one_block(left, right):
    """The candidate documents of a block as one row: texts with their shared anchors and how often each starts in the corpus."""
    shared = {}
    for u, anchors, starts in zip(right.column("uid").to_pylist(), _arrays(right.column("anchors")), _arrays(right.column("starts")), strict=True):
        order = np.argsort(anchors.view(np.uint64))
        shared[u] = anchors[order].tobytes(), starts[order].tobytes()
    uid = left.column("uid").to_pylist()
    at = [k for k, u in enumerate(uid) if u in shared]
    if not at:
        return BLOCK_FIELDS.empty_table()
    texts = left.column("text").take(pa.array(at, pa.int64())).to_pylist()
    rows = {"block": [left.column("block")[0].as_py()], "uids": [[uid[k] for k in at]], "texts": [texts], "anchors": [[shared[uid[k]][0] for k in at]], "starts": [[shared[uid[k]][1] for k in at]]}
    return pa.Table.from_pydict(rows, schema=BLOCK_FIELDS)


def block_words(texts: list[str]) -> Words:
    return Words(*column_bytes(pa.array(texts, pa.large_string())))


def block_windows(w: Words, anchors: list[bytes], starts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first words of a block's candidate windows, their hashes, their anchors, how often each anchor starts)."""
    start, at = window_anchors(w)
    found = np.zeros(len(start), np.int64)
    if not len(start):
        return start, np.zeros(0, np.uint64), np.zeros(0, np.uint64), found
    doc = np.searchsorted(w.offset, start, side="right") - 1
    value = sequence_hashes(w.hash, ANCHOR)[at]
    cut = np.searchsorted(doc, np.arange(len(anchors) + 1))
    for d, (raw, n) in enumerate(zip(anchors, starts, strict=True)):
        a, z = cut[d], cut[d + 1]
        known = np.frombuffer(raw, np.uint64)
        if z > a and len(known):
            k = np.minimum(np.searchsorted(known, value[a:z]), len(known) - 1)
            found[a:z] = np.where(known[k] == value[a:z], np.frombuffer(n, np.int64)[k], 0)
    keep = found > 0
    return start[keep], sequence_hashes(w.hash, WINDOW)[start[keep]], value[keep], found[keep]


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _window_rows(bits: int):
    """Distinct windows of each block by bucket, and which of them it holds more than once."""

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                _, h, _, _ = block_windows(block_words(b.column("texts")[k].as_py()), b.column("anchors")[k].as_py(), b.column("starts")[k].as_py())
                items, count = np.unique(h, return_counts=True)
                bucket = (items >> np.uint64(64 - bits)).astype(np.int64)
                used, first = np.unique(bucket, return_index=True)
                cut = np.append(first, len(items)).tolist()
                rows = {"bucket": used.tolist(), "block": [b.column("block")[k].as_py()] * len(used), "items": [_packed(items[a:z]) for a, z in zip(cut[:-1], cut[1:], strict=True)], "twice": [np.packbits(count[a:z] > 1).tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)]}
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("items", pa.binary()), ("twice", pa.binary())]))

    return run


def _answers(table):
    """One bit per window of each row of a bucket: does it occur twice or more?"""
    items = [_unpacked(x) for x in table.column("items").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(i)) for x, i in zip(table.column("twice").to_pylist(), items, strict=True)]
    size = np.cumsum([len(x) for x in items])
    every, twice = np.concatenate(items), np.concatenate(twice).astype(bool)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = np.concatenate([[False], s[1:] == s[:-1]])
    first = np.flatnonzero(~same)
    hit = np.logical_or.reduceat(twice[order], first) | (np.diff(np.append(first, len(s))) > 1) if len(s) else twice
    again = np.empty(len(s), bool)
    again[order] = np.repeat(hit, np.diff(np.append(first, len(s))))
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "again": pa.array([np.packbits(x).tobytes() for x in np.split(again, size[:-1])], pa.binary())})


def passages(start: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal runs of consecutive windows (ascending first words) as word ranges."""
    if not len(start):
        return []
    new = np.flatnonzero(np.concatenate([[True], np.diff(start) != 1]))
    last = np.append(new[1:], len(start)) - 1
    return list(zip(start[new].tolist(), (start[last] + window).tolist(), strict=True))


PASSAGE_FIELDS = pa.schema([("digest", pa.binary()), ("anchor", pa.int64()), ("passage", pa.binary())])


def block_passages(w: Words, start: np.ndarray, anchor: np.ndarray, found: np.ndarray) -> dict[bytes, tuple[int, bytes]]:
    """The distinct passages of recurring windows (first words ``start``): digest -> (rarest anchor, words joined by one blank)."""
    raw, _ = joined(w)
    begin = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
    run = np.cumsum(np.concatenate([[False], np.diff(start) != 1]))
    order = np.lexsort((anchor, found, run))
    rarest = anchor[order[np.searchsorted(run[order], np.arange(run[-1] + 1 if len(run) else 0))]].view(np.int64)
    out = {}
    for (a, z), key in zip(passages(start), rarest.tolist(), strict=True):
        text = raw[begin[a] : begin[z] - 1]
        out[hashlib.sha256(text).digest()] = key, text
    return out


def _passage_rows(left, right):
    """The distinct recurring passages of a block, by the answers to its windows."""
    out = {"digest": [], "anchor": [], "passage": []}
    answers = sorted(zip(right.column("bucket").to_pylist(), right.column("again").to_pylist(), right.column("bits").to_pylist(), strict=True))
    for k in range(left.num_rows if answers else 0):
        w = block_words(left.column("texts")[k].as_py())
        start, h, anchor, found = block_windows(w, left.column("anchors")[k].as_py(), left.column("starts")[k].as_py())
        items, which = np.unique(h, return_inverse=True)
        if not len(items):
            continue
        bucket = (items >> np.uint64(64 - answers[0][2])).astype(np.int64)
        size = dict(zip(*(x.tolist() for x in np.unique(bucket, return_counts=True)), strict=True))
        again = np.concatenate([np.unpackbits(np.frombuffer(raw, np.uint8), count=size[b]) for b, raw, _ in answers]).astype(bool)[which]
        # windows never cross documents, and two runs of first words meet only if they overlap, so a run is inside one document
        for digest, (key, text) in block_passages(w, start[again], anchor[again], found[again]).items():
            out["digest"].append(digest)
            out["anchor"].append(key)
            out["passage"].append(text)
    return pa.Table.from_pydict(out, schema=PASSAGE_FIELDS)


def located(words: Words, found: pa.ChunkedArray, shard_words: int = SHARD_WORDS) -> np.ndarray:
    """Which words of the block the occurrences of the passages ``found`` cover, by Aho-Corasick automata."""
    import ahocorasick

    gone = np.zeros(len(words.hash) + 1, np.int64)
    names, number = np.unique(words.hash, return_inverse=True)
    number = number.tolist()
    docs = [(a, tuple(number[a:z])) for a, z in zip(words.offset[:-1].tolist(), words.offset[1:].tolist(), strict=True) if z - a >= WINDOW]

    def stream(patterns: list[tuple[int, ...]]) -> None:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for p in patterns:
            automaton.add_word(p, len(p))
        automaton.make_automaton()
        for a, text in docs:
            longest: dict[int, int] = {}
            for e, n in automaton.iter(text):
                if n > longest.get(e, 0):
                    longest[e] = n
            if longest:
                end = np.fromiter(longest, np.int64, len(longest)) + a + 1
                np.add.at(gone, end - np.fromiter(longest.values(), np.int64, len(longest)), 1)
                np.add.at(gone, end, -1)

    patterns, size = [], 0
    for chunk in found.chunks:
        data, offsets = column_bytes(chunk)
        for i, j in blocks(offsets):
            own = Words(data, offsets[i : j + 1])
            at = np.minimum(np.searchsorted(names, own.hash), max(len(names) - 1, 0))
            known = names[at] == own.hash if len(names) else np.zeros(len(own.hash), bool)
            strange = np.concatenate([[0], np.cumsum(~known)])
            code = at.tolist()
            for a, z in zip(own.offset[:-1].tolist(), own.offset[1:].tolist(), strict=True):
                if z - a < WINDOW or strange[z] > strange[a]:  # a word that no document of the block holds
                    continue
                patterns.append(tuple(code[a:z]))
                size += z - a
                if size >= shard_words:
                    stream(patterns)
                    patterns, size = [], 0
    if patterns:
        stream(patterns)
    return np.cumsum(gone[:-1]) > 0


def _kept_rows(left, right):
    """(uid, n_removed, sha) of the documents of a block that lose words; ``right`` holds the passages they may hold."""
    out = {"uid": [], "n_removed": [], "kept": []}
    for k in range(left.num_rows if right.num_rows else 0):
        w = block_words(left.column("texts")[k].as_py())
        gone = located(w, right.column("passage"))
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(w.offset[:-1], len(gone))) * (w.counts > 0)
        if not removed.any():
            continue
        sha = digests(w, ~gone)
        for d in np.flatnonzero(removed).tolist():
            out["uid"].append(left.column("uids")[k][d].as_py())
            out["n_removed"].append(int(removed[d]))
            out["kept"].append(sha[d])
    return pa.Table.from_pydict(out, schema=pa.schema([("uid", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))


def recurring(dealt: DataFrame, bits: int) -> DataFrame:
    """(digest, anchor, passage): the distinct recurring passages of the dealt blocks."""
    answers = dealt.select("block", "texts", "anchors", "starts").mapInArrow(_window_rows(bits), "bucket int, block long, items binary, twice binary").groupBy("bucket").applyInArrow(lambda table: _answers(table), "block long, bucket int, again binary")
    cut = dealt.groupBy("block").cogroup(answers.withColumn("bits", F.lit(bits)).groupBy("block")).applyInArrow(_passage_rows, "digest binary, anchor long, passage binary")
    return cut.groupBy("digest", "anchor").agg(F.first("passage").alias("passage"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs`` (an id, text)."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("uid", F.xxhash64("doc_id", "text"))
    signed = stage_table(texts.mapInArrow(_anchor_rows, "uid long, doc_id long, n_words long, sha string, anchors array<long>"), "substring-anchors")
    each = signed.select("uid", F.explode("anchors").alias("anchor"))
    shared = stage_table(each.groupBy("anchor").agg(F.count("*").alias("starts")).where("starts > 1"), "substring-shared")
    mine = each.distinct().join(shared, "anchor").groupBy("uid").agg(F.collect_list(F.struct("anchor", "starts")).alias("a"))
    words = signed.groupBy("uid").agg(F.sum("n_words").alias("n_words"))
    mine = stage_table(mine.join(words, "uid").select("uid", "n_words", F.col("a.anchor").alias("anchors"), F.col("a.starts").alias("starts")), "substring-candidates")
    n_docs, n_words, n_anchors = mine.select(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()
    block = F.pmod(F.col("uid"), F.lit(max(1, -(-n_words // BLOCK_WORDS)))).alias("block")
    wanted = texts.join(small(mine.select("uid"), n_docs), "uid", "left_semi").select(block, "uid", "text")
    arrays = "block long, uids array<long>, texts array<string>, anchors array<binary>, starts array<binary>"
    dealt = stage_table(wanted.groupBy("block").cogroup(mine.select(block, "uid", "anchors", "starts").groupBy("block")).applyInArrow(_one_block, arrays), "substring-blocks")
    found = stage_table(recurring(dealt, bucket_bits(14 * n_anchors)), "substring-passages")  # an anchor has about 14 windows
    holders = mine.select(block, F.explode("anchors").alias("anchor")).distinct()
    routed = found.select("anchor", "passage").join(holders, "anchor").select("block", "passage")
    removed = stage_table(dealt.select("block", "uids", "texts").groupBy("block").cogroup(routed.groupBy("block")).applyInArrow(_kept_rows, "uid long, n_removed long, kept string").distinct(), "substring-removed")
    out = signed.drop("anchors").join(removed, "uid", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))
