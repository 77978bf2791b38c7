"""Byte-level text helpers on Arrow string columns, vectorised with numpy.

A *word* is a maximal run of bytes outside ``\x20 \x09-\x0D`` (those are all
ASCII, so runs never split a UTF-8 character).  Word hashes are 64-bit
polynomial hashes finished with a mixer; two different words collide with
probability about 2^-64, which the operators that rely on it state.

A null text is an empty text.  Texts are processed whole; ``blocks`` only
groups rows so that the temporary arrays of one step stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash (bijective)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def forget_powers() -> None:
    """Give back the power tables; they are built again as long as the next block needs them."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; row i is ``bytes[offsets[i]:offsets[i + 1]]``, null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("") if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col.fill_null(b"")
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose texts together hold about ``most`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def runs(data: np.ndarray, doc_starts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of kept bytes; a run never crosses a document start."""
    n = len(data)
    k = np.zeros(n + 2, bool)
    k[1:-1] = keep[data]
    new_doc = np.zeros(n + 1, bool)
    new_doc[doc_starts] = True
    starts = np.flatnonzero(k[1:-1] & (~k[:-2] | new_doc[:-1]))
    ends = np.flatnonzero(k[1:-1] & (~k[2:] | new_doc[1:])) + 1
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]``."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * power[: len(data)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


class Words:
    """The words of a block of documents.

    ``hash[w]`` of word w, its byte span ``start[w]:end[w]`` in ``data`` and
    ``offset`` (document d owns words ``offset[d]:offset[d + 1]``).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keep: np.ndarray = WORD_BYTES):
        base = offsets[0]
        self.data = data[base : offsets[-1]]
        self.doc_offset = offsets - base
        self.start, self.end = runs(self.data, self.doc_offset, keep)
        self.offset = np.searchsorted(self.start, self.doc_offset)
        self.hash = span_hashes(self.data, self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offset)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every n-word sequence that lies in one document, in text order."""
        if len(self.hash) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.offset[1:], self.counts)[: len(self.hash) - n + 1]
        at = np.flatnonzero(np.arange(len(self.hash) - n + 1) + n <= last)
        return at, sequence_hashes(self.hash, n)[at]


def sequence_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-element windows of a hash sequence."""
    s = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        s = s * U(0xFF51AFD7ED558CCD) + h[i : len(h) - n + 1 + i]
    return mix(s + U(n))
