"""Byte-level BPE encoding of whole texts with the tokenizers library, once per distinct piece.

A text is cut where a run of white space begins after a non-space character.
The tokenizer's own split pattern always has a boundary there (only white
space may lead a piece, never follow inside one), and added tokens hold no
white space, so the ids of the pieces put together are the ids of the whole
text.  A cut is left out where the preceding byte could end a non-ASCII (or
control) white-space character; the pieces are then longer, never wrong.

Pieces are told apart by a 64-bit hash of their bytes.  Each worker encodes a
piece the first time it meets it and keeps the ids in flat arrays (at most
``CACHE_PIECES`` pieces, then it starts afresh); an open-addressing table of
the hashes finds all pieces of a block at once.  A text of several blocks'
bytes is encoded in windows that end at a cut, so temporary arrays stay small.
"""

from __future__ import annotations

import os

import numpy as np

from coldflow.llm.text import span_hashes
from coldflow.llm.workers import cache

BLOCK_BYTES = 512 << 10  # text encoded at once: some dozens of bytes are held for each of its bytes
CACHE_PIECES = 1 << 20
JOINED = 16
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:?!")] = True


def piece_spans(data: np.ndarray, doc_offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first piece of each document and the total) of a block's pieces.

    Cuts: where white space begins after a non-space; after a single
    white-space character other than a blank between ASCII characters; before ``.,;:?!`` that follow an ASCII letter.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(doc_offset), np.int64)
    space = _SPACE[data]
    cut = np.zeros(n, bool)
    cut[1:] = space[1:] & ~space[:-1]
    odd = np.flatnonzero(cut)
    before = data[odd - 1]
    # 0x1C-0x1F, and the last bytes of U+0085, 00A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000
    last = ((before >= 0x1C) & (before <= 0x1F)) | ((before >= 0x80) & (before <= 0x8A)) | np.isin(before, (0x9F, 0xA0, 0xA8, 0xA9, 0xAF))
    lead = data[np.maximum(odd - 2, 0)]
    lead3 = data[np.maximum(odd - 3, 0)]
    wide = (before < 0x80) | (lead == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))
    cut[odd[last & wide]] = False
    plain = (data > 0x20) & (data < 0x80)
    cut[2:] |= plain[:-2] & space[1:-1] & (data[1:-1] != 0x20) & plain[2:]
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    cut[doc_offset[:-1][doc_offset[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(starts, doc_offset)


class PieceTable:
    """Numbers of 64-bit keys (0 is no key) by open addressing, looked up and added in whole arrays."""

    def __init__(self, most: int):
        size = 1 << (2 * most - 1).bit_length()
        self.mask = np.uint64(size - 1)
        self.key, self.number = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        slot = (keys & self.mask).astype(np.int64)
        seen = self.key[slot]
        out = np.where(seen == keys, self.number[slot], np.int32(-1))
        left = np.flatnonzero((seen != keys) & (seen != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & int(self.mask)
            seen, own = self.key[slot], keys[left]
            hit = seen == own
            out[left[hit]] = self.number[slot[hit]]
            on = ~hit & (seen != 0)
            left, slot = left[on], slot[on]
        return out

    def add(self, keys: np.ndarray, first: int) -> None:
        """Number distinct keys that are not there yet from ``first`` on."""
        slot, left = (keys & self.mask).astype(np.int64), np.arange(len(keys))
        while len(left):
            at, own = slot[left], keys[left]
            free = self.key[at] == 0
            self.key[at[free]] = own[free]
            won = free & (self.key[at] == own)  # of several keys for one slot the last stays
            self.number[at[won]] = first + left[won]
            left = left[~won]
            slot[left] = (slot[left] + 1) & int(self.mask)


class Encoder:
    """Ids of blocks of texts; one per worker and vocabulary file (see ``encoder``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocab = self.tokenizer.get_vocab()
        letters = [c for c in (*range(33, 127), *range(161, 173), *range(174, 256))]
        rest = [b for b in range(256) if b not in set(letters)]
        self.byte_char = {b: chr(b) for b in letters} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.translate = self.byte_char
        #: Bytes of text behind each id (a byte-level token's characters are its bytes).
        self.id_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.id_bytes[i] = len(token.content.encode())
        self.dtype = np.dtype("<u2" if len(self.id_bytes) <= 1 << 16 else "<u4")
        # no token goes on past a letter into a blank: blank-led words may be encoded several at a time
        blank = self.byte_char[0x20]
        self.joinable = not any(blank in t[1:] and t.strip(blank) and self.byte_char[0xA0] not in t for t in vocab)
        self._reset()

    def _reset(self, most: int = CACHE_PIECES) -> None:
        self.most, self.pieces = most, 0
        self.table = PieceTable(most)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(most + 1, np.int64)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _words(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each) of pieces that are a blank and letters, straight from the BPE model."""
        ids: list[int] = []
        step = JOINED if self.joinable else 1
        for i in range(0, len(raws), step):
            ids += [t.id for t in self.model.tokenize(b"".join(raws[i : i + step]).decode("latin-1").translate(self.translate))]
        flat = np.array(ids, np.uint32)
        upto = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        last = np.searchsorted(np.cumsum(self.id_bytes[flat]), upto)
        return flat, np.diff(last, prepend=-1)

    def _learn(self, raws: list[bytes], keys: np.ndarray) -> None:
        """Encode new pieces and keep their ids."""
        word = np.array([r[0] == 32 and r[1:].decode("utf-8", "replace").isalpha() for r in raws], bool)
        rest = [self.whole(raws[k].decode("utf-8", "replace")) for k in np.flatnonzero(~word).tolist()]
        flat, count = self._words([raws[k] for k in np.flatnonzero(word).tolist()])
        count = np.concatenate([count, np.array([len(x) for x in rest], np.int64)])
        flat = np.concatenate([flat, *([np.array([i for x in rest for i in x], np.uint32)] if rest else [])])
        n, at = self.pieces, int(self.begin[self.pieces])
        if at + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(flat)), np.uint32)])
        self.flat[at : at + len(flat)] = flat
        self.begin[n + 1 : n + 1 + len(keys)] = at + np.cumsum(count)
        self.table.add(np.concatenate([keys[word], keys[~word]]), n)
        self.pieces = n + len(keys)

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each piece among the kept ones; new pieces are learnt."""
        keys = np.maximum(span_hashes(data, starts, ends), np.uint64(1))
        entry = self.table.find(keys)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            new, first = np.unique(keys[miss], return_index=True)
            if self.pieces + len(new) > self.most:
                miss = np.arange(len(keys))
                new, first = np.unique(keys, return_index=True)
                self._reset(max(CACHE_PIECES, len(new)))
            raw, at = data.tobytes(), miss[first]
            self._learn([raw[a:z] for a, z in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], new)
            entry[miss] = self.table.find(keys[miss])
        return entry

    def _long(self, data: np.ndarray) -> np.ndarray:
        """The ids of one text, window by window; a window goes up to a cut."""
        out, at = [], 0
        while at < len(data):
            size, upto = BLOCK_BYTES, 0
            while not upto:
                window = data[at : at + size]
                if at + size >= len(data):
                    upto = len(window)
                else:
                    upto = int(piece_spans(window, np.array([0, len(window)]))[0][-1])  # 0: no cut in the window
                    size *= 2
            out.append(self._pieces(window[:upto], np.array([0, upto]))[0])
            at += upto
        return np.concatenate(out)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after another, number of ids of each) of rows ``data[offsets[i]:offsets[i + 1]]``."""
        if len(offsets) == 2 and offsets[1] - offsets[0] > 2 * BLOCK_BYTES:
            ids = self._long(data[offsets[0] : offsets[1]])
            return ids, np.array([len(ids)], np.int64)
        return self._pieces(data[offsets[0] : offsets[-1]], offsets - offsets[0])

    def _pieces(self, data: np.ndarray, doc_offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, doc_piece = piece_spans(data, doc_offset)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(doc_offset) - 1, np.int64)
        entry = self._entries(data, starts, ends)
        begin, count = self.begin[entry], self.begin[entry + 1] - self.begin[entry]
        total = np.zeros(len(entry) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        ids = self.flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], count)]
        return ids, np.diff(total[doc_piece])


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    loaded = cache("token-ids")
    if path not in loaded:
        loaded[path] = Encoder(path)
    return loaded[path]
