"""Token-id files: long texts, runs of one bit stream, repeated ids, the encoder's piece table."""

import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from coldflow.llm import encode, huffman, queries, workers
from coldflow.llm.text import blocks, column_bytes

VOCAB = queries.vocabulary()


def test_piece_table_finds_what_was_added():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 1 << 63, 900, dtype=np.uint64) & ~np.uint64(0x3F0))  # many share a slot
    table = encode.PieceTable(1000)
    table.add(keys[:500], 0)
    table.add(keys[500:], 500)
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert (table.find(keys + np.uint64(1 << 40)) == -1).sum() >= len(keys) - 5


def test_long_text_in_windows_and_full_cache(monkeypatch):
    monkeypatch.setattr(encode, "BLOCK_BYTES", 300)
    monkeypatch.setattr(encode, "CACHE_PIECES", 64)
    enc = encode.Encoder(VOCAB)
    rng = np.random.default_rng(8)
    bits = [" word", "\n", " ", "　", "  ", ".", " été", "x" * 700, "\x1c ", "a\nb", "\t\t", " 12"]
    for _ in range(20):
        text = "".join(rng.choice(bits, 200))
        data, offsets = column_bytes(pa.array([text]))
        ids, count = enc.block(data, offsets)
        assert ids.tolist() == Tokenizer.from_file(VOCAB).encode(text, add_special_tokens=False).ids
        assert count.tolist() == [len(ids)]


def test_code_in_runs(monkeypatch):
    lengths = huffman.code_lengths(np.array([1 << k for k in range(24)]), 12)
    code, rng = huffman.Code(np.arange(24), lengths), np.random.default_rng(1)
    for n in (1, 127, 128, 129, 1000):
        ids = rng.integers(0, 24, n).astype(np.uint32)
        whole = code.encode(ids)
        with monkeypatch.context() as m:
            m.setattr(huffman, "RUN_IDS", 128)
            assert code.encode(ids) == whole
            assert code.decode(*whole, n).tolist() == ids.tolist()


def test_files_hold_repeated_and_null_ids(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "PART_BYTES", 2000)
    tokenizer = Tokenizer.from_file(VOCAB)
    rows = [(None, "no id"), (None, None)] + [(3, "the same row " * 40)] * 300 + [(3, f"other {k}") for k in range(50)] + [(1, "long " * 90_000), (7, "")]
    path = huffman.write_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), VOCAB, str(tmp_path / "ids"))
    got = sorted(huffman.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]

    def sums(text):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        return len(ids), zlib.crc32(ids.tobytes())

    def order(row):
        return row[0] is not None, row

    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=order) == sorted(((d, *sums(t)) for d, t in rows), key=order)
    # the copies of one row do not all go to one part, and no block but a long document's is beyond the bound
    assert len({r["part"] for r in got if r["doc_id"] == 3}) > 1
    blocks_ = spark.read.parquet(f"{path}/blocks").collect()
    assert all(sum(b["counts"]) <= huffman.BLOCK_IDS or len(b["counts"]) == 1 for b in blocks_)


def test_counts_come_with_the_ids(spark, docs):
    encoded = huffman.encode_ids(docs, VOCAB)
    tokenizer = Tokenizer.from_file(VOCAB)
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    ids = np.concatenate([[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]).astype(int)
    assert {r["id"]: r["n"] for r in huffman.id_counts(encoded).collect()} == {int(k): int(n) for k, n in zip(*np.unique(ids, return_counts=True), strict=True)}
    assert list(blocks(np.array([0, 1, 9, 9]), 4)) == [(0, 1), (1, 2), (2, 3)]


def test_a_worker_keeps_one_operators_tables():
    first = encode.encoder(VOCAB)
    assert encode.encoder(VOCAB) is first
    code = huffman.decoder(np.arange(3), np.array([1, 2, 2]))
    assert huffman.decoder(np.arange(3), np.array([1, 2, 2])) is code
    assert encode.encoder(VOCAB) is first
    workers.cache("another")["x"] = 1
    assert workers.cache("another") == {"x": 1}
    assert encode.encoder(VOCAB) is not first
    assert workers.cache("another") == {}
