"""Line dedup, importance resampling and hard negatives against brute force, with the odd cases of ``docs``."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coldflow.llm import hard_negatives, line_dedup, resample
from coldflow.llm.text import column_bytes
from tests.llm.conftest import TEXTS

LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


# ---------------------------------------------------------------------------
# Line dedup
# ---------------------------------------------------------------------------
def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(b" \t\n\v\f\r").translate(LOWER)
    split = [(-math.inf if d is None else d, (t or "").encode().split(b"\n")) for d, t in rows]
    held, last = Counter(), {}
    for d, lines in split:
        for k in {key(x) for x in lines}:
            if len(k.decode()) >= min_chars:
                held[k] += 1
                last[k] = max(last.get(k, d), d)
    out = []
    for d, lines in split:
        kept = [x for x in lines if held[key(x)] < min_docs or last[key(x)] == d]
        out.append((None if d == -math.inf else d, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return sorted(out, key=str)


def lines_of(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=str)


def odd_line_rows():
    a, b = "This boilerplate line is long enough to count as one", "é" * 39
    rows = [(i, f"own {i}\n {a.upper() if i % 2 else a}\t\n{b}\n{b}x\nend") for i in range(12)]
    rows += [(20 + i, f"{a}\n{a}\r\n{i}" if i < 3 else a) for i in range(5)] + [(31, None), (32, ""), (33, "\n\n"), (34, a[:39])]
    rows += [(None, f"{a}\nnull id"), (None, f"{a}\nnull id"), (7, rows[7][1]), (7, rows[7][1]), (7, f"other text\n{a}")]
    rows += [(40 + i, "only four documents hold this line, so that it stays") for i in range(4)]
    return rows


def test_line_dedup(spark, docs, no_docs):
    rows = odd_line_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, gone string, mark int")
    assert lines_of(line_dedup.deduplicate(df)) == brute_lines(rows)
    assert lines_of(line_dedup.deduplicate(df, min_chars=3, min_docs=2)) == brute_lines(rows, 3, 2)
    assert lines_of(line_dedup.deduplicate(docs, min_chars=2, min_docs=2)) == brute_lines(TEXTS, 2, 2)
    assert line_dedup.deduplicate(no_docs).count() == 0


def test_line_dedup_of_long_texts_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PIECE_BYTES", 1000)
    rng = np.random.default_rng(4)
    pool = [f"{'shared ' * 6}{k}" for k in range(300)]
    rows = [(i, "\n".join(rng.choice(pool, int(rng.integers(1, 400))))) for i in range(60)] + [(99, "\n".join(pool * 40)), (98, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines_of(line_dedup.deduplicate(df)) == brute_lines(rows)
    packs = []
    block = line_dedup._Block(40, 5)
    for d, t in rows:
        block.add(d, d, t.encode())
        packs.append(block.rows(d))
        block.clear()
    assert sum(b.num_rows for b in packs) > 1000


def test_lines_of_equals_split(monkeypatch):
    monkeypatch.setattr(line_dedup, "PIECE_BYTES", 7)
    for text in (b"", b"\n", b"a\nb", b"abcdefghij", b"abcdefghij\n", b"abcdefg\nhij\n\n\nklmnopqrst\nu", b"\n" * 40):
        assert list(line_dedup.lines_of(text)) == text.split(b"\n")


@pytest.mark.parametrize("levels", [0, 1, 3, line_dedup.LEVELS])
def test_perfect_hash_numbers_keys(levels):
    rng = np.random.default_rng(levels)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        number = line_dedup.PerfectHash.of(keys, levels)
        again = line_dedup.PerfectHash.load(*number.dump())
        for f in (number, again):
            assert sorted(f(keys).tolist()) == list(range(len(keys)))


def test_equal_hashes_with_other_fingerprints_stay_apart():
    h = np.array([5, 5, 5, 9], "<u8")
    f = np.array([1, 2, 3, 1], "<u4")
    pack = line_dedup._pack
    keys = pa.table({"shard": pa.array([0], pa.int32()), "block": [0], "base": [0], "keys": [h.tobytes() + f.tobytes()], "docs": [pack(np.array([4, 5, 6, 7]), "<u4")], "last": [pack(np.array([1, 2, 3, 4]), "<i8")]})
    shard = line_dedup._build(5)(keys)
    got = line_dedup._probe(5)(keys, shard)
    assert np.frombuffer(got["at"][0].as_py(), "<i8").tolist() == [1, 2, 3]
    assert np.frombuffer(got["last"][0].as_py(), "<i8").tolist() == [2, 3, 4]


def test_shards_follow_the_bytes():
    assert line_dedup.shard_bits(0, 40) == line_dedup.MIN_SHARD_BITS
    assert line_dedup.shard_bits(41 << 30, 40) in (10, 11)


# ---------------------------------------------------------------------------
# Importance resampling
# ---------------------------------------------------------------------------
def feature_list(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))
    return len(w), w + [a + b" " + b for a, b in zip(w, w[1:])]


def brute_resample(rows, target, min_words=20):
    s, t = (Counter(zlib.crc32(f) % 10_000 for x in texts for f in feature_list(x)[1]) for texts in ([x for _, x in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    out = []
    for d, x in rows:
        n, f = feature_list(x)
        weight = sum(gain(zlib.crc32(y) % 10_000) for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([n, (d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))])
    order = sorted((i for i, (n, _) in enumerate(out) if n >= min_words), key=lambda i: (-out[i][1][3], out[i][1][0] is None, out[i][1][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(order[: 25 * len(order) // 100])}
    return sorted(((*r, rank.get(i)) for i, (_, r) in enumerate(out)), key=str)


def resampled(docs, target, **more):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in resample.resample(docs, target, **more).collect()), key=str)


def test_word_crcs_equal_zlib():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("aB9é日- \n"), int(n))) for n in rng.integers(0, 300, 60)] + ["x" * 500 + " y " + "z" * 49 + "a " + "w" * 48 + " v", ""]
    data, offsets = column_bytes(pa.array(texts))
    bucket, doc, n_words = resample.features(data, offsets)
    for k, t in enumerate(texts):
        n, f = feature_list(t)
        assert n_words[k] == n and sorted(bucket[doc == k].tolist()) == sorted(zlib.crc32(x) % 10_000 for x in f)


def test_resample(spark, docs, no_docs):
    target = ["the quick brown fox jumps", "été déjà vu", None, ""]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, side string")
    assert resampled(docs, bench) == brute_resample(TEXTS, target)
    assert resampled(docs, bench.where("false"), min_words=1) == brute_resample(TEXTS, [], 1)
    assert resampled(no_docs, bench) == []


def test_resample_ranks_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(resample, "MIN_BLOCK", 16)
    monkeypatch.setattr(resample, "BLOCKS", 7)
    rng = np.random.default_rng(6)
    rows = [(int(i), " ".join(rng.choice(list("abcdefghij"), int(rng.integers(1, 60))))) for i in rng.integers(-(1 << 62), 1 << 62, 700)]
    rows += [(None, "null " * 30)] * 5 + [rows[3]] * 200 + [((1 << 63) - 1, "top " * 25), (-(1 << 63), "low " * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = ["a b a b c", "d"]
    got = resampled(df, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got == brute_resample(rows, target)


def test_digits_make_up_the_key():
    r = np.zeros(200, resample.RECORD)
    rng = np.random.default_rng(0)
    r["id"], r["score"] = rng.integers(0, 1 << 30, 200), rng.integers(0, 1 << 17, 200)
    for id_bits in (30, 36):
        key = [int(s) << id_bits | int(i) for s, i in zip(r["score"], r["id"])]
        parts = [resample.digit(r, at, id_bits) for at in range(0, id_bits + 17, resample.DIGIT)]
        assert key == [sum(int(p[k]) << (resample.DIGIT * n) for n, p in enumerate(parts)) for k in range(200)]


# ---------------------------------------------------------------------------
# Hard negatives
# ---------------------------------------------------------------------------
def brute_negatives(rows, positives=5, negatives=3):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, lab, v in good:
        if a % 50:
            continue
        order = sorted(((-dot(v, w), i, m) for i, m, w in good if i != a))
        for score, p, _ in [x for x in order if x[2] == lab][:positives]:
            fit = [(n, i) for n, i, m in order if m != lab and 50 * -score <= 100 * -n <= 95 * -score][:negatives]
            out += [(a, p, k + 1, i, -score, -n) for k, (n, i) in enumerate(fit)]
    return sorted(out)


def mined(df, **more):
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **more).collect()
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got)


@pytest.mark.parametrize("bound", [1, 300, 1 << 25, 1 << 45])
def test_packed_products_are_exact(bound):
    rng = np.random.default_rng(bound % 97)
    a, c = rng.integers(-bound, bound + 1, (9, 21)), rng.integers(-bound, bound + 1, (130, 21))
    c[0], a[0] = bound, -bound
    packed = hard_negatives.Packed(c, bound)
    assert (packed.kind is object) == (bound >= 1 << 25)
    assert (packed.scores(a) == a.astype(object) @ c.astype(object).T).all()


def test_hard_negatives(spark, monkeypatch):
    for name in ("MIN_CELL", "MAX_CELL"):
        monkeypatch.setattr(hard_negatives, name, 90)
    for name in ("MIN_GROUP", "MAX_GROUP"):
        monkeypatch.setattr(hard_negatives, name, 3)
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(0, 3)), (rng.standard_normal(6) + 0.5).round(1).tolist()) for i in range(-100, 400)]
    rows += [(1000 + i, 1, rows[3][2]) for i in range(40)] + [rows[60], rows[61], (1050, 2, rows[5][2][:4]), (1100, 0, []), (None, 1, rows[0][2])]
    rows += [(1150, None, rows[0][2]), (1200, 1, None), (1250, 1, [math.nan] * 6), (1300, 1, [math.inf] * 6), (1350, 1, [None] * 6)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, number int, pair string")
    want = brute_negatives(rows)
    assert len(want) > 50 and mined(df) == want
    assert mined(df.where("false")) == [] and mined(df.where("vec_id % 50 <> 0")) == []
    assert mined(df.where("vec_id = 0")) == []


def test_hard_negatives_of_large_components(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 3, (rng.integers(-9, 40, 5) * 1e5).tolist()) for i in range(160)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = brute_negatives(rows)
    assert want and mined(df) == want
