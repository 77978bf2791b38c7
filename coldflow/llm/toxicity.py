"""Toxicity scoring (7): FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
bytes.  Features are the distinct hashed unigrams, bigrams and skip-grams
(one or two words skipped) of the whole text.  Training is the per-coordinate
FTRL-proximal update with L1, so most weights are exactly zero; the non-zero
ones (at most 2^bits pairs of index and weight) are what is broadcast.

The classifier is fitted on a bounded sample of labelled rows:
``max_train_rows`` rows with the smallest md5 of their id.  The sampled rows'
feature indexes go to the driver (their number is bounded by that parameter);
every text is scored on the executors.

Defined cases: null and empty texts have no feature and get the bias-only
score; a document with several label rows counts as toxic if one of them
says so; null labels teach nothing; without any training row every score is 0.
Repeated ids are scored row by row; further columns of the inputs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldflow.llm.text import LOWER, U, Words, blocks, column_bytes, mix
from coldflow.llm.workers import extended

TOKEN_BYTES = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    TOKEN_BYTES[_a:_b] = True

BITS = 20
MAX_TRAIN_ROWS = 12000


@dataclass(frozen=True)
class Ftrl:
    """Hyper-parameters of the per-coordinate update."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 2.5
    l2: float = 1.0
    epochs: int = 4


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature index) of every n-gram and skip-gram of a block; repeats kept."""
    words = Words(LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0], TOKEN_BYTES)
    h, doc = words.hash, np.repeat(np.arange(len(offsets) - 1), words.counts)
    docs, idx = [doc], [mix(h + U(1))]
    for gap in (1, 2, 3):
        same = np.flatnonzero(doc[gap:] == doc[:-gap]) if len(doc) > gap else np.zeros(0, np.int64)
        docs.append(doc[same])
        idx.append(mix(h[same] * U(0x9E3779B97F4A7C15) + h[same + gap] + U(1 + gap)))
    return np.concatenate(docs), (np.concatenate(idx) >> U(64 - bits)).astype(np.int64)


def _feature_rows(batches):
    """(doc_id, toxic, text) -> (toxic, feat): distinct feature indexes of each row as int32 bytes."""
    for b in batches:
        data, offsets = column_bytes(b.column("text"))
        out = []
        for i, j in blocks(offsets):
            doc, idx = features(data, offsets[i : j + 1])
            key = np.unique(doc << BITS | idx)
            cut = np.searchsorted(key, np.arange(j - i + 1) << BITS)
            out += [(key[a:z] & ((1 << BITS) - 1)).astype(np.int32).tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(out, pa.binary())], ["doc_id", "toxic", "feat"])


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, ftrl: Ftrl | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, indexes, weights) learned from ``labels`` (doc_id, toxic) joined with ``docs`` (doc_id, text)."""
    ftrl = ftrl or Ftrl()
    sample = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(max_train_rows)
    )
    # broadcast: the sample holds at most max_train_rows rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text").mapInArrow(_feature_rows, "doc_id long, toxic int, feat binary").toArrow()
    ids = rows.column("doc_id").to_numpy()
    order = np.lexsort((ids, mix(ids.astype(np.int64).view(np.uint64))))  # a fixed pseudo-random order, whatever the partitions
    toxic = rows.column("toxic").to_numpy()
    feat = rows.column("feat").combine_chunks() if rows.num_rows else None
    n_features = 1 << BITS
    z, n, w = (np.zeros(n_features + 1) for _ in range(3))

    for _ in range(ftrl.epochs):
        for r in order:
            x = np.append(np.frombuffer(feat[int(r)].as_buffer(), np.int32), n_features)  # the last one is the bias
            zx, nx = z[x], n[x]
            l1 = np.full(len(x), ftrl.l1)
            l1[-1] = 0
            root = np.sqrt(nx)
            wx = np.where(np.abs(zx) <= l1, 0.0, -(zx - np.sign(zx) * l1) / ((ftrl.beta + root) / ftrl.alpha + ftrl.l2))
            p = 1 / (1 + np.exp(-np.clip(wx.sum(), -35, 35)))
            g = p - toxic[r]
            sigma = (np.sqrt(nx + g * g) - root) / ftrl.alpha
            z[x] = zx + g - sigma * wx
            n[x] = nx + g * g
    l1 = np.full(n_features + 1, ftrl.l1)
    l1[-1] = 0
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((ftrl.beta + np.sqrt(n)) / ftrl.alpha + ftrl.l2))
    at = np.flatnonzero(w[:-1])
    bias = float(w[-1]) if rows.num_rows else -35.0
    return bias, at.astype(np.int32), w[at].astype(np.float32)


def score_block(data: np.ndarray, offsets: np.ndarray, bias: float, active: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Probability of toxicity of each document of a block."""
    doc, idx = features(data, offsets)
    hit = active[idx]
    key = np.unique(doc[hit] << BITS | idx[hit])
    total = bias + np.bincount(key >> BITS, weight[key & ((1 << BITS) - 1)], len(offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` (its columns must hold text) with a score (0 to 1) and a prediction (1 if score >= 0.5) under the given names."""
    bias, at, weights = model
    shared = docs.sparkSession.sparkContext.broadcast((bias, at, weights))
    names = docs.columns

    def run(batches):
        b0, at, weights = shared.value
        active, weight = np.zeros(1 << BITS, bool), np.zeros(1 << BITS)
        active[at], weight[at] = True, weights
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            s = [score_block(data, offsets[i : j + 1], b0, active, weight) for i, j in blocks(offsets)]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, score, predicted])

    return docs.mapInArrow(run, extended(docs, **{score: "double", predicted: "int"}))
