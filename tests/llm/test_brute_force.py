"""Per-section token counts and the FTRL update against plain Python."""

import math

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from coldflow.llm import queries, token_counts, toxicity
from coldflow.llm.text import column_bytes, mix
from tests.llm.conftest import TEXTS


def test_tokens_of_every_line(spark, docs):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    want = []
    for d, text in TEXTS:
        at, spans = 0, []
        for i in tokenizer.encode(text or "", add_special_tokens=False).ids:
            size = len(tokenizer.id_to_token(i))  # a byte-level token's characters are its bytes
            spans.append((at, at + size))
            at += size
        raw, begin = (text or "").encode(), 0
        lines = raw.splitlines(keepends=True) if raw.isascii() and b"\x1c" not in raw else [x for x in raw.replace(b"\n", b"\n\0").split(b"\0") if x]
        for k, line in enumerate(lines or [b""]):
            end = begin + len(line)
            starts = sum(begin <= a < end for a, _ in spans)
            crossing = sum(a < end and z > begin and not (begin <= a and z <= end) for a, z in spans)
            want.append((d, k, float(starts), crossing, len(spans)))
            begin = end
    got = token_counts.attribute(docs, queries.vocabulary()).collect()
    assert sorted((r["doc_id"], r["section"], r["n_tokens"], r["n_crossing"], r["doc_tokens"]) for r in got) == sorted(want)


def test_ftrl_equals_plain_python(spark):
    rng = np.random.default_rng(4)
    bad, good = ["vile", "awful", "hate"], ["tea", "river", "cloud", "stone", "path"]
    rows = []
    for d in range(60):
        toxic = int(d % 3 == 0)
        rows.append((d, " ".join([*rng.choice(good, 6), *(rng.choice(bad, 2) if toxic else [])]), toxic))
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    p = toxicity.Ftrl(l1=0.5)
    bias, at, weights = toxicity.fit(docs, labels, ftrl=p)

    z, n = {}, {}

    def weight(x):
        l1 = 0.0 if x == "bias" else p.l1
        v = z.get(x, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((p.beta + math.sqrt(n.get(x, 0.0))) / p.alpha + p.l2)

    order = sorted(rows, key=lambda r: int(mix(np.array([r[0]], np.uint64))[0]))
    for _ in range(p.epochs):
        for _, text, y in order:
            _, idx = toxicity.features(*column_bytes(pa.array([text])))
            own = {x: weight(x) for x in [*sorted(set(idx.tolist())), "bias"]}
            g = 1 / (1 + math.exp(-sum(own.values()))) - y
            for x, w in own.items():
                before = n.get(x, 0.0)
                n[x] = before + g * g
                z[x] = z.get(x, 0.0) + g - (math.sqrt(n[x]) - math.sqrt(before)) / p.alpha * w
    want = {x: weight(x) for x in z if x != "bias" and weight(x)}
    assert 0 < len(want) < len(z) - 1  # L1 leaves some weights out
    assert set(at.tolist()) == set(want)
    assert np.allclose([want[x] for x in at.tolist()], weights, atol=1e-5) and abs(weight("bias") - bias) < 1e-9
