"""Language identification (6) by cross-parsing entropy with suffix automata.

Each language gets the suffix automaton of a sample of its labelled text.  A
text is parsed greedily against it: a phrase is the longest match that starts
where the last one ended.  The fewer phrases a text needs, the smaller its
cross entropy to that language; phrase counts are normalised by log2 of the
sample's length (phrases * log2(n) / text bytes is the cross-parsing entropy
estimate), and the language with the smallest value wins.

Text is lower-cased, ASCII non-letters become blanks and runs of blanks one
blank; matching is on UTF-8 bytes.  A text is parsed in segments of
``SEGMENT`` bytes that run as parallel lanes of one numpy step each; a phrase
ends with its segment, for every language alike.  The whole text counts.

The automata come from a bounded sample: for each of at most
``max_languages`` languages (the most frequent; a corpus with more fails
loudly) one window of ``WINDOW`` characters of each of ``rows_per_language``
labelled rows, those with the smallest md5 of their id.

Defined cases: null texts and texts without a letter are ``und`` with score
0; ties go to the language that sorts first; rows with null lang teach
nothing; without any training row every text is ``und``.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldflow.llm.text import column_bytes
from coldflow.llm.workers import extended

WINDOW = 120
ROWS_PER_LANGUAGE = 250
MAX_LANGUAGES = 64
SEGMENT = 256
LANES = 4096
_BLANKS = bytes(b if 97 <= b < 123 or b >= 128 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def normalise(text: str) -> bytes:
    """Lower case, ASCII non-letters to blanks, single blanks, UTF-8."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKS).split())


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    m = _LETTER.search(text)
    return m is not None and (m.group().isalpha() or any(c.isalpha() for c in text))


class SuffixAutomaton:
    """All substrings of a text: state 0 is the root, ``next[s]`` maps a byte to the state of the longer match."""

    def __init__(self, text: bytes):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur


@dataclass
class Models:
    """Dense transition tables of all languages over one alphabet of byte classes.

    ``tables[l][state * width + byte class]`` is ``2 * (next state * width)``,
    plus 1 if the phrase had to end there and a new one starts with this byte.
    """

    languages: list[str]
    bits: list[float]
    byte_class: np.ndarray
    width: int
    tables: list[np.ndarray]


def compile_models(samples: dict[str, list[str]]) -> Models:
    """``samples`` maps a language to its training windows."""
    texts = {k: b" ".join(normalise(t) for t in v) for k, v in sorted(samples.items())}
    used = sorted(set(b"".join(texts.values())) | {32})
    byte_class = np.full(256, len(used), np.int32)
    byte_class[used] = np.arange(len(used))
    width = len(used) + 1  # the last class: bytes no sample holds
    tables, bits = [], []
    for text in texts.values():
        sam = SuffixAutomaton(text)
        table = np.full((len(sam.next), width), -1, np.int32)
        for s, step in enumerate(sam.next):
            for c, to in step.items():
                table[s, byte_class[c]] = 2 * to * width
        root = np.where(table[0] < 0, 0, table[0]) | 1
        table[0] = root  # the root is met at a phrase's start only
        tables.append(np.where(table < 0, root, table).ravel())
        bits.append(float(np.log2(max(2, len(text)))))
    return Models(list(texts), bits, byte_class, width, tables)


def phrase_counts(texts: list[bytes], models: Models) -> np.ndarray:
    """Phrases of each text (row) against each language (column)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.cumsum(sizes) - sizes
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first[owner] + nth * SEGMENT
    length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
    order = np.argsort(-length, kind="stable")
    codes = models.byte_class[np.frombuffer(b"".join(texts), np.uint8)]
    out = np.zeros((len(texts), len(models.languages)), np.int64)
    for at in range(0, len(order), LANES):
        lane = order[at : at + LANES]
        n = length[lane]
        top = int(n[0])
        grid = codes[np.minimum(start[lane] + np.arange(top)[:, None], len(codes) - 1)]
        active = np.searchsorted(-n, -np.arange(top), side="left")  # lanes longer than step k
        for col, table in enumerate(models.tables):
            state = np.zeros(len(lane), np.int32)
            count = np.zeros(len(lane), np.int64)
            for k in range(top):
                m = active[k]
                step = table[state[:m] + grid[k, :m]]
                count[:m] += step & 1
                state[:m] = step >> 1
            out[:, col] += np.bincount(owner[lane], count, len(texts)).astype(np.int64)
    return out


def predict_texts(texts: list[str | None], models: Models) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text; score is the softmax of the normalised entropies' gaps (0 for und)."""
    known = [i for i, t in enumerate(texts) if models.languages and has_letter(t)]
    lang, score = ["und"] * len(texts), np.zeros(len(texts))
    plain = [normalise(texts[i]) for i in known]
    keep = [k for k, t in enumerate(plain) if t]  # lower-casing keeps letters; only unencodable ones can vanish
    known, plain = [known[k] for k in keep], [plain[k] for k in keep]
    if known:
        size = np.array([len(t) for t in plain])
        entropy = phrase_counts(plain, models) * np.array(models.bits) / size[:, None]
        best = entropy.argmin(axis=1)
        p = np.exp(-8 * (entropy - entropy.min(axis=1, keepdims=True)))
        for k, i in enumerate(known):
            lang[i] = models.languages[best[k]]
            score[i] = 1 / p[k].sum()
    return lang, score


def sample(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> dict[str, list[str]]:
    """The bounded training windows of each language of ``docs`` (doc_id, text, lang)."""
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    rows = (
        docs.where("text IS NOT NULL AND lang IS NOT NULL AND length(trim(text)) > 0")
        .select("doc_id", "lang", F.md5(F.col("doc_id").cast("string")).alias("h"), F.expr(f"substr(text, 1 + CAST(pmod(xxhash64(doc_id), greatest(length(text) - {WINDOW}, 0) + 1) AS INT), {WINDOW})").alias("piece"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= rows_per_language)
    )
    found: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "h", "doc_id").limit(rows_per_language * (max_languages + 1)).collect():
        found.setdefault(r["lang"], []).append(r["piece"])
    if len(found) > max_languages:
        raise ValueError(f"more than max_languages = {max_languages} languages")
    return found


_compiled: dict[int, Models] = {}


def predict(docs: DataFrame, samples: dict[str, list[str]]) -> DataFrame:
    """``docs`` (with a text column) plus ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    names = docs.columns

    def run(batches):
        samples = shared.value
        key = zlib.crc32(repr(sorted(samples.items())).encode("utf-8", "replace"))
        if key not in _compiled:  # once per worker, not per task
            _compiled.clear()
            _compiled[key] = compile_models(samples)
        models = _compiled[key]
        for b in batches:
            _, offsets = column_bytes(b.column("text"))
            column = b.column("text")
            lang, score = [], []
            step = max(1, int(len(column) * (4 << 20) / max(1, offsets[-1] - offsets[0])))
            for i in range(0, len(column), step):
                x, s = predict_texts(column[i : i + step].to_pylist(), models)
                lang += x
                score.append(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))], [*names, "lang_pred", "score"])

    return docs.mapInArrow(run, extended(docs, lang_pred="string", score="double"))
