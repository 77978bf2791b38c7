"""Benchmark decontamination (5): BM25 inverted index of test items, block-max WAND per training passage.

Index: items are cut into units of at most ``UNIT_WORDS`` words (half
overlapping); a posting's impact is its BM25 weight divided by the unit's
BM25 score of itself, so a unit is retrieved at ``THRESHOLD`` of its own
score whatever its length.  N, document frequencies and the mean length cover
all items and are computed in Spark.  The index goes to the executors in
shards of at most ``UNITS_PER_SHARD`` units, one pass over the documents per
shard, so what is broadcast has a fixed bound however many items there are.

Search: every document is cut into passages of ``PASSAGE`` words, half
overlapping; each is a query whose terms are its distinct words, and all
units above the threshold are retrieved.  Lists of frequent terms that could
not reach the threshold even together are non-essential (MaxScore).  Units are
in ``GROUPS`` groups; for all passages of a block of texts at once, the sum of
the essential terms' group maxima is compared with what a group's units still
need, and a passage without any qualifying group ends there.  The others run
block-max WAND: pivot by list bounds, then by block bounds, then exact scores.

Verification: around a retrieved passage, the share of the item's question
and answer 3-grams (single words for shorter parts) present must be at least
``OVERLAP`` for both.  Items without these columns are split after the last
inner sentence end, if what follows is at least ``GRAM`` words and one in
``ANSWER_PART`` of the item's words; else (a short last sentence, or only one)
there is no answer and the share is taken over the whole item.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
bytes.  Defined cases: null, empty and wordless texts and items match
nothing; copies of an item match each on its own; repeated rows of documents
give one row per document id and item (the best score); null ids drop out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldflow.llm.shared import sliced
from coldflow.llm.text import LOWER, Words, blocks, column_bytes, sequence_hashes
from coldflow.llm.toxicity import TOKEN_BYTES
from coldflow.session import stage_table

PASSAGE = 64
UNIT_WORDS = 48
UNITS_PER_SHARD = 20_000
THRESHOLD = 0.6
OVERLAP = 0.5
GRAM = 3
ANSWER_PART = 4
K1, B = 1.2, 0.75
BLOCK = 16
ESSENTIAL_GAP = 0.2
GROUPS = 32
SEARCH_BYTES = 1 << 19  # texts searched at once: the running sums hold GROUPS numbers for each of their words


def hashed_words(col: pa.Array) -> list[np.ndarray]:
    """Word hashes of each text of a column, as int64."""
    data, offsets = column_bytes(col)
    out = []
    for i, j in blocks(offsets):
        w = Words(LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i], TOKEN_BYTES)
        out += np.split(w.hash.view(np.int64), w.offset[1:-1])
    return out


def grams(words: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Distinct n-gram hashes; single words where there are fewer than n."""
    h = words.view(np.uint64)
    return np.unique(sequence_hashes(h, n) if len(h) >= n else h)


def _items(items: DataFrame) -> DataFrame:
    """(item_id, question, answer): the given columns, or the text, split after its last inner sentence end if an answer's length follows."""
    if {"question", "answer"} <= set(items.columns):
        rows = items.select("item_id", "question", "answer")
    else:
        inner = r"(?s)^(.*[.?!])\s+(\S.*)$"
        text = F.coalesce(F.col("text"), F.lit(""))
        last = F.regexp_extract(text, inner, 2)
        n_words = lambda c: F.regexp_count(c, F.lit(r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"))
        split = (n_words(last) >= GRAM) & (n_words(last) * ANSWER_PART >= n_words(text))
        rows = items.select("item_id", F.when(split, F.regexp_extract(text, inner, 1)).otherwise(text).alias("question"), F.when(split, last).otherwise("").alias("answer"))
    return rows.where("item_id IS NOT NULL")


def _unit_rows(batches):
    for b in batches:
        for i, q, a in zip(b.column("item_id").to_pylist(), hashed_words(b.column("question")), hashed_words(b.column("answer")), strict=True):
            whole = np.concatenate([q, a])
            step = UNIT_WORDS // 2
            starts = range(0, max(1, len(whole) - step), step) if len(whole) > UNIT_WORDS else [0]
            units = [whole[s : s + UNIT_WORDS] for s in starts if len(whole)]
            if units:
                yield pa.RecordBatch.from_pydict({"item_id": [i] * len(units), "unit": list(range(len(units))), "words": units, "question": [q] * len(units), "answer": [a] * len(units)}, schema=pa.schema([("item_id", pa.int64()), ("unit", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("words", "question", "answer"))]))


def build_index(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Staged (units, postings, number of shards); postings: shard, item_id, unit, term, impact."""
    arrays = "words array<long>, question array<long>, answer array<long>"
    units = stage_table(_items(items).withColumn("item_id", F.col("item_id").cast("long")).distinct().mapInArrow(_unit_rows, f"item_id long, unit int, {arrays}"), "bench-units")
    n, avg = units.select(F.count("*"), F.avg(F.size("words"))).first()
    shards = max(1, -(-n // UNITS_PER_SHARD))
    units = units.withColumn("shard", F.pmod(F.xxhash64("item_id", "unit", "words"), F.lit(shards)))
    tf = units.select("shard", "item_id", "unit", F.size("words").alias("len"), F.xxhash64("words").alias("key"), F.explode("words").alias("term")).groupBy("shard", "item_id", "unit", "key", "len", "term").count()
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("count") * (K1 + 1) / (F.col("count") + K1 * (1 - B + B * F.col("len") / F.lit(avg or 1.0)))
    weighted = stage_table(tf.join(df, "term").withColumn("w", weight), "bench-weights")
    total = weighted.groupBy("item_id", "unit", "key").agg(F.sum("w").alias("self"))
    postings = weighted.join(total, ["item_id", "unit", "key"]).select("shard", "item_id", "unit", "key", "term", (F.col("w") / F.col("self")).alias("impact"))
    return units.withColumn("key", F.xxhash64("words")), stage_table(postings, "bench-postings"), shards


@dataclass
class Shard:
    """One shard of the inverted index, ready for WAND."""

    terms: np.ndarray  # sorted term hashes
    top: np.ndarray  # largest impact of each term
    bounds: np.ndarray  # largest impact of each essential term (row) in each group of units (column); 0 for non-essential terms
    need: np.ndarray  # what the essential terms have to reach in each group
    lists: list[tuple[list[int], list[float], list[float], list[int]]]  # unit numbers, impacts, block bounds, last unit of each block
    item: np.ndarray  # item of each unit
    question: list[np.ndarray]
    answer: list[np.ndarray]
    size: np.ndarray  # words of each unit's item

    def __post_init__(self):
        self.strong = self.bounds.any(axis=1)


def make_shard(units: pa.Table, postings: pa.Table, threshold: float = THRESHOLD) -> Shard:
    names = sorted(zip(units.column("item_id").to_pylist(), units.column("unit").to_pylist(), units.column("key").to_pylist(), range(units.num_rows), strict=True))
    number = {x[:3]: i for i, x in enumerate(names)}
    rows = [x[3] for x in names]
    arrays = lambda c: [np.array(units.column(c)[r].as_py(), np.int64) for r in rows]
    question, answer = arrays("question"), arrays("answer")
    unit = np.array([number[x] for x in zip(postings.column("item_id").to_pylist(), postings.column("unit").to_pylist(), postings.column("key").to_pylist(), strict=True)], np.int64)
    term, impact = postings.column("term").to_numpy(), postings.column("impact").to_numpy()
    order = np.lexsort((unit, term))
    term, unit, impact = term[order], unit[order], impact[order]
    terms, first = np.unique(term, return_index=True)
    last = np.append(first[1:], len(term))[: len(first)]
    lists = []
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        u, w = unit[a:z].tolist(), impact[a:z].tolist()
        lists.append((u, w, [max(w[k : k + BLOCK]) for k in range(0, len(w), BLOCK)], [u[min(len(u), k + BLOCK) - 1] for k in range(0, len(u), BLOCK)]))
    top = np.maximum.reduceat(impact, first) if len(terms) else np.zeros(0)
    # non-essential: the most frequent terms, as long as no unit gets more than threshold - gap from all of them
    gathered, essential = np.zeros(len(rows)), np.ones(len(terms), bool)
    for t in np.argsort(first - last, kind="stable").tolist():
        u, w = unit[first[t] : last[t]], impact[first[t] : last[t]]
        if last[t] - first[t] < 2 or (gathered[u] + w).max() > threshold - ESSENTIAL_GAP:
            break
        gathered[u] += w
        essential[t] = False
    group = np.arange(len(rows)) * GROUPS // max(1, len(rows))
    bounds, need = np.zeros((len(terms), GROUPS), np.float32), np.zeros(GROUPS)
    of = np.repeat(np.arange(len(terms)), last - first)
    np.maximum.at(bounds, (of, group[unit]), np.nextafter(impact, 2, dtype=np.float32))
    bounds[~essential] = 0
    np.maximum.at(need, group, gathered)
    return Shard(terms, top, bounds, threshold - need - 1e-6, lists, np.array([x[0] for x in names], np.int64), [grams(q) for q in question], [grams(a) if len(a) else a for a in answer], np.array([len(q) + len(a) for q, a in zip(question, answer, strict=True)], np.int64))


def wand(shard: Shard, query: list[int], threshold: float) -> list[tuple[int, float]]:
    """(unit, score) of all units that the distinct query terms score at ``threshold`` or more (block-max WAND)."""
    cursors = [[shard.lists[t], 0, float(shard.top[t])] for t in query]
    out = []
    slack = threshold - 1e-9
    while cursors:
        cursors.sort(key=lambda c: c[0][0][c[1]])
        bound, p = 0.0, 0
        for p, c in enumerate(cursors):  # noqa: B007
            bound += c[2]
            if bound >= slack:
                break
        if bound < slack:
            return out
        pivot = cursors[p][0][0][cursors[p][1]]
        while p + 1 < len(cursors) and cursors[p + 1][0][0][cursors[p + 1][1]] == pivot:
            p += 1
        bound, upto = 0.0, cursors[p + 1][0][0][cursors[p + 1][1]] if p + 1 < len(cursors) else 1 << 62
        for (units, _, bounds, lasts), at, _ in cursors[: p + 1]:
            k = at // BLOCK
            while k < len(lasts) and lasts[k] < pivot:
                k += 1
            if k < len(lasts):
                bound += bounds[k]
                upto = min(upto, lasts[k] + 1)
        if bound < slack:
            goal = max(upto, pivot + 1)
        else:
            score = 0.0
            for (units, impacts, _, _), at, _ in cursors[: p + 1]:
                while at < len(units) and units[at] < pivot:
                    at += 1
                if at < len(units) and units[at] == pivot:
                    score += impacts[at]
            if score >= slack:
                out.append((pivot, score))
            goal = pivot + 1
        kept = []
        for i, c in enumerate(cursors):
            if i <= p:
                units, at = c[0][0], c[1]
                while at < len(units) and units[at] < goal:
                    at += 1
                c[1] = at
                if at == len(units):
                    continue
            kept.append(c)
        cursors = kept
    return out


def _overlap(present: np.ndarray, wanted: np.ndarray) -> float:
    return float(np.isin(wanted, present).mean()) if len(wanted) else 1.0


def search_block(data: np.ndarray, offsets: np.ndarray, shard: Shard, threshold: float = THRESHOLD, passage: int = PASSAGE, overlap: float = OVERLAP) -> list[tuple[int, int, float, int, float, float]]:
    """(document, item, score, first word of the passage, question and answer overlap) of verified matches of a block."""
    w = Words(LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0], TOKEN_BYTES)
    h = w.hash.view(np.int64)
    if not len(shard.terms) or not len(h):
        return []
    tid = np.minimum(np.searchsorted(shard.terms, h), len(shard.terms) - 1)
    known = shard.terms[tid] == h
    strong = np.flatnonzero(known & shard.strong[tid])
    weight = np.zeros((len(strong) + 1, shard.bounds.shape[1]))
    np.cumsum(shard.bounds[tid[strong]], axis=0, out=weight[1:])
    step = passage // 2
    count = np.maximum(1, -(-(w.counts - passage) // step) + 1) * (w.counts > 0)
    doc = np.repeat(np.arange(len(count)), count)
    first = w.offset[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * step
    last = np.minimum(first + passage, w.offset[doc + 1])
    out = []
    reach = weight[np.searchsorted(strong, last)] - weight[np.searchsorted(strong, first)]
    for k in np.flatnonzero((reach >= shard.need).any(axis=1)).tolist():
        a, z, d = int(first[k]), int(last[k]), int(doc[k])
        for unit, score in wand(shard, np.unique(tid[a:z][known[a:z]]).tolist(), threshold):
            around = h[max(w.offset[d], a - shard.size[unit]) : min(w.offset[d + 1], z + shard.size[unit])].view(np.uint64)
            seen = np.concatenate([sequence_hashes(around, GRAM), around]) if len(around) >= GRAM else around
            q, n = _overlap(seen, shard.question[unit]), _overlap(seen, shard.answer[unit])
            if q >= overlap and n >= overlap:
                out.append((d, int(shard.item[unit]), score, a - int(w.offset[d]), q, n))
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, score, first_word, question_overlap, answer_overlap, n_passages): verified leaks."""
    spark = docs.sparkSession
    units, postings, shards = build_index(items)
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])

    def searched(shard_no: int) -> DataFrame:
        mine = F.col("shard") == shard_no
        shared = spark.sparkContext.broadcast(make_shard(units.where(mine).toArrow(), postings.where(mine).toArrow(), threshold))  # <= UNITS_PER_SHARD units

        def run(batches):
            shard = shared.value
            for b in sliced(batches):
                data, offsets = column_bytes(b.column("text"))
                ids = b.column("doc_id")
                rows = [(ids[i + d].as_py(), *rest) for i, j in blocks(offsets, SEARCH_BYTES) for d, *rest in search_block(data, offsets[i : j + 1], shard, threshold)]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

        return texts.mapInArrow(run, "doc_id long, item_id long, score double, first_word long, question_overlap double, answer_overlap double")

    hits = searched(0)
    for s in range(1, shards):
        hits = hits.unionByName(searched(s))
    best = F.max(F.struct("score", -F.col("first_word"), "question_overlap", "answer_overlap"))
    return (
        hits.groupBy("doc_id", "item_id")
        .agg(best.alias("b"), F.count("*").cast("long").alias("n_passages"))
        .select("doc_id", "item_id", F.round("b.score", 6).alias("score"), (-F.col("b.col2")).alias("first_word"), F.col("b.question_overlap").alias("question_overlap"), F.col("b.answer_overlap").alias("answer_overlap"), "n_passages")
    )
