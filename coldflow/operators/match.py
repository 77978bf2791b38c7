"""Full-text match join (J1) and phrase search (J5-J7) as Spark joins.

The catalogue is turned into an inverted index *table*: one row per
(term, doc) with the BM25 weight of that posting already computed.  A match
of many query texts is then an equi-join on ``term`` followed by a sum per
(query, doc) and a per-query top-k - the same work a search server does per
request, but for a whole batch of distinct queries at once.

Scoring (BM25, k1 = 1.2, b = 0.75, global statistics):

* ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``
* ``w(term, doc) = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))``
* ``score(query, doc) = sum over query terms (repeats count) of w``

N counts docs with at least one term.  The analyzer is
``coldflow.functions.text.analyze``.  A search server keeps statistics per
shard with a lossy length norm, so absolute scores (and hence the order of
near ties) differ from such a server; hit/miss agrees when the analyzers
agree.  Results are ordered by ``round(score, 6) desc, doc id asc`` so that
ties do not depend on float summation order.

Scale notes
-----------
* Query texts are de-duplicated before matching and joined back afterwards.
* Hot terms (a term in a third of the catalogue) are salted in proportion to
  their size: a term with ``df`` postings gets ``ceil(df / postings_per_task)``
  salts; its postings carry ``salt = hash(doc) % n``
  and only that term's query rows are replicated n times, so one term's
  postings spread over n tasks while cold terms are not replicated at all.
  No posting is ever dropped.
* Top-1 is a ``min(struct(-score, id))`` aggregate (partial aggregation on the
  map side); top-k uses ``row_number() <= k`` which plans a WindowGroupLimit
  before the shuffle, so a query with huge candidate lists ships at most k
  rows per map task.
* N and avgdl are two numbers collected once per index build and passed as
  literals (a cross join to a one-row frame would plan a nested-loop join).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldflow.functions.text import analyze
from coldflow.session import spread

K1 = 1.2
B = 0.75
SCORE_DIGITS = 6
POSTINGS_PER_TASK = 2_000_000
PRUNE_MARGIN = 1e-6


@dataclass
class TextIndex:
    """Inverted index of one text field of a document table."""

    postings: DataFrame  # (term, <id>, payload..., w, salt)
    doc_freq: DataFrame  # (term, df, salts, ub = max posting weight)
    id_col: str
    payload: tuple[str, ...]
    n_docs: int
    avgdl: float


def bm25(n_docs: int, avgdl: float, tf: Column, k1: float = K1, b: float = B) -> Column:
    """Weight of a posting of ``tf`` occurrences, from columns df and dl."""
    idf = F.log(F.lit(1.0) + (F.lit(float(n_docs)) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    norm = tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.lit(avgdl or 1.0))
    return idf * tf * F.lit(k1 + 1.0) / norm


def build_index(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    payload: Sequence[str] = (),
    postings_per_task: int = POSTINGS_PER_TASK,
    k1: float = K1,
    b: float = B,
) -> TextIndex:
    """Tokenize ``text_col`` and build the weighted, salted posting table."""
    toks = spread(docs.select(id_col, *payload, text_col)).select(id_col, *payload, analyze(F.col(text_col)).alias("toks"))
    return index_tokens(toks, id_col, payload, postings_per_task, k1, b)


def index_tokens(
    toks: DataFrame,
    id_col: str,
    payload: Sequence[str] = (),
    postings_per_task: int = POSTINGS_PER_TASK,
    k1: float = K1,
    b: float = B,
) -> TextIndex:
    """BM25 posting table from already analyzed docs ``(id, payload..., toks)``."""
    toks = toks.withColumn("dl", F.size("toks")).where(F.col("dl") > 0)
    st = toks.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).collect()[0]
    n_docs, avgdl = int(st["n"]), float(st["avgdl"] or 0.0)
    tf = (
        toks.select(id_col, *payload, "dl", F.explode("toks").alias("term"))
        .groupBy("term", id_col, *payload, "dl")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    n_salts = F.ceil(F.col("df") / F.lit(float(postings_per_task))).cast("int")
    doc_freq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("salts", n_salts)
    w = bm25(n_docs, avgdl, F.col("tf"), k1, b)
    postings = tf.join(doc_freq, "term").select(
        "term", id_col, *payload, w.alias("w"), F.pmod(F.xxhash64(id_col), F.col("salts")).cast("int").alias("salt")
    )
    # Per-term upper bound of a posting's weight, for exact top-k pruning.
    bound = postings.groupBy("term").agg(F.max("w").alias("ub"))
    return TextIndex(postings, doc_freq.join(bound, "term"), id_col, tuple(payload), n_docs, avgdl)


def materialize_index(index: TextIndex, path: str) -> TextIndex:
    """Write the posting table as parquet (partitioned by salt) and return an index reading it back.

    Long-lived jobs (a stream) read this snapshot by path in every batch
    instead of re-tokenizing the catalogue; a rebuild writes a new path.
    """
    spark = index.postings.sparkSession
    index.postings.write.mode("overwrite").partitionBy("salt").parquet(f"{path}/postings")
    index.doc_freq.write.mode("overwrite").parquet(f"{path}/doc_freq")
    return TextIndex(
        spark.read.parquet(f"{path}/postings"),
        spark.read.parquet(f"{path}/doc_freq"),
        index.id_col,
        index.payload,
        index.n_docs,
        index.avgdl,
    )


def query_terms(queries: DataFrame, text_col: str, index: TextIndex) -> DataFrame:
    """(text, term, qtf, df, salts, ub) for every distinct query text and each of its indexed terms."""
    q = queries.select(text_col).where(F.col(text_col).isNotNull()).distinct()
    qt = (
        q.select(text_col, F.explode(analyze(F.col(text_col))).alias("term"))
        .groupBy(text_col, "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    return qt.join(index.doc_freq, "term")


def _salted(qterms: DataFrame) -> DataFrame:
    """Replicate a query term once per salt of that term (1 for cold terms)."""
    return qterms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def score_queries(queries: DataFrame, text_col: str, index: TextIndex) -> DataFrame:
    """All (query text, doc) pairs with a positive score.

    ``queries`` may hold duplicates; texts are de-duplicated first.  Returns
    (``text_col``, <id>, payload..., score) with score rounded to 6 digits.
    """
    qt = _salted(query_terms(queries, text_col, index).select(text_col, "term", "qtf", "salts"))
    pairs = qt.join(index.postings, ["term", "salt"])
    scored = pairs.groupBy(text_col, index.id_col, *index.payload).agg(F.sum(F.col("qtf") * F.col("w")).alias("raw"))
    return scored.select(
        text_col, index.id_col, *index.payload, F.round("raw", SCORE_DIGITS).alias("score")
    )


def full_scores(cand: DataFrame, qt: DataFrame, text_col: str, index: TextIndex) -> DataFrame:
    """Exact raw BM25 of candidate (text, doc) pairs: one (term, doc) lookup per query term."""
    x = cand.join(qt.select(text_col, "term", "qtf"), text_col)
    y = x.join(index.postings.select("term", index.id_col, *index.payload, "w"), ["term", index.id_col])
    return y.groupBy(text_col, index.id_col, *index.payload).agg(F.sum(F.col("qtf") * F.col("w")).alias("raw"))


def score_candidates_pruned(queries: DataFrame, text_col: str, index: TextIndex, k: int) -> DataFrame:
    """Scores of every doc that can be in a query's top k (MaxScore, exact).

    1. Probe: the docs of each query's rarest term are scored exactly; the
       k-th best of them is a lower bound ``theta`` of the true k-th score.
    2. Query terms sorted by their bound ``qtf * ub``: the longest prefix
       whose bounds sum below ``theta`` (minus a margin that covers the
       6-digit rounding) is non-essential - a doc holding only those terms
       scores below every top-k doc.
    3. Candidates are the docs of the essential terms only; they are scored
       exactly by (term, doc) lookups.

    A hot term with a small bound (a stop word) then never produces a pair
    per (query, doc) - its postings are only looked up for candidates.
    """
    qt = query_terms(queries, text_col, index)
    rare = qt.groupBy(text_col).agg(F.min(F.struct("df", "term", "salts")).alias("r")).select(
        text_col, F.col("r.term").alias("term"), F.col("r.salts").alias("salts")
    )
    probe = _salted(rare).join(index.postings.select("term", "salt", index.id_col), ["term", "salt"]).select(
        text_col, index.id_col
    )
    probe_scores = full_scores(probe, qt, text_col, index)
    if k == 1:
        theta = probe_scores.groupBy(text_col).agg(F.max("raw").alias("theta"))
    else:
        w = Window.partitionBy(text_col).orderBy(F.col("raw").desc())
        best = probe_scores.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(k))
        theta = best.groupBy(text_col).agg(F.min("raw").alias("theta"), F.count(F.lit(1)).alias("_n")).where(
            F.col("_n") == F.lit(k)
        ).drop("_n")
    bound = F.col("qtf") * F.col("ub")
    cum = F.sum(bound).over(
        Window.partitionBy(text_col).orderBy(bound.asc(), F.col("term").asc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    marked = qt.join(theta, text_col, "left").withColumn("_cum", cum)
    essential = marked.where(F.col("theta").isNull() | (F.col("_cum") >= F.col("theta") - F.lit(PRUNE_MARGIN)))
    cand = (
        _salted(essential.select(text_col, "term", "salts"))
        .join(index.postings.select("term", "salt", index.id_col), ["term", "salt"])
        .select(text_col, index.id_col)
        .distinct()
    )
    scored = full_scores(cand, qt, text_col, index)
    return scored.select(text_col, index.id_col, *index.payload, F.round("raw", SCORE_DIGITS).alias("score"))


def top_k(scored: DataFrame, group: Sequence[str], id_col: str, k: int, rank_col: str = "rank") -> DataFrame:
    """Best k rows per group by (score desc, id asc), with a 1-based rank."""
    group = list(group)
    if k == 1:
        others = [c for c in scored.columns if c not in group and c not in (id_col, "score")]
        best = scored.groupBy(*group).agg(
            F.min(F.struct((-F.col("score")).alias("ns"), F.col(id_col).alias("id"), *[F.col(c) for c in others])).alias("b")
        )
        return best.select(
            *group,
            F.col("b.id").alias(id_col),
            *[F.col(f"b.{c}").alias(c) for c in others],
            (-F.col("b.ns")).alias("score"),
            F.lit(1).alias(rank_col),
        )
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col(id_col).asc())
    return scored.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


HOT_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """(key, _shares) of the keys with more than ``hot_rows`` rows: (rows / hot_rows) keys at most.

    ``rows`` may have been counted already: one row a key, with the number in ``_n``.
    """
    hot_rows = hot_rows or HOT_ROWS
    n = rows if "_n" in rows.columns else rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return n.where(F.col("_n") > hot_rows).select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_shares"))


def join_split(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Inner equi-join on ``key``; hot keys of the left side are split by ``spread_by``.

    A hot key's left rows are dealt to its shares by a hash of ``spread_by``, its right
    rows are copied to each; other keys are not copied.  The hot keys are few (``hot_keys``) and broadcast.
    """
    hot = F.broadcast(hot_keys(left, key) if hot is None else hot)
    shares = F.coalesce(F.col("_shares"), F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("_share", F.pmod(F.xxhash64(*spread_by), shares).cast("int")).drop("_shares")
    copied = right.join(hot, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return dealt.join(copied, [key, "_share"]).drop("_share")


def match(queries: DataFrame, text_col: str, index: TextIndex, k: int, prune: bool = True, stage=None) -> DataFrame:
    """Top-k docs per distinct query text (text, id, payload..., score, rank).

    Candidates are always pruned by MaxScore, whatever the size; ``prune=False``
    is the direct term join that tests compare with.  Both give the same rows.
    An index that brings its own ``match`` (a posting store's field) does it itself.
    """
    if hasattr(index, "match"):
        return index.match(queries, text_col, k, prune=prune, **({"stage": stage} if stage else {}))
    scored = score_candidates_pruned(queries, text_col, index, k) if prune else score_queries(queries, text_col, index)
    return top_k(scored, [text_col], index.id_col, k)


# ---------------------------------------------------------------------------
# Phrase search over titles
# ---------------------------------------------------------------------------
@dataclass
class PhraseIndex:
    """Positional postings: where each term stands in each doc."""

    postings: DataFrame  # (term, <id>, positions ascending, dl)
    doc_freq: DataFrame  # (term, df) within the indexed docs
    id_col: str


def normalized(text: Column) -> Column:
    """Analyzer tokens joined by single spaces."""
    return F.array_join(analyze(text), " ")


def build_phrase_index(docs: DataFrame, id_col: str, text_col: str, stage=None) -> PhraseIndex:
    """Positional postings of ``docs``; texts are analyzed once and not needed afterwards.

    ``stage(df, name)`` materializes the postings, which several steps read.
    """
    stage = stage or (lambda df, name: df)
    toks = spread(docs.select(id_col, text_col)).select(id_col, analyze(F.col(text_col)).alias("_toks"))
    at = toks.select(id_col, F.size("_toks").alias("dl"), F.posexplode("_toks").alias("pos", "term"))
    # A doc's own positions only: bounded by the doc.
    postings = at.groupBy("term", id_col, "dl").agg(F.sort_array(F.collect_list("pos")).alias("positions"))
    postings = stage(postings, "phrase-postings")
    return PhraseIndex(postings, postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), id_col)


def phrase_terms(keywords: DataFrame, kw_col: str) -> DataFrame:
    """(kw_col, i, term): each keyword's terms with their place in the phrase."""
    kw = keywords.select(kw_col).where(F.col(kw_col).isNotNull()).distinct()
    return kw.select(kw_col, F.posexplode(analyze(F.col(kw_col))).alias("i", "term"))


def phrase_matches(keywords: DataFrame, kw_col: str, index: PhraseIndex) -> DataFrame:
    """(kw_col, <id>) for every doc that holds the keyword's terms one after the other.

    Candidates are the docs of the keyword's rarest term.  For each term the places
    where the phrase would begin are its positions less its place in the
    phrase; a doc matches if one place is left in the intersection over all terms.
    """
    kt = phrase_terms(keywords, kw_col)
    rare = kt.join(index.doc_freq, "term", "left").fillna(0, ["df"]).groupBy(kw_col).agg(
        F.min(F.struct("df", "term")).alias("a"), F.count(F.lit(1)).alias("n")
    )
    cand = rare.select(kw_col, "n", F.col("a.term").alias("term")).join(index.postings.select("term", index.id_col), "term").drop("term")
    begins = F.transform("positions", lambda p: p - F.col("i"))
    found = cand.join(kt, kw_col).join(index.postings, ["term", index.id_col]).select(kw_col, index.id_col, "n", "i", begins.alias("b"))
    whole = found.groupBy(kw_col, index.id_col, "n").agg(F.collect_list("b").alias("all"))  # one entry a term of the phrase
    common = F.aggregate(F.slice("all", 2, F.size("all")), F.get("all", F.lit(0)), lambda x, y: F.array_intersect(x, y))
    return whole.where((F.size("all") == F.col("n")) & (F.size(common) > 0)).select(kw_col, index.id_col)
