"""News title search (J5-J7 with filters V1, V2 and time score P13) and
channel jobs (P7, P8, A4).

Searches run for a whole table of keywords at once: phrases are found by the
positions of their terms (``coldflow.operators.match``), filters are plain
column predicates on the news table (pushed into the scan), and the per
keyword page is a ``row_number() <= rows`` window (WindowGroupLimit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldflow.functions.text import analyze
from coldflow.operators.match import SCORE_DIGITS, PhraseIndex, bm25, build_phrase_index, phrase_matches, phrase_terms
from coldflow.session import spread

# Fixed values of the reference: rows per keyword of the three searches,
# recency window in days, and the channel words of the channel filter.
NEWEST_ROWS = 3
RELEVANCE_ROWS = 30
PAGE_ROWS = 10
DAYS_LIMIT = 3
CHANNEL_WORDS = ("娱乐", "热点", "视频")
CHANNEL_ID_KEY = "channelId"


def channel_filter(channels: Column, words: Sequence[str] = CHANNEL_WORDS) -> Column:
    """V1: some channel contains one of the words (``*w*`` wildcard OR)."""
    def any_word(c: Column) -> Column:
        cond = F.lit(False)
        for w in words:
            cond = cond | F.contains(c, F.lit(w))
        return cond

    return F.coalesce(F.exists(channels, any_word), F.lit(False))


def recency_filter(publish: Column, now: Column, days: int = DAYS_LIMIT) -> Column:
    """V2: publish time in [start of day(now - days), now], both ends included."""
    start = F.date_trunc("day", F.timestamp_add("DAY", F.lit(-days), now)).cast("timestamp_ntz")
    return publish.between(start, now)


def time_score(ts: Column) -> Column:
    """yyyyMMddHHmmss of the time as DOUBLE, 1.0 when missing."""
    return F.coalesce(F.date_format(ts, "yyyyMMddHHmmss").cast("double"), F.lit(1.0))


class NewsSearch:
    """Positional index over the titles that pass both filters, and the filtered document set.

    The filters read no title, so only titles of rows that pass them are
    analyzed; a search then reads postings, no text.  Relevance needs the statistics
    of all titles (number, average length, the keywords' document frequencies):
    one pass that keeps counts only.
    """

    def __init__(self, news: DataFrame, words: Sequence[str], now: Column, days: int = DAYS_LIMIT, stage=None):
        self.news = news
        self.allowed = news.where(channel_filter(F.col("channels"), words) & recency_filter(F.col("publish_time"), now, days))
        self.phrase: PhraseIndex = build_phrase_index(self.allowed, "row_id", "title", stage)
        self._stage = stage or (lambda df, name: df)

    def matches(self, keywords: DataFrame) -> DataFrame:
        """(keyword, row_id, doc_id, created_time, ...) phrase matches passing both filters."""
        rows = self.allowed.drop("title")
        return phrase_matches(keywords, "keyword", self.phrase).join(rows, "row_id")

    def statistics(self, keywords: DataFrame) -> tuple[int, float, DataFrame]:
        """(titles with a term, their average length, (term, df) of the keywords' terms) over all news."""
        asked = sorted(r[0] for r in phrase_terms(keywords, "keyword").select("term").distinct().collect())
        wanted = F.array(*[F.lit(t) for t in asked]) if asked else F.array().cast("array<string>")
        toks = spread(self.news.select("title")).select(analyze(F.col("title")).alias("toks")).where(F.size("toks") > 0)
        seen = self._stage(toks.select(F.size("toks").alias("dl"), F.array_intersect("toks", wanted).alias("terms")), "title-terms")
        n, avgdl = seen.agg(F.count(F.lit(1)), F.avg("dl")).collect()[0]
        return int(n), float(avgdl or 0.0), seen.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))

    def newest(self, keywords: DataFrame, rows: int = NEWEST_ROWS) -> DataFrame:
        """First ``rows`` matches by created time desc (missing last); then rows
        without doc id are skipped and a repeated doc id keeps its last row.
        Returns (keyword, doc_id, score = P13 of created time)."""
        w = Window.partitionBy("keyword").orderBy(F.col("created_time").desc_nulls_last(), F.col("row_id").asc())
        page = self.matches(keywords).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(rows))
        page = page.where(F.col("doc_id").isNotNull())
        last = page.groupBy("keyword", "doc_id").agg(F.max_by("created_time", "_r").alias("created_time"))
        return last.select("keyword", "doc_id", time_score(F.col("created_time")).alias("score"))

    def _by_relevance(self, keywords: DataFrame) -> DataFrame:
        """Phrase matches with their BM25 score.

        Only phrase matches are ranked, so only they are scored: one
        (term, doc) lookup per keyword term and match, never a pair per doc of
        a frequent term.
        """
        n, avgdl, df = self.statistics(keywords)
        qt = phrase_terms(keywords, "keyword").groupBy("keyword", "term").agg(F.count(F.lit(1)).alias("qtf")).join(df, "term")
        m = self.matches(keywords)
        found = m.select("keyword", "row_id").join(qt, "keyword").join(self.phrase.postings, ["term", "row_id"])
        raw = found.groupBy("keyword", "row_id").agg(F.sum(F.col("qtf") * bm25(n, avgdl, F.size("positions"))).alias("raw"))
        scored = raw.select("keyword", "row_id", F.round("raw", SCORE_DIGITS).alias("score"))
        return m.join(scored, ["keyword", "row_id"], "left").fillna(0.0, ["score"])

    def relevance(self, keywords: DataFrame, rows: int = RELEVANCE_ROWS) -> DataFrame:
        """First ``rows`` matches by BM25 score (desc, row asc); constant score 1.0."""
        w = Window.partitionBy("keyword").orderBy(F.col("score").desc(), F.col("row_id").asc())
        page = self._by_relevance(keywords).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(rows))
        page = page.where(F.col("doc_id").isNotNull())
        return page.select("keyword", "doc_id").distinct().withColumn("score", F.lit(1.0))

    def num_found(self, keywords: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
        """(keyword, num_found over all matches, page_size = min(rows, num_found))."""
        counts = self.matches(keywords).groupBy("keyword").agg(F.count(F.lit(1)).alias("num_found"))
        j = keywords.select("keyword").distinct().join(counts, "keyword", "left").fillna(0, ["num_found"])
        return j.select("keyword", "num_found", F.least(F.col("num_found"), F.lit(rows).cast("bigint")).alias("page_size"))


# ---------------------------------------------------------------------------
# Channels
# ---------------------------------------------------------------------------
def channel_ids(lists: DataFrame, json_col: str = "json", key: str = CHANNEL_ID_KEY, carry: Sequence[str] = ("event_id",)) -> DataFrame:
    """(carry..., idx, channel_id) - elements lacking the key are skipped; order and duplicates kept."""
    arr = F.from_json(F.col(json_col), "array<map<string,string>>")
    ids = F.transform(F.filter(arr, lambda m: F.map_contains_key(m, F.lit(key))), lambda m: F.try_element_at(m, F.lit(key)))
    return lists.select(*carry, F.posexplode(ids).alias("idx", "channel_id")).withColumn("idx", F.col("idx").cast("bigint"))


def decode_channels(texts: DataFrame, value_col: str = "value", carry: Sequence[str] = ("event_id",)) -> tuple[DataFrame, DataFrame]:
    """``a:1~b:2`` -> rows (carry..., channel, value); an item without value rejects the record.

    Java split semantics: trailing empty parts are dropped before use.  A
    repeated channel keeps its last value; separators alone are an empty map.
    """
    body = F.regexp_replace(F.col(value_col), "~+$", "")
    parts = F.when(F.col(value_col).rlike("^~+$"), F.array().cast("array<string>")).otherwise(F.split(body, "~", -1))
    items = F.transform(parts, lambda it: F.split(F.regexp_replace(it, ":+$", ""), ":", -1))
    bad = F.exists(items, lambda p: F.size(p) < 2) | F.col(value_col).isNull()
    parsed = texts.select(*carry, items.alias("items"), bad.alias("_bad"))
    rejects = parsed.where("_bad").select(*carry, F.lit("missing_value").alias("reason"))
    rows = parsed.where(~F.col("_bad")).select(*carry, F.posexplode("items").alias("pos", "p"))
    rows = rows.select(*carry, "pos", F.get(F.col("p"), 0).alias("channel"), F.get(F.col("p"), 1).alias("value"))
    last = rows.groupBy(*carry, "channel").agg(F.max_by("value", "pos").alias("value"))
    return last, rejects


def channel_topk(cache: DataFrame, k: int) -> DataFrame:
    """A4: per channel the k largest (score desc, item asc) pairs, then duplicate items collapse (max score).

    The literal ``k`` lets Spark trim every map task to k rows per channel
    before the shuffle, so a channel holding a third of the cache costs k rows
    per task, not a third of the data in one task.
    """
    w = Window.partitionBy("channel").orderBy(F.col("score").desc(), F.col("item_id").asc())
    top = cache.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(k))
    return top.groupBy("channel", "item_id").agg(F.max("score").alias("score"))
