"""A catalogue's text indexes as posting files laid out by term, in generations (J1-J3, T-1).

The store is a folder on shared storage.  Every change of the catalogue adds a
*segment*; a *version* lists the segments that make up the catalogue at one
time.  Nothing written is changed later, so a reader keeps the version that it
picked while a writer adds the next.

Segment ``seg=<s>``, for each text field:

* ``postings/bucket=<b>``: (term, tier, slot, id, payload..., tf, dl), bucket =
  hash of the term, files sorted by (term, tier).  A *tier* is a class of
  similar weight, (tf, log2 dl); a tier of more than ``BLOCK_ROWS`` postings is
  cut into slots by a hash of the id, so a term in a third of the catalogue
  is many blocks.
* ``blocks/bucket=<b>``: (term, tier, slot, n, max_tf, min_dl): what a block can
  weigh at most under any statistics.
* ``df/bucket=<b>``: (term, change): by how much the segment changes a term's
  document frequency, taking back what the versions it replaces had counted.

and, for the segment, ``docs`` (id, payload..., tokens of each field) and ``dead``
(ids whose earlier rows no longer count: replaced or removed).

Weights are not stored: N, average length and df belong to a version, so a
match over a base and its deltas scores exactly as a full rebuild would.

A match (BM25 as in ``coldflow.operators.match``) reads only the buckets of its
terms (a partition filter of at most ``MAX_BUCKETS`` numbers; their number follows the base's rows), and of those only
blocks that can hold a top-k row:

1. probe: the heaviest blocks of each query's rarest term that hold k rows
   give a lower bound theta of the k-th score;
2. terms are sorted by their bounds; those whose bounds sum below theta cannot
   lift a row into the top k alone, so candidates come from the other terms,
   and of these only from blocks whose bound plus all other terms' bounds
   reaches theta; of a block's rows, those whose own weight plus the other terms' bounds
   does, and if it only ties with theta, those with an id up to the k-th probed one's
   (very many rows may have the same best score);
3. candidates are scored exactly by (term, id) lookups.

The blocks that a match needs are few beside the postings: up to ``SMALL_BYTES`` of them are broadcast, so the
pairs are made where the postings are read, however few tasks the queries themselves would fill.

Rows: an id that repeats within one change counts once (its greatest row);
rows without an id, and without any term, are not indexed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coldflow.functions.text import analyze
from coldflow.operators.match import B, K1, PRUNE_MARGIN, SCORE_DIGITS, top_k
from coldflow.session import path_exists, spread, stage_table

MIN_BUCKETS, MAX_BUCKETS = 8, 4096
BUCKET_ROWS = 50_000
BLOCK_ROWS = 16_384
LENGTH_CLASSES = 16
TF_CLASSES = 4
SMALL_BYTES = 16 << 20
SMALL_PAIRS = 100_000
ROUND_MARGIN = 1e-8  # more than the error of a sum of weights

_VERSION = "version long, segments array<long>, stats map<string, struct<n: long, sum_dl: long>>, buckets int, types map<string, string>"


def tier_of(tf: str = "tf", dl: str = "dl"):
    length = F.least(F.floor(F.log2(F.col(dl))), F.lit(LENGTH_CLASSES - 1))
    return (length * TF_CLASSES + F.least(F.col(tf), F.lit(TF_CLASSES)) - 1).cast("int")


def weight(idf, tf, dl, avgdl: float):
    return idf * tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * dl / F.lit(avgdl or 1.0)))


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass
class CatalogueStore:
    """Writer and reader of a catalogue's posting store."""

    path: str
    id_col: str = "item_id"
    fields: tuple[str, ...] = ("name", "singer")
    payload: tuple[str, ...] = ("fire",)
    buckets: int | None = None  # of a new base; None: by its rows

    # -- versions ----------------------------------------------------------
    def versions(self, spark: SparkSession) -> list:
        """Rows (version, segments, stats) of all versions, oldest first."""
        if not path_exists(spark, f"{self.path}/versions"):
            return []
        rows = spark.read.schema(_VERSION).json(f"{self.path}/versions/*").collect()
        return sorted(rows, key=lambda r: r["version"])

    def snapshot(self, spark: SparkSession, version: int | None = None) -> Snapshot:
        """The newest version (or a given one) as it is now; a later change does not touch it."""
        found = [r for r in self.versions(spark) if version is None or r["version"] == version]
        if not found:
            raise ValueError(f"no version {'' if version is None else version} in {self.path}")
        r = found[-1]
        stats = {f: (r["stats"][f]["n"], r["stats"][f]["sum_dl"]) for f in self.fields}
        return Snapshot(self, spark, r["version"], list(r["segments"]), stats, r["buckets"], r["types"])

    def _publish(self, spark: SparkSession, snap: Snapshot) -> int:
        version = snap.version
        row = (version, snap.segments, {f: (n, dl) for f, (n, dl) in snap.stats.items()}, snap.buckets, snap.types)
        spark.createDataFrame([row], _VERSION).coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/v{version}")
        return version

    # -- writing -----------------------------------------------------------
    def build(self, docs: DataFrame) -> int:
        """A version of ``docs`` alone (id, fields..., payload...): the base, or a rebuild of everything."""
        spark = docs.sparkSession
        known = self.versions(spark)
        version = known[-1]["version"] + 1 if known else 0
        self._write_docs(docs, version)
        return self._publish(spark, self._base(spark, version))

    def apply(self, changes: DataFrame) -> int:
        """The next version: ``changes`` (id, fields..., payload..., deleted) replaces, adds or removes rows by id."""
        spark = changes.sparkSession
        old = self.snapshot(spark)
        version = old.version + 1
        changes = stage_table(changes.where(F.col(self.id_col).isNotNull()), "catalogue-changes")
        changes.select(self.id_col).distinct().write.mode("overwrite").parquet(f"{self.path}/seg={version}/dead")
        self._write_docs(changes.where(~F.coalesce(F.col("deleted"), F.lit(False))), version)
        new = Snapshot(self, spark, version, [*old.segments, version], {}, old.buckets, old.types)
        self._index(new, old)
        return self._publish(spark, new)

    def compact(self, spark: SparkSession) -> int:
        """The newest version's live rows as one base segment."""
        old = self.snapshot(spark)
        version = old.version + 1
        old.docs().drop("seg").write.mode("overwrite").parquet(f"{self.path}/seg={version}/docs")
        return self._publish(spark, self._base(spark, version))

    def _base(self, spark: SparkSession, version: int) -> Snapshot:
        docs = spark.read.parquet(f"{self.path}/seg={version}/docs")
        buckets = self.buckets or min(MAX_BUCKETS, max(MIN_BUCKETS, docs.count() // BUCKET_ROWS))
        types = {c: docs.schema[c].dataType.simpleString() for c in (self.id_col, *self.payload)}
        snap = Snapshot(self, spark, version, [version], {}, buckets, types)
        self._index(snap, None)
        return snap

    def _write_docs(self, docs: DataFrame, seg: int) -> None:
        rest = [*self.payload, *self.fields]
        one = docs.where(F.col(self.id_col).isNotNull()).groupBy(self.id_col).agg(F.max(F.struct(*rest)).alias("r"))
        toks = [F.coalesce(analyze(F.col(f"r.{f}")), F.array().cast("array<string>")).alias(f) for f in self.fields]
        rows = spread(one).select(self.id_col, *[F.col(f"r.{p}").alias(p) for p in self.payload], *toks)
        rows.write.mode("overwrite").parquet(f"{self.path}/seg={seg}/docs")

    def _index(self, new: Snapshot, old: Snapshot | None) -> None:
        """Write the index files of the newest segment of ``new`` and fill in its statistics."""
        spark, seg = new.spark, new.segments[-1]
        docs = spark.read.parquet(f"{self.path}/seg={seg}/docs")
        gone = None
        if old is not None:
            dead = spark.read.parquet(f"{self.path}/seg={seg}/dead")
            gone = stage_table(old.docs().join(dead, self.id_col, "left_semi"), "catalogue-replaced")
        for f in self.fields:
            base = f"{self.path}/seg={seg}/{f}"
            tf = self._terms(docs, f)
            tf = stage_table(tf.withColumn("tier", tier_of()), "catalogue-terms")
            size = tf.groupBy("term", "tier").agg(F.count(F.lit(1)).alias("_n"))
            cut = F.ceil(F.col("_n") / F.lit(BLOCK_ROWS)).cast("int")
            post = tf.join(size, ["term", "tier"]).withColumn("slot", F.pmod(F.xxhash64(self.id_col), cut).cast("int")).drop("_n")
            out = post.withColumn("bucket", new.bucket()).repartition("bucket", "slot").sortWithinPartitions("bucket", "term", "tier")
            out.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/postings")
            post = new.segment(seg, f, "postings")
            blocks = post.groupBy("bucket", "term", "tier", "slot").agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"))
            self._by_bucket(blocks, f"{base}/blocks")
            change = tf.select("term", F.lit(1).alias("c"))
            if gone is not None:
                change = change.unionByName(self._terms(gone, f).select("term", F.lit(-1).alias("c")))
            df = change.groupBy("term").agg(F.sum("c").alias("change")).where("change <> 0")
            self._by_bucket(df.withColumn("bucket", new.bucket()), f"{base}/df")
            n, dl = self._size(docs, f)
            if old is not None:
                less_n, less_dl = self._size(gone, f)
                n, dl = n + old.stats[f][0] - less_n, dl + old.stats[f][1] - less_dl
            new.stats[f] = (n, dl)

    def _by_bucket(self, rows: DataFrame, path: str) -> None:
        rows.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _terms(self, docs: DataFrame, field: str) -> DataFrame:
        x = docs.select(self.id_col, *self.payload, F.size(field).alias("dl"), F.explode(field).alias("term"))
        return x.groupBy("term", self.id_col, *self.payload, "dl").agg(F.count(F.lit(1)).cast("int").alias("tf"))

    def _size(self, docs: DataFrame, field: str) -> tuple[int, int]:
        r = docs.where(F.size(field) > 0).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(field)), F.lit(0))).collect()[0]
        return int(r[0]), int(r[1])


class Snapshot:
    """One version of the catalogue."""

    def __init__(self, store: CatalogueStore, spark: SparkSession, version: int, segments: list[int], stats: dict[str, tuple[int, int]], buckets: int, types: dict[str, str]):
        self.store, self.spark, self.version, self.segments, self.stats = store, spark, version, segments, stats
        self.buckets, self.types = buckets, types

    def bucket(self):
        """The bucket of a term."""
        return F.pmod(F.xxhash64("term"), F.lit(self.buckets)).cast("int")

    def segment(self, seg: int, field: str, kind: str) -> DataFrame:
        """postings, blocks or df of a segment; the schema is given, as a segment without rows has no file to show it."""
        s = self.store
        own = ", ".join(f"`{c}` {self.types[c]}" for c in (s.id_col, *s.payload))
        columns = {
            "postings": f"term string, {own}, dl int, tf int, tier int, slot int",
            "blocks": "term string, tier int, slot int, n long, max_tf int, min_dl int",
            "df": "term string, change long",
        }
        return self.spark.read.schema(f"{columns[kind]}, bucket int").parquet(f"{s.path}/seg={seg}/{field}/{kind}")

    def table(self, field: str, kind: str) -> DataFrame:
        """postings, blocks or df of all segments, with the segment's number."""
        return union([self.segment(n, field, kind).withColumn("seg", F.lit(n)) for n in self.segments])

    @cached_property
    def deltas(self) -> list[int]:
        """Segments that replace or remove earlier rows."""
        return [n for n in self.segments if path_exists(self.spark, f"{self.store.path}/seg={n}/dead")]

    def dead(self) -> DataFrame | None:
        """(id, dead_before): rows of the id in segments before that one do not count; None without deltas."""
        if not self.deltas:
            return None
        rows = union([self.spark.read.parquet(f"{self.store.path}/seg={n}/dead").withColumn("seg", F.lit(n)) for n in self.deltas])
        return rows.groupBy(self.store.id_col).agg(F.max("seg").alias("dead_before"))

    def live(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, seg, ...) without those that a later segment replaced or removed."""
        dead = self.dead()
        if dead is None:
            return rows
        return rows.join(dead, self.store.id_col, "left").where(F.col("dead_before").isNull() | (F.col("seg") >= F.col("dead_before"))).drop("dead_before")

    def docs(self) -> DataFrame:
        """The live rows (id, payload..., tokens of the fields, seg)."""
        return self.live(union([self.spark.read.parquet(f"{self.store.path}/seg={n}/docs").withColumn("seg", F.lit(n)) for n in self.segments]))

    def field(self, name: str) -> FieldIndex:
        return FieldIndex(self, name)


@dataclass
class FieldIndex:
    """One text field of a snapshot, to be matched (``coldflow.operators.match.match``)."""

    snapshot: Snapshot
    name: str

    @property
    def id_col(self) -> str:
        return self.snapshot.store.id_col

    @property
    def payload(self) -> tuple[str, ...]:
        return self.snapshot.store.payload

    def _rows(self, kind: str, buckets: list[int]) -> DataFrame:
        rows = self.snapshot.table(self.name, kind)
        return rows.where(F.col("bucket").isin(buckets) if buckets else F.lit(False))

    def query_blocks(self, queries: DataFrame, text_col: str) -> tuple[DataFrame, list[int]]:
        """(a row for each text, term and block with what the pruning needs, buckets read).

        block_bound and bound: what a row of the block, or of any block of the term, can score by this term;
        upto: the sum of the bounds up to this term's, in their order; all_bounds: of all terms;
        rarest: the text's term with the fewest postings; above: rows in the term's heavier blocks;
        lead: on one row of each (text, term).
        """
        n_docs, sum_dl = self.snapshot.stats[self.name]
        texts = queries.select(F.col(text_col).alias("q")).where(F.col(text_col).isNotNull()).distinct()
        terms = texts.select("q", F.explode(analyze(F.col("q"))).alias("term")).groupBy("q", "term").agg(F.count(F.lit(1)).alias("qtf"))
        terms = terms.withColumn("bucket", self.snapshot.bucket())
        buckets = sorted(r[0] for r in terms.select("bucket").distinct().collect())  # as many as the store has at most
        df = self._rows("df", buckets).groupBy("bucket", "term").agg(F.sum("change").alias("df")).where("df > 0")
        idf = F.log(F.lit(1.0) + (F.lit(float(n_docs)) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
        blocks = self._rows("blocks", buckets).groupBy("bucket", "term", "tier", "slot").agg(F.sum("n").alias("n"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"))
        x = terms.join(df, ["bucket", "term"]).withColumn("idf", idf).drop("df").join(blocks, ["bucket", "term"])
        x = x.withColumn("block_bound", F.col("qtf") * weight(F.col("idf"), F.col("max_tf"), F.col("min_dl"), sum_dl / n_docs if n_docs else 0.0))
        own = Window.partitionBy("q", "term")
        heavier = own.orderBy(F.col("block_bound").desc(), "tier", "slot")
        x = x.withColumn("bound", F.max("block_bound").over(own)).withColumn("postings", F.sum("n").over(own))
        x = x.withColumn("above", F.coalesce(F.sum("n").over(heavier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        x = x.withColumn("lead", F.row_number().over(heavier) == 1)
        once = F.when(F.col("lead"), F.col("bound"))
        ascending = Window.partitionBy("q").orderBy("bound", "term").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("upto", F.sum(once).over(ascending)).withColumn("all_bounds", F.sum(once).over(Window.partitionBy("q")))
        x = x.withColumn("rarest", F.first("term").over(Window.partitionBy("q").orderBy("postings", "term")))
        return x.drop("max_tf", "min_dl", "postings"), buckets

    def candidates(self, blocks: DataFrame, buckets: list[int], k: int, prune: bool = True, few: bool = False) -> DataFrame:
        """(q, id, seg) of rows that can be in a text's top k, from staged ``query_blocks``; ``few``: these may be broadcast."""
        key = ["bucket", "term", "tier", "slot"]
        posting = self._rows("postings", buckets).select(*key, self.id_col, "seg", "tf", "dl")
        rows = lambda chosen: posting.hint("merge").join(F.broadcast(chosen) if few else chosen, key)
        pairs = ["q", self.id_col, "seg"]
        if not prune:
            return self.snapshot.live(rows(blocks.select("q", *key)).select(*pairs).distinct())
        # a lower bound of the k-th score: the heaviest blocks of the rarest term, until they hold k rows
        probe = self.snapshot.live(rows(blocks.where((F.col("term") == F.col("rarest")) & (F.col("above") < k)).select("q", *key)).select(*pairs))
        best = top_k(self.scored(self.scores(probe, blocks, buckets, few)), ["q"], self.id_col, k)
        theta = best.where(F.col("rank") == k).select("q", F.col("score").alias("theta"), F.col(self.id_col).alias("theta_id"))
        least = F.coalesce(F.col("theta") - F.lit(PRUNE_MARGIN), F.lit(float("-inf")))
        others = F.col("all_bounds") - F.col("bound")
        chosen = blocks.join(F.broadcast(theta) if few else theta, "q", "left").where((F.col("upto") >= least) & (F.col("block_bound") + others >= least))
        at_most = F.col("qtf") * self._weight() + F.col("others")
        beats = F.round(at_most + F.lit(ROUND_MARGIN), SCORE_DIGITS) > F.col("theta")
        can = F.col("theta").isNull() | beats | ((at_most >= least) & (F.col(self.id_col) <= F.col("theta_id")))
        found = rows(chosen.select("q", *key, "qtf", "idf", others.alias("others"), "theta", "theta_id")).where(can)
        return self.snapshot.live(found.select(*pairs).distinct())

    def _weight(self):
        n_docs, sum_dl = self.snapshot.stats[self.name]
        return weight(F.col("idf"), F.col("tf"), F.col("dl"), sum_dl / n_docs if n_docs else 0.0)

    def scores(self, pairs: DataFrame, blocks: DataFrame, buckets: list[int], few: bool = False, few_pairs: bool = False) -> DataFrame:
        """(q, id, payload..., raw): exact BM25 of (q, id, seg) pairs; ``few_pairs``: these may be broadcast, so postings stay where they are read."""
        lead = blocks.where("lead").select("q", "bucket", "term", "qtf", "idf")
        asked = pairs.join(F.broadcast(lead) if few else lead, "q")
        posting = self._rows("postings", buckets).drop("tier", "slot")
        key = ["bucket", "term", self.id_col, "seg"]
        found = posting.join(F.broadcast(asked), key) if few_pairs else asked.join(posting.hint("merge"), key)
        return found.groupBy("q", self.id_col, *self.payload).agg(F.sum(F.col("qtf") * self._weight()).alias("raw"))

    def scored(self, rows: DataFrame) -> DataFrame:
        return rows.select("q", self.id_col, *self.payload, F.round("raw", SCORE_DIGITS).alias("score"))

    def match(self, queries: DataFrame, text_col: str, k: int, stage: Callable = stage_table, prune: bool = True) -> DataFrame:
        """(text, id, payload..., score, rank), top k rows of each distinct text."""
        blocks, buckets = self.query_blocks(queries, text_col)
        blocks = stage(blocks, f"{self.name}-blocks")
        size = blocks.agg(F.sum(F.octet_length("q") + F.octet_length("term") + F.lit(100))).collect()[0][0] or 0
        few = size <= SMALL_BYTES
        pairs = self.candidates(blocks, buckets, k, prune, few)
        few_pairs = False
        if few and prune:  # usually little more than k rows a text are left
            pairs = stage(pairs, f"{self.name}-pairs")
            few_pairs = pairs.count() <= SMALL_PAIRS
        scored = self.scored(self.scores(pairs, blocks, buckets, few, few_pairs))
        return top_k(scored.withColumnRenamed("q", text_col), [text_col], self.id_col, k)
