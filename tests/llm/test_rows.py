"""Rows with null or repeated ids in the mix and in the pipeline's stages."""

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from coldflow.llm import mixing, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def first_fit(sizes_by_id, room):
    """Ids in md5 order that fit, one after the other."""
    taken = []
    for i, n in sorted(sizes_by_id, key=lambda x: (hashlib.md5(f"{mixing.SEED}|{x[0]}".encode()).hexdigest(), x[1])):
        if 0 < n <= room:
            room -= n
            taken.append((i, n))
    return sorted(taken)


def test_selection_is_first_fit(spark):
    sizes = [(i, 1 + (i * 7919) % 900) for i in range(300)] + [(500, 20_000), (501, 0)]
    got = mixing.mix(spark.createDataFrame(sizes, "doc_id long, size long").withColumn("source", F.lit("s")), F.col("size"), F.array("source"), (1,)).collect()
    total = sum(n for _, n in sizes)
    assert got[0]["target"] == 1.5 * total
    assert sorted((r["doc_id"], r["size"]) for r in got if r["copies"] == 2) == first_fit(sizes, int(1.5 * total) - total)


def test_a_repeated_row_is_one_choice_each(spark):
    rows = [(1, 500, "s"), (1, 500, "s"), (2, 300, "s"), (3, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string").fillna(0, ["size"])
    got = mixing.mix(df, F.col("size"), F.array("source"), (1,)).collect()
    taken = sum(r["taken"] for r in got)
    assert len(got) == 4 and taken <= got[0]["target"] == 1950 and taken in (1600, 1800)


def test_documents_without_sources_are_not_taken(spark):
    df = spark.createDataFrame([(1, 10, None), (2, 20, ["a"]), (3, 5, [None])], "doc_id long, size long, s array<string>")
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, F.col("size"), F.col("s"), (1,)).collect()}
    assert got[1] == 0 and got[2] > 0 and got[3] > 0


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


def _text(word, last="end"):
    return " ".join(f"{word}{i}" for i in range(40)) + " " + last


def _left(stage, spark, rows):
    return sorted(((r["doc_id"], r["text"]) for r in stage(spark, _docs(spark, rows), SF).collect()), key=str)


def test_near_duplicates_of_repeated_and_null_ids(spark):
    a, b, c = _text("a"), _text("b"), _text("c")
    near = lambda x: _text(x, "other")
    keep = lambda rows: _left(corpus_pipeline.drop_near_duplicates, spark, rows)
    assert keep([(1, a), (2, near("a")), (2, b)]) == [(1, a), (2, b)]
    assert keep([(1, c), (2, a), (2, near("c")), (3, near("a"))]) == [(1, c), (2, a)]
    assert keep([(None, a), (5, a), (None, b), (7, None), (7, ""), (8, b), (8, b)]) == [(5, a), (7, ""), (7, None), (8, b)]


def test_leaks_under_a_null_id_go(spark):
    leak = queries.table(spark, SF, "benchmark").where("length(text) > 60").collect()[0]["text"]
    rows = [(None, f"before {leak} after"), (None, _text("clean")), (4, _text("d")), (4, f"x {leak}")]
    assert _left(corpus_pipeline.drop_contaminated, spark, rows) == sorted([(None, _text("clean")), (4, _text("d"))], key=str)


def test_the_mix_keeps_rows_without_an_id(spark):
    rows = [(None, "w " * 90), (None, "w " * 90), (3, "v " * 10), (3, "u " * 10)]
    left = _left(corpus_pipeline.mix_sources, spark, rows)
    words = sum(len(t.split()) for _, t in left)
    assert words <= 300 and set(left) == set(_left(lambda s, d, _: d, spark, rows)) and words >= 220


def test_pages_without_an_id_come_back(spark):
    from coldflow.llm import warc

    queries.importable(spark)
    long = b"x" * 200
    rows = [(None, "u", long), (None, "u", long), (7, "u", long), (3, "u", long), (None, "u", None), (4, "u", b"y" * 150)]
    records = spark.createDataFrame(rows, "record_id long, url string, payload binary")
    path = warc.new_archive(spark)
    got = warc.read(spark, path, warc.write(records, path)).collect()
    assert sorted(((r["record_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(
        [(None, 200, "response", None), (None, 200, "response", None), (7, 200, "revisit", 3), (3, 200, "response", None), (None, 0, "response", None), (4, 150, "response", None)], key=str
    )


def test_pages_are_read_by_several_tasks(spark, monkeypatch):
    from coldflow.llm import warc

    monkeypatch.setattr(warc, "MAX_RANGE", 2000)
    queries.importable(spark)
    records = spark.range(300).select(F.col("id").alias("record_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("payload"))
    path = warc.new_archive(spark)
    back = warc.read(spark, path, warc.write(records, path))
    assert back.rdd.getNumPartitions() > 5 and sorted(r["record_id"] for r in back.collect()) == list(range(300))


def test_queries_in_small_clusters_get_all_their_rows(spark):
    import numpy as np

    from coldflow.llm import ann

    rng = np.random.default_rng(12)
    centres = rng.standard_normal((16, 24)) * 6
    sizes = [360] * 8 + [3] * 8
    x = np.concatenate([c + 0.05 * rng.standard_normal((n, 24)) for c, n in zip(centres, sizes, strict=True)])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, probes=1).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(range(0, len(x), 20)) and all(len(set(v)) == 20 for v in got.values())


def test_ann_memory_does_not_grow_with_lists(spark, monkeypatch):
    import tracemalloc

    import numpy as np

    from coldflow.llm import ann

    rng = np.random.default_rng(5)
    index = ann.Index(np.eye(9), rng.standard_normal((4096, 9)).astype(np.float32), 1.0)
    placed = rng.standard_normal((10_000, 9)).astype(np.float32)
    tracemalloc.start()
    near = index.nearest_lists(placed, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # distances to all centroids at once: 164 MB, their order as much again
    assert near[77].tolist() == np.argsort(((index.centroids - placed[77]) ** 2).sum(axis=1))[:3].tolist()

    # a query goes to a bundle of lists once, not to every list, and every true neighbour is found if all lists are asked
    staged, stage = {}, ann.stage_table
    monkeypatch.setattr(ann, "stage_table", lambda df, name: staged.setdefault(name, stage(df, name)))
    monkeypatch.setattr(ann, "LIST_ROWS", 16)
    x = rng.standard_normal((1600, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=5, probes=100).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert staged["ann-asked"].count() <= 80 * 8
    for q in range(0, 1600, 20):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        best = np.argsort(-score)[:5].tolist()
        assert len(set(best) & set(got[q].values())) >= 4 and got[q][1] == best[0]
