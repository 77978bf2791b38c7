"""Each operator against brute force, an exact round trip or held-out accuracy, with the odd cases of ``docs``."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from coldflow.llm import ann, decontam, encode, huffman, jaccard, langid, mixing, queries, substring, token_counts, toxicity, warc
from coldflow.llm.text import blocks, column_bytes
from tests.llm.conftest import TEXTS
from tests.test_oracle import _rows

SF = "/root/testdata/sf0.001"
VOCAB = queries.vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCAB)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_encoder_equals_library(tokenizer):
    rng = np.random.default_rng(5)
    bits = ["a", "é", " ", "  ", "\n", " ", " ", ".", "'s", "12", "日", "\x1c", "\t", "<|endoftext|>", "²", "é", "word", "\r\n", "!?"]
    texts = [t or "" for _, t in TEXTS] + ["".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(1500)]
    data, offsets = column_bytes(pa.array(texts))
    enc = encode.encoder(VOCAB)
    ids, count = enc.block(data, offsets)
    for t, own in zip(texts, np.split(ids, np.cumsum(count)[:-1]), strict=True):
        assert own.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
        assert enc.id_bytes[own].sum() == len(t.encode())


def test_blocks_cover_all_rows():
    offsets = np.array([0, 5, 5, 400, 401, 1000])
    assert [list(range(*r)) for r in blocks(offsets, 100)] == [[0, 1], [2], [3], [4]]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, no_docs, tokenizer, rule):
    got = token_counts.attribute(docs, VOCAB, rule=rule).collect()
    texts = dict(TEXTS)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d, rows in by_doc.items():
        if d == 9:
            rows = rows[: len(rows) // 2]
        assert sum(r["n_tokens"] for r in rows) == pytest.approx(len(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids))
        assert rows[0]["doc_tokens"] == len(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids)
    assert token_counts.attribute(no_docs, VOCAB, rule=rule).count() == 0


def test_token_boundaries():
    ends, begin, end = np.array([4, 8, 12]), np.array([0, 6]), np.array([6, 12])
    for rule, want in (("start", [2, 1]), ("end", [1, 2]), ("share", [1.5, 1.5])):
        n, crossing = token_counts.allocate(ends, begin, end, rule)
        assert n.tolist() == want and crossing.tolist() == [1, 1]


def test_token_counts_of_fields(spark, docs):
    rows = spark.createDataFrame([(1, "Title here", "body text"), (2, None, "only")], "doc_id long, a string, b string")
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.attribute_fields(rows, VOCAB, ["a", "b"]).collect()}
    assert got[(2, 0)] == 0 and got[(1, 0)] == 2 and set(got) == {(1, 0), (1, 1), (2, 0), (2, 1)}


def test_targets_stop_at_their_cap():
    t = mixing.targets([100, 10, 40], [3, 1, 2], 225, 2)
    assert t[1] == 20 and t[2] <= 80 and sum(t) == pytest.approx(225)


def test_min_cost_flow_prefers_unused_documents():
    # pattern 0 serves both sources, pattern 1 only the second: units move so that nothing is repeated
    assert mixing.min_cost_flow([10, 10], [10, 10], [[0, 1], [1]], 2) == [10, 10]
    assert mixing.min_cost_flow([10, 10], [15, 5], [[0, 1], [1]], 2) == [15, 5]
    assert sum(mixing.min_cost_flow([5, 5, 5], [9, 30], [[0], [0, 1], [1]], 2)) == 29


def test_mixing(docs, no_docs):
    got = queries.mixed(docs).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert all(r["size"] == len(words(dict(TEXTS)[r["doc_id"]])) for r in got)
    again = queries.mixed(docs).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert queries.mixed(no_docs).count() == 0


def test_mixing_goes_on_behind_a_document_that_does_not_fit(spark):
    # three sources of 1,000 documents of 200 words and one of 300,000, first, in the middle and last in md5 order: half of a source's 500,000 words is to come again
    ids = sorted(range(3003), key=lambda i: hashlib.md5(f"{mixing.SEED}|{i}".encode()).hexdigest())
    rows = [(i, 300_000 if k // 3 == long else 200, f"s{k % 3}") for long, s in ((0, 0), (500, 1), (1000, 2)) for k, i in enumerate(ids) if k % 3 == s]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string")
    got = mixing.mix(df, F.col("size"), F.array("source"), (1,)).groupBy("sources", "target").agg(F.sum("taken")).collect()
    assert sorted((r[0][0], r[1], r[2]) for r in got) == [(f"s{k}", 750_000, 700_000) for k in range(3)]


def test_mixing_leaves_no_document_that_fits(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(2 ** rng.uniform(0, 16)), f"s{i % 4}") for i in range(2000)] + [(7, 11, "s0"), (None, 5, None), (None, 5, None), (None, 0, "s1")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, size long, source string"), F.col("size"), F.array("source"), (3, 1, 2)).collect()
    assert len(got) == len(rows)
    for s in {r["sources"][0] for r in got}:
        own = [r for r in got if r["sources"][0] == s]
        gap = int(own[0]["target"]) - sum(r["taken"] for r in own)
        least = min(r["copies"] for r in own if r["size"])
        assert gap >= 0 and not any(0 < r["size"] <= gap and r["copies"] == least < 2 for r in own), s


def test_ann_finds_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24))
    x[1000:1200] = x[7]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2003, [None] * 24)]
    rows.append(rows[3])
    got = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(1))
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert len(got) == 75
    hits = 0
    for q, near in got.items():
        near.sort()
        score = x @ x[q]
        best = sorted((i for i in range(1500) if i != q), key=lambda i: (-score[i], i))[:20]
        assert len(near) == 20 and all(s == pytest.approx(score[v]) for _, v, s in near)
        hits += len(set(best) & {v for _, v, _ in near})
    assert hits >= 0.9 * 20 * len(got)
    assert ann.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.search(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]


def test_warc_round_trip(spark):
    queries.importable(spark)
    long = ("<html>" + "é" * 300).encode()
    rows = [(5, "http://a/", long), (3, None, long), (9, "http://b/\r\nx", b"tiny"), (8, "http://c/", b"tiny"), (1, "", None), (4, "u", b"\x00\xff" * 200)]
    records = spark.createDataFrame(rows, "record_id long, url string, payload binary")
    path = warc.new_archive(spark)
    index = warc.write(records, path)
    got = {r["record_id"]: r for r in warc.read(spark, path, index, keep_payload=True).collect()}
    for i, _, payload in rows:
        raw = payload or b""
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert got[i]["record_type"] == ("revisit" if i == 5 else "response") and got[i]["refers_to"] == (3 if i == 5 else None)
        assert i == 5 or got[i]["payload"] == raw
    one = warc.read(spark, path, index.where("record_id = 4"), keep_payload=True).collect()
    assert len(one) == 1 and one[0]["payload"] == b"\x00\xff" * 200
    empty = warc.new_archive(spark)
    assert warc.read(spark, empty, warc.write(records.where("false"), empty)).count() == 0


def test_wand_equals_exhaustive_scoring():
    rng = np.random.default_rng(1)
    n_units, n_terms = 120, 40
    weight = np.where(rng.random((n_terms, n_units)) < 0.2, rng.random((n_terms, n_units)), 0)
    lists = []
    for t in range(n_terms):
        u = np.flatnonzero(weight[t]).tolist()
        w = [float(weight[t, k]) for k in u]
        lists.append((u, w, [max(w[k : k + decontam.BLOCK]) for k in range(0, len(w), decontam.BLOCK)], [u[min(len(u), k + decontam.BLOCK) - 1] for k in range(0, len(u), decontam.BLOCK)]))
    shard = decontam.Shard(np.arange(n_terms), weight.max(axis=1), np.ones((n_terms, 1)), np.zeros(1), lists, np.arange(n_units), [], [], np.zeros(n_units))
    for _ in range(40):
        query = sorted(rng.choice([t for t in range(n_terms) if lists[t][0]], 12, replace=False).tolist())
        total = weight[query].sum(axis=0)
        assert {u for u, _ in decontam.wand(shard, query, 2.0)} == set(np.flatnonzero(total >= 2.0 - 1e-9).tolist())


def test_decontamination(spark, docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "Which animal jumps over the sleeping hound at dawn near river? A swift auburn fox."), (2, None), (3, ""), (4, "Name every prime below twelve and explain the sieve method used. Two three five seven eleven.")],
        "item_id long, text string",
    )
    leak = "Which animal jumps over the sleeping hound at dawn near river? A swift auburn fox."
    planted = spark.createDataFrame([(50, "pad " * 90 + leak.upper() + " pad" * 200), (51, leak.split("?")[0])], "doc_id long, text string")
    got = decontam.contaminated(docs.select("doc_id", "text").union(planted), bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(50, 1)]
    assert decontam.contaminated(no_docs, bench).count() == 0
    assert decontam.contaminated(docs, bench.where("false")).count() == 0


def test_decontamination_of_items_without_their_last_sentence(spark):
    start = "Which of the seven coastal provinces exported cedar timber before the harbour silted up, and who taxed the merchants that carried this cargo inland"
    items = [(1, start + "? Perhaps."), (2, "Été".join(start.split("e")) + "? It was the northern one."), (3, start.replace("a", "o") + ". No. Then a governor sent twelve clerks who wrote down every cart and boat, so nobody paid twice.")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    cut = [(10 * i, "pad " * 80 + t[: max(t.rfind("? "), t.rfind(". "))] + " pad" * 80) for i, t in items]
    clean = [(90, "the of and who that this seven provinces merchants " * 9), (91, "Perhaps. " * 30), (92, " ".join(start.split()[:8]) + " pad" * 80), (93, "It was the northern one. " * 5)]
    docs = spark.createDataFrame([*cut, (11, start + "? Hardly."), *clean], "doc_id long, text string")
    found = lambda bench: sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect())
    assert found(bench) == [(10, 1), (11, 1), (20, 2)]
    given = bench.where("item_id = 1").select("item_id", F.split("text", r"\? ")[0].alias("question"), F.lit("Perhaps.").alias("answer"))
    assert found(given) == []


def test_decontamination_finds_all_exact_leaks(spark):
    docs, bench = queries.table(spark, SF, "documents"), queries.table(spark, SF, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert got == {(d["doc_id"], i) for d in docs.collect() for i, t in items if d["text"] and t in d["text"]}


def test_suffix_automaton_parse_equals_brute_force():
    sample = {"a": ["the cat sat on the mat and the cat ran"], "b": ["der hund lief in den wald und der wald"]}
    models = langid.compile_models(sample)
    texts = [b"the hund sat in the wald", b"zzz", b"cat" * 200]

    def phrases(text, trained):
        n = 0
        for s in range(0, len(text), langid.SEGMENT):
            piece, at = text[s : s + langid.SEGMENT], 0
            while at < len(piece):
                k = 1
                while at + k < len(piece) and piece[at : at + k + 1] in trained:
                    k += 1
                at, n = at + k, n + 1
        return n

    for row, text in zip(langid.phrase_counts(texts, models), texts, strict=True):
        assert row.tolist() == [phrases(text, langid.normalise(sample[c][0])) for c in "ab"]


def test_language(spark, docs, no_docs):
    rows = queries.op6_language(spark, SF).join(queries.table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.9
    samples = {"en": ["the fox and the dog"], "fr": ["le renard et le chien"]}
    got = {r["doc_id"]: r for r in langid.predict(docs.select("doc_id", "text"), samples).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4))
    assert got[0]["lang_pred"] == "en" and langid.predict(no_docs.drop("score"), samples).count() == 0
    assert langid.sample(no_docs) == {}


def test_toxicity(spark, docs, no_docs):
    rows = queries.op7_toxicity(spark, "/root/testdata/sf0.1").join(queries.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    hit = [r["predicted"] == r["toxic"] for r in rows]
    assert np.mean(hit) > 0.95 and np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) < 0.01
    labels = spark.createDataFrame([(0, 1), (10, 0), (10, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, "s", "p").collect()
    assert len(scored) == len(TEXTS) and all(0 <= r["s"] <= 1 for r in scored)
    none = toxicity.fit(docs, labels.where("false"))
    assert all(r["p"] == 0 for r in toxicity.score(docs, none, "s", "p").collect())
    assert toxicity.score(no_docs, model, "s", "p").count() == 0


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1 << k for k in range(24)])
    lengths = huffman.code_lengths(counts, 12)
    assert lengths.max() <= 12 and sum(0.5**n for n in lengths) <= 1
    even = huffman.code_lengths(np.ones(8, int))
    assert even.tolist() == [3] * 8
    for n in (0, 1, 63, 64, 65, 1000):
        code = huffman.Code(np.arange(24), lengths)
        ids = np.random.default_rng(n).integers(0, 24, n).astype(np.uint32)
        assert code.decode(*code.encode(ids), n).tolist() == ids.tolist()


def test_token_files_round_trip(spark, docs, no_docs, tokenizer):
    got = sorted(queries.token_files(spark, docs).collect(), key=lambda r: r["start"])
    before = 0
    texts = sorted((d, t or "") for d, t in TEXTS)
    for r, (d, t) in zip(got, texts, strict=True):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)
    assert queries.token_files(spark, no_docs).count() == 0


def brute_components(rows):
    sets = []
    for d, t in rows:
        w = [x.translate(bytes(b + 32 if 65 <= b < 91 else b for b in range(256))) for x in words(t)]
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    label = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return sorted((d, len(s), min(sets[k][0] for k in range(len(sets)) if label[k] == label[i])) for i, (d, s) in enumerate(sets))


def test_jaccard(spark, docs, no_docs):
    assert sorted(map(tuple, jaccard.components(docs).collect())) == brute_components(TEXTS)
    assert jaccard.components(no_docs).count() == 0


def test_jaccard_chains_of_near_copies(spark):
    rng = np.random.default_rng(9)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(80):  # edits of edits, so that links chain
        base = [f"e{k}_{i}" if rng.random() < 0.012 else w for i, w in enumerate(base)]
        rows.append((1000 - k, " ".join(base)))
    rows += [(2000 + k, " ".join(f"n{k}_{i}" for i in range(60)) + " " + " ".join(f"t{i}" for i in range(50))) for k in range(20)]
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(rows)


def near_copies(n, words, changed, seed):
    """``n`` texts of one base, each with its own changes: many of them near the bound."""
    rng = np.random.default_rng(seed)
    return [" ".join(f"c{k}_{i}" if rng.random() < changed else f"t{i}" for i in range(words)) for k in range(n)]


def test_jaccard_part_returns_a_forest():
    n = 200
    sets = [np.sort(np.append(np.arange(100), 1000 + k)).astype("<u8").tobytes() for k in range(n)]  # all link with all
    part = pa.table({"tokens": pa.array(sets, pa.binary()), "g": [{"rep": k, "sid": k} for k in range(n)], "owner": list(range(n))})
    for got in (jaccard._inside(part), jaccard._opened(part, part.rename_columns(["own", "g", "owner"]))):
        assert got.num_rows == n - 1
        ends = [(q["rep"], x["rep"]) for q, x in zip(got["qg"].to_pylist(), got["xg"].to_pylist(), strict=True)]
        label = list(range(n))
        for a, b in ends:
            label = [label[a] if x == label[b] else x for x in label]
        assert len(set(label)) == 1


def test_jaccard_large_kin_is_asked_by_its_smaller_components(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 0)  # no groups before the exact step: it finds all links
    monkeypatch.setattr(jaccard, "OPENED", 12)
    found, asked, real = [], [], (jaccard._links, jaccard._asking)

    def links(*args):
        found.append(real[0](*args))
        return found[-1]

    def asking(*args):
        asked.append(real[1](*args))
        return asked[-1]

    monkeypatch.setattr(jaccard, "_links", links)
    monkeypatch.setattr(jaccard, "_asking", asking)
    rows = list(enumerate(near_copies(150, 130, 0.02, 1) + near_copies(60, 130, 0.028, 2)))
    rows = [(3 * k % 211, t.replace("t", "s") if k >= 180 else t) for k, t in rows]
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(rows)
    assert len(found) == 2  # scouts, then what is left
    assert sum(x.count() for x in found) < len(rows)
    assert asked[-1].count() < len(rows) * 210 // 12 // 2


def brute_substrings(rows):
    lists = [(d, words(t)) for d, t in rows]
    seen = {}
    for _, w in lists:
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    out = []
    for d, w in lists:
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone |= set(range(i, i + 35))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out)


def test_substrings(spark, docs, no_docs):
    assert sorted(map(tuple, substring.deduplicate(docs).collect())) == brute_substrings(TEXTS)
    assert substring.deduplicate(no_docs).count() == 0


def test_substrings_of_one_repeating_text(spark):
    rows = [(1, "a " * 34), (2, "b " * 36), (3, " ".join(f"c{i % 5}" for i in range(90))), (4, "x " + " ".join(f"d{i}" for i in range(35))), (5, " ".join(f"d{i}" for i in range(35)) + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring.deduplicate(df).collect())) == brute_substrings(rows)


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = queries.queries()[key](spark, SF), con.sql(queries.oracle_sql()[key])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(want.columns, want.fetchall())


def test_pipeline_stages(spark):
    docs = queries.table(spark, SF, "documents")
    labels = queries.table(spark, SF, "labels")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = corpus_pipeline.stage_table(stage(spark, docs, SF), f"test-{name}")
        if name != "token_ids":
            assert out.columns == docs.columns
            left = [r["doc_id"] for r in out.collect()]
        if name == "toxicity":
            clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()} & set(before)
            assert len(clean & set(left)) >= 0.97 * len(clean)
        elif name == "near_duplicates":
            want = [d for d, _, c in brute_components(sorted(before.items())) if c == d]
            assert sorted(left) == want
        elif name == "decontamination":
            items = [r["text"] for r in queries.table(spark, SF, "benchmark").collect()]
            assert sorted(left) == sorted(d for d, t in before.items() if not any(i in (t or "") for i in items))
        elif name == "mixing":
            assert set(left) <= set(before) and max(left.count(d) for d in set(left)) <= 2
        else:
            assert out.count() == len(left)
        docs = out


def test_stages_take_odd_rows(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
