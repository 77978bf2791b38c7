"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldflow.llm import ann, decontam, hard_negatives, huffman, jaccard, langid, line_dedup, mixing, resample, substring, token_counts, toxicity, warc
from coldflow.llm.workers import importable

WEIGHTS = (3, 1, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def id_bucket(n: int) -> Column:
    """crc32 of the document id as text, mod n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document (a token belongs to the line that holds its first byte)."""
    return token_counts.attribute(table(spark, sf_dir, "documents"), vocabulary())


def mixed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return mixing.mix(docs, mixing.word_count(F.col("text")), F.array("source"), WEIGHTS, carry=carry)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through the index."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("record_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("payload"))
    path = warc.new_archive(spark)
    back = warc.read(spark, path, warc.write(pages, path))
    return back.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified benchmark leaks: documents with the items they hold."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    samples = langid.sample(docs.where(id_bucket(4) != 2))
    scored = langid.predict(docs.select("doc_id", F.col("text").cast("string").alias("text")), samples)
    return scored.select("doc_id", (id_bucket(4) == 2).alias("held_out"), "lang_pred", "score")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(id_bucket(5) != 0))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", F.col("text").cast("string").alias("text")), toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (id_bucket(5) == 0).alias("held_out"), "score", "predicted")


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` as coded token ids and read the files back."""
    return huffman.read(spark, huffman.write_documents(docs, vocabulary())).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written, read back and summed up."""
    return token_files(spark, table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard.components(table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document loses to repeated 35-word windows."""
    return substring.deduplicate(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that five documents share."""
    kept = line_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn to resemble the benchmark texts."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector's positives; every 7th vector has the label after its own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0).drop("positive_rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_counts, op2_mixing, op3_ann, op4_warc, op5_decontamination, op6_language, op7_toxicity, op8_token_ids, op9_jaccard, op10_substrings, op11_line_dedup, op12_resample, op13_hard_negatives)
    return {f.__name__: f for f in own}


OP2_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('mix-1|' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
 s AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM d GROUP BY source),
 o AS (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS k, 2.0 * source_size / w AS cap_rate,
              1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
              sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM s),
 free AS (SELECT min(k) AS k FROM o WHERE room * w / share <= 2.0 * source_size),
 t AS (SELECT o.source, o.source_size, CASE WHEN o.k >= f.k THEN (SELECT room FROM o x WHERE x.k = f.k) * o.w / (SELECT share FROM o x WHERE x.k = f.k) ELSE 2.0 * o.source_size END::DOUBLE AS target FROM o, free f),
 q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS copies, CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest FROM t),
 o2 AS (SELECT d.*, q.source_size, q.target, q.copies, q.rest, row_number() OVER (PARTITION BY d.source ORDER BY d.size = 0, d.h, d.size, d.doc_id) AS r FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
 fit(source, r, gap, picked) AS (SELECT source, 0::BIGINT, rest, false FROM q UNION ALL
   SELECT o2.source, o2.r, CASE WHEN size <= gap THEN gap - size ELSE gap END, size <= gap FROM fit JOIN o2 ON o2.source IS NOT DISTINCT FROM fit.source AND o2.r = fit.r + 1)
SELECT doc_id, size, source_size, target, (size * (copies + CASE WHEN picked THEN 1 ELSE 0 END))::BIGINT AS taken FROM o2 JOIN fit ON o2.source IS NOT DISTINCT FROM fit.source AND o2.r = fit.r"""

OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
 d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
 k AS (SELECT digest, min(page_id) AS keeper FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, d.digest AS payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM d LEFT JOIN k ON d.digest = k.digest AND d.n >= 100"""

OP9_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 sets AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
 n AS (SELECT doc_id, len(s) AS n FROM sets),
 x AS (SELECT doc_id, unnest(s) AS t FROM sets),
 often AS (SELECT t FROM x GROUP BY t HAVING count(*) > 1),
 pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM (SELECT x.* FROM x JOIN often USING (t)) a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
 links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
 reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, least(n.doc_id, min(reach.b)) AS component_id FROM n LEFT JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n"""

OP10_SQL = """
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
 x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
 again AS (SELECT doc_id, i FROM x WHERE h IN (SELECT h FROM x GROUP BY h HAVING count(*) > 1)),
 gone AS (SELECT DISTINCT doc_id, i + k AS i FROM again, range(35) r(k)),
 words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
 kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.i) AS t FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11_SQL = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
 l AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS line FROM s),
 x AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS k FROM l),
 often AS (SELECT k, max(doc_id) AS keeper FROM x WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
 y AS (SELECT x.*, coalesce(doc_id <> keeper, false) AS gone FROM x LEFT JOIN often ON x.k = often.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM y GROUP BY doc_id"""

OP12_SQL = f"""
WITH RECURSIVE bits(i, c, k) AS (SELECT i, i, 0 FROM (SELECT unnest(range(256)) AS i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
 tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
 texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
 w AS (SELECT side, doc_id, coalesce(regexp_extract_all(translate(text, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM texts),
 f AS (SELECT side, doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM w),
 known AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
 crc AS (SELECT f, xor(list_reduce(list_prepend(4294967295, [('0x' || h[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, len(h) // 2 + 1)]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM known, tab),
 n AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN crc USING (f) GROUP BY b),
 whole AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
 gain AS (SELECT b, floor(1000 * ln((n.t + 1)::DOUBLE * (whole.s + 10000)::DOUBLE / ((n.s + 1)::DOUBLE * (whole.t + 10000)::DOUBLE)))::BIGINT AS g FROM n, whole),
 d AS (SELECT doc_id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN crc USING (f) JOIN gain USING (b) WHERE side = 0 GROUP BY doc_id),
 scored AS (SELECT w.doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('7:' || w.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w LEFT JOIN d ON w.doc_id = d.doc_id WHERE side = 0),
 r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN r ON scored.doc_id = r.doc_id"""

OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 3"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL; the other queries are tested against brute force, round trips or held-out accuracy (tests/llm)."""
    return {"op2_mixing": OP2_SQL, "op4_warc": OP4_SQL, "op9_jaccard": OP9_SQL, "op10_substrings": OP10_SQL, "op11_line_dedup": OP11_SQL, "op12_resample": OP12_SQL, "op13_hard_negatives": OP13_SQL}
