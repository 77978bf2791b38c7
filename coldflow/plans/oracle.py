"""Oracle SQL (DuckDB dialect) for every registered query.

Each query is written independently of the Spark code: the fixture recipes
over the driver's tables.  Every WITH list is a set of CTEs; DuckDB inlines
only the ones a query references.
"""

from __future__ import annotations

# Analyzer in SQL: lower-case, Han characters isolated, runs of letters/digits.
def _tokens(expr: str) -> str:
    return (
        "regexp_extract_all(regexp_replace(lower(" + expr + "), '(\\p{Han})', ' \\1 ', 'g'), "
        "'[\\p{L}\\p{N}]+')"
    )


def _index(prefix: str, source: str, id_col: str, text_col: str, payload: str = "") -> str:
    """CTEs ``{prefix}_post(term, id, payload, w)`` and ``{prefix}_df(term, df)`` (BM25 weights)."""
    pl = f", {payload}" if payload else ""
    return f"""
{prefix}_tok AS (SELECT {id_col}{pl}, {_tokens(text_col)} AS toks FROM {source}),
{prefix}_docs AS (SELECT *, len(toks) AS dl FROM {prefix}_tok WHERE len(toks) > 0),
{prefix}_stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {prefix}_docs),
{prefix}_tf AS (
  SELECT term, {id_col}{pl}, dl, count(*) AS tf
  FROM (SELECT {id_col}{pl}, dl, unnest(toks) AS term FROM {prefix}_docs)
  GROUP BY ALL),
{prefix}_df AS (SELECT term, count(*) AS df FROM {prefix}_tf GROUP BY term),
{prefix}_post AS (
  SELECT t.term, t.{id_col}{', ' + ', '.join('t.' + p.strip() for p in payload.split(',')) if payload else ''},
         ln(1.0::DOUBLE + (s.n::DOUBLE - d.df + 0.5::DOUBLE) / (d.df + 0.5::DOUBLE)) * t.tf * 2.2::DOUBLE
         / (t.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * t.dl / s.avgdl)) AS w
  FROM {prefix}_tf t JOIN {prefix}_df d USING (term) CROSS JOIN {prefix}_stats s)"""


def _scored(prefix: str, queries: str, qcol: str, index: str, id_col: str, payload: str = "") -> str:
    """CTE ``{prefix}_scored(q, id, payload, score)``: BM25 of each distinct query text."""
    pl = f", {payload}" if payload else ""
    return f"""
{prefix}_q AS (SELECT DISTINCT {qcol} AS q FROM {queries} WHERE {qcol} IS NOT NULL),
{prefix}_qt AS (
  SELECT q, term, count(*) AS qtf FROM (SELECT q, unnest({_tokens('q')}) AS term FROM {prefix}_q) GROUP BY ALL),
{prefix}_scored AS (
  SELECT q, {id_col}{pl}, round(sum(qtf * w), 6) AS score
  FROM {prefix}_qt JOIN {index}_post USING (term) GROUP BY ALL)"""


# ---------------------------------------------------------------------------
# Recall slice
# ---------------------------------------------------------------------------
RECALL_CTES = (
    """
ring AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS name, upper(p_brand) AS singer,
         CAST(floor(p_retailprice) AS INTEGER) AS fire
  FROM part),
song_pos AS (
  SELECT event_id, unnest(generate_series(0, event_id % 3)) AS pos
  FROM events WHERE event_id % 10 NOT IN (0, 1, 2, 5)),
song AS (
  SELECT s.event_id, s.pos,
    CASE WHEN (s.event_id + s.pos) % 4 = 0 THEN 'qqq zzz'
         WHEN (s.event_id + s.pos) % 4 = 1 THEN ''
         ELSE p.p_name END AS song,
    CASE WHEN (s.event_id + s.pos) % 16 = 9 THEN ''
         WHEN (s.event_id + s.pos) % 8 IN (0, 1) THEN upper(p.p_brand)
         WHEN (s.event_id + s.pos) % 8 IN (4, 5) THEN 'NOBODY XYZ'
         ELSE upper(p.p_brand) || ',OTHER' END AS singer
  FROM song_pos s JOIN part p ON p.p_partkey = (s.event_id * 7 + s.pos * 13) % (SELECT count(*) FROM part)),
song_json AS (
  SELECT event_id,
         string_agg('{"d_songname":"' || song || '","d_singername":"' || singer || '"}', ',' ORDER BY pos) AS j
  FROM song GROUP BY event_id),
log AS (
  SELECT e.event_id, e.ts,
    CASE e.event_id % 10
      WHEN 0 THEN 'uid~' || e.user_id || chr(31) || 'audios~' || chr(31) || 'trace~x'
      WHEN 1 THEN 'audios~[' || coalesce(j, '') || ']' || chr(31) || 'trace~x'
      WHEN 2 THEN 'uid~' || e.user_id || chr(31) || 'audios~oops' || chr(31) || 'trace~x'
      WHEN 3 THEN 'uid~' || e.user_id || '~junk' || chr(31) || 'audios~[' || coalesce(j, '') || ']' || chr(31) || 'trace~x'
      WHEN 4 THEN 'uid~old' || chr(31) || 'uid~' || e.user_id || chr(31) || 'audios~[' || coalesce(j, '') || ']' || chr(31) || 'trace~x'
      ELSE 'uid~' || e.user_id || chr(31) || 'audios~[' || coalesce(j, '') || ']' || chr(31) || 'trace~x'
    END AS value
  FROM events e LEFT JOIN song_json s USING (event_id)),
log_terms AS (
  SELECT event_id, list_transform(string_split(value, chr(31)), lambda t: string_split(t, '~')) AS tp FROM log),
rec_all AS (
  SELECT event_id,
    list_filter(tp, lambda p: len(p) >= 2 AND p[1] = 'uid' AND p[2] <> '')[-1][2] AS uid,
    list_filter(tp, lambda p: len(p) >= 2 AND p[1] = 'audios' AND p[2] <> '')[-1][2] AS audios
  FROM log_terms),
rec AS (SELECT * FROM rec_all WHERE uid IS NOT NULL AND audios IS NOT NULL),
rec_json AS (
  SELECT event_id, uid, audios,
    CASE WHEN json_valid(audios) AND json_type(audios) = 'ARRAY' THEN json_extract(audios, '$[*]') END AS els
  FROM rec),
rec_checked AS (
  SELECT *,
    CASE WHEN els IS NULL OR list_bool_or(list_transform(els, lambda x: json_type(x) <> 'OBJECT')) THEN 'bad_json'
         WHEN list_bool_or(list_transform(els, lambda x: coalesce(json_type(x, '$.d_songname') = 'NULL', false)
                                               OR coalesce(json_type(x, '$.d_singername') = 'NULL', false)))
           THEN 'null_field'
    END AS reason
  FROM rec_json),
rejects AS (
  SELECT event_id, 'incomplete' AS reason FROM rec_all WHERE uid IS NULL OR audios IS NULL
  UNION ALL SELECT event_id, reason FROM rec_checked WHERE reason IS NOT NULL),
song_el AS (
  SELECT event_id, uid, unnest(range(len(els))) AS pos, els
  FROM rec_checked WHERE reason IS NULL),
songs_raw AS (
  SELECT event_id, uid, pos,
    coalesce(json_extract_string(els[pos + 1], '$.d_songname'), '') AS song_name,
    coalesce(json_extract_string(els[pos + 1], '$.d_singername'), '') AS singer_text
  FROM song_el),
songs AS (
  SELECT *,
    regexp_split_to_array(regexp_replace(singer_text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '[,_-、、]') AS singers
  FROM songs_raw WHERE song_name <> '' OR singer_text <> ''),
songs1 AS (SELECT *, singers[1] AS first_singer FROM songs),"""
    + _index("nidx", "ring", "item_id", "name", "fire")
    + ","
    + _index("sidx", "ring", "item_id", "singer", "fire")
    + ","
    + _scored("nm", "(SELECT * FROM songs1 WHERE song_name <> '')", "song_name", "nidx", "item_id", "fire")
    + """,
nm_top AS (
  SELECT q, item_id, fire, score FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item_id) AS rk FROM nm_scored) WHERE rk = 1),
name_hits AS (
  SELECT s.event_id, s.uid, s.pos, t.item_id, t.fire, t.score
  FROM songs1 s JOIN nm_top t ON s.song_name = t.q),
no_name AS (SELECT s.* FROM songs1 s ANTI JOIN name_hits h USING (event_id, pos)),"""
    + _scored("sg", "no_name", "first_singer", "sidx", "item_id", "fire")
    + """,
sg_top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item_id) AS rank FROM sg_scored) WHERE rank <= 5),
singer_hits AS (
  SELECT s.event_id, s.uid, s.pos, t.item_id, t.fire, t.score, t.rank
  FROM no_name s JOIN sg_top t ON s.first_singer = t.q),
misses AS (
  SELECT event_id, pos, 'name' AS kind, song_name AS text FROM no_name
  UNION ALL
  SELECT event_id, pos, 'singer' AS kind, first_singer AS text
  FROM no_name n WHERE NOT EXISTS (SELECT 1 FROM singer_hits h WHERE h.event_id = n.event_id AND h.pos = n.pos)),
hits AS (
  SELECT event_id, uid, item_id, fire, 0 AS prio FROM name_hits
  UNION ALL SELECT event_id, uid, item_id, fire, 1 AS prio FROM singer_hits),
per_item AS (SELECT event_id, uid, item_id, min(prio) AS prio, max(fire) AS fire FROM hits GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY prio, fire DESC, item_id) AS rank FROM per_item)"""
)


def _hits_ctes(prefix: str, songs: str, ring: str) -> str:
    """CTEs up to ``{prefix}_ranked``: the recall lists of a song set against a catalogue."""
    p = prefix
    return (
        _index(f"{p}n", ring, "item_id", "name", "fire")
        + ","
        + _index(f"{p}s", ring, "item_id", "singer", "fire")
        + ","
        + _scored(f"{p}nm", f"(SELECT * FROM {songs} WHERE song_name <> '')", "song_name", f"{p}n", "item_id", "fire")
        + f""",
{p}nh AS (
  SELECT s.event_id, s.uid, s.pos, t.item_id, t.fire FROM {songs} s JOIN (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item_id) AS rk FROM {p}nm_scored) t
  ON s.song_name = t.q AND t.rk = 1),
{p}rest AS (SELECT s.* FROM {songs} s ANTI JOIN {p}nh USING (event_id, pos)),"""
        + _scored(f"{p}sg", f"{p}rest", "first_singer", f"{p}s", "item_id", "fire")
        + f""",
{p}sh AS (
  SELECT s.event_id, s.uid, s.pos, t.item_id, t.fire FROM {p}rest s JOIN (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item_id) AS rk FROM {p}sg_scored) t
  ON s.first_singer = t.q AND t.rk <= 5),
{p}item AS (
  SELECT event_id, uid, item_id, min(prio) AS prio, max(fire) AS fire
  FROM (SELECT *, 0 AS prio FROM {p}nh UNION ALL SELECT *, 1 AS prio FROM {p}sh) GROUP BY event_id, uid, item_id),
{p}ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY prio, fire DESC, item_id) AS rank FROM {p}item)"""
    )


def refreshed_zset() -> str:
    """Recall lists where events of the first half see the base catalogue, later ones the changed one."""
    return _with(
        RECALL_CTES
        + """,
half AS (SELECT max(event_id) // 2 AS h FROM events),
early AS (SELECT * FROM songs1 WHERE event_id < (SELECT h FROM half)),
late AS (SELECT * FROM songs1 WHERE event_id >= (SELECT h FROM half)),
ring_old AS (SELECT * FROM ring WHERE CAST(item_id AS BIGINT) % 5 <> 0),
ring_new AS (
  SELECT item_id, name || CASE WHEN CAST(item_id AS BIGINT) % 11 = 0 THEN ' special edition' ELSE '' END AS name, singer, fire
  FROM ring WHERE CAST(item_id AS BIGINT) % 7 <> 0),"""
        + _hits_ctes("ea", "early", "ring_old")
        + ","
        + _hits_ctes("la", "late", "ring_new")
        + """,
both_ranked AS (SELECT * FROM earanked UNION ALL SELECT * FROM laranked)""",
        """
SELECT 'res:recom:fancy:' || r.uid AS key, r.item_id AS member, CAST(r.fire AS DOUBLE) AS score
FROM both_ranked r JOIN (SELECT uid, max(event_id) AS event_id FROM both_ranked GROUP BY uid) m USING (uid, event_id)
WHERE r.rank <= 200""",
    )


def _with(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip().rstrip(",") + "\n" + select.strip()


def recall_queries() -> dict[str, str]:
    w = lambda s: _with(RECALL_CTES, s)
    return {
        "parse_log_kv": w("SELECT event_id, uid, audios FROM rec"),
        "parse_rejects": w("SELECT event_id, reason FROM rejects"),
        "songs_rows": w("SELECT event_id, pos, song_name, singer_text FROM songs"),
        "singer_split": w(
            """
SELECT event_id, pos, 'faithful' AS mode, i - 1 AS idx, singers[i] AS singer
FROM (SELECT event_id, pos, singers, unnest(generate_series(1, len(singers))) AS i FROM songs)
UNION ALL
SELECT event_id, pos, 'literal' AS mode, i - 1 AS idx, parts[i] AS singer
FROM (SELECT event_id, pos, parts, unnest(generate_series(1, len(parts))) AS i FROM (
  SELECT event_id, pos,
    regexp_split_to_array(regexp_replace(singer_text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '[,_\\-、]') AS parts
  FROM songs))"""
        ),
        "catalogue_refresh": _with(
            RECALL_CTES
            + """,
ring2 AS (
  SELECT item_id, name || CASE WHEN CAST(item_id AS BIGINT) % 11 = 0 THEN ' special edition' ELSE '' END AS name, fire
  FROM ring WHERE CAST(item_id AS BIGINT) % 7 <> 0),"""
            + _index("cidx", "ring2", "item_id", "name", "fire")
            + ","
            + _scored("cm", "(SELECT * FROM songs1 WHERE song_name <> '')", "song_name", "cidx", "item_id", "fire"),
            """
SELECT s.event_id, s.pos, t.item_id, t.fire, t.score
FROM songs1 s JOIN (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item_id) AS rk FROM cm_scored) t
ON s.song_name = t.q AND t.rk = 1""",
        ),
        "match_name_top1": w("SELECT event_id, pos, item_id, fire, score FROM name_hits"),
        "match_singer_top5": w("SELECT event_id, pos, item_id, fire, score, rank FROM singer_hits"),
        "recall_waterfall": w(
            """
SELECT event_id, pos, 'name' AS match_kind, item_id, fire, 1 AS rank FROM name_hits
UNION ALL SELECT event_id, pos, 'singer', item_id, fire, rank FROM singer_hits
UNION ALL SELECT event_id, pos, 'miss', NULL, NULL, NULL FROM misses WHERE kind = 'singer'"""
        ),
        "recall_capped": w(
            """
SELECT event_id, uid, item_id, fire, CASE WHEN prio = 0 THEN 'name' ELSE 'singer' END AS match_kind, rank
FROM ranked WHERE rank <= 3"""
        ),
        "recall_zset": w(
            """
SELECT 'res:recom:fancy:' || r.uid AS key, r.item_id AS member, CAST(r.fire AS DOUBLE) AS score
FROM ranked r JOIN (SELECT uid, max(event_id) AS event_id FROM ranked GROUP BY uid) m USING (uid, event_id)
WHERE r.rank <= 200"""
        ),
        "miss_report": w("SELECT event_id, pos, kind, text FROM misses"),
        "miss_counts": w("SELECT kind, text, count(*) AS n FROM misses GROUP BY ALL"),
        "write_metrics": w(
            """
SELECT r.event_id, r.uid, r.n_items, CAST(epoch_us(l.ts) // 1000 AS VARCHAR) AS request_id,
       epoch_ms(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(l.ts) // 1000 AS latency_ms
FROM (SELECT event_id, uid, count(*) AS n_items FROM ranked WHERE rank <= 200 GROUP BY ALL) r JOIN log l USING (event_id)"""
        ),
    }


# ---------------------------------------------------------------------------
# Keyed tables
# ---------------------------------------------------------------------------
TEMPLATE_SQL = (
    '{"individual":"1","configName":"n","algorithmConfig":{"a":1},"historyConfig":{},'
    '"ctrConfig":{"c":[1]},"diversityConfig":{},"selectorConfig":{"s":"x"}}'
)

KEYED_CTES = """
zops AS (
  SELECT 'z:' || (user_id % 50) AS key, event_type AS member, value AS score,
         CASE WHEN event_id % 7 = 0 THEN 'replace' ELSE 'put' END AS op, event_id AS version
  FROM events),
zbar AS (SELECT key, max(version) AS b FROM zops WHERE op IN ('replace', 'delete') GROUP BY key),
zlast AS (SELECT key, member, arg_max(score, version) AS score, max(version) AS version FROM zops GROUP BY ALL),
hw AS (
  SELECT 'cfg:' || user_id AS key,
         replace('""" + TEMPLATE_SQL + """', '"configName":"n"', '"configName":"' || event_type || '"') AS template,
         event_id AS version
  FROM events),
hv AS (SELECT hw.key, hw.template FROM hw JOIN (SELECT key, max(version) AS version FROM hw GROUP BY key) USING (key, version)),
hfields AS (
  SELECT * FROM (VALUES ('individual'), ('configName'), ('algorithmConfig'), ('historyConfig'), ('ctrConfig'),
                        ('diversityConfig'), ('selectorConfig')) f(field)),
kvl AS (
  SELECT CAST(user_id AS VARCHAR) AS key, arg_max(event_type, event_id) AS value,
         arg_max((event_id % 3) * 86400, event_id) AS ttl, arg_max(ts, event_id) AS write_ts
  FROM events GROUP BY 1),
kvv AS (SELECT key, value, CASE WHEN ttl > 0 THEN write_ts + to_seconds(ttl) END AS expires_at FROM kvl),
cells AS (
  SELECT user_id || '~' || CASE WHEN event_id % 11 = 0 THEN '娱乐' ELSE event_type END || '~' || event_id AS row_key,
         CASE WHEN event_id % 13 = 0 THEN 'cf:x' ELSE 'cf:s' END AS col,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS value, event_id AS version
  FROM events
  UNION ALL
  SELECT user_id || '~' || CASE WHEN event_id % 11 = 0 THEN '娱乐' ELSE event_type END || '~' || event_id,
         CASE WHEN event_id % 13 = 0 THEN 'cf:x' ELSE 'cf:s' END,
         CAST(CAST(round(value * 100) AS BIGINT) + 100 AS VARCHAR), event_id + 1000000
  FROM events WHERE event_id % 5 = 0),
cells_split AS (
  SELECT row_key, string_split(col, ':') AS parts, value, version FROM cells),
cells_latest AS (
  SELECT row_key, parts[1] AS family, parts[2] AS qualifier, arg_max(value, version) AS value, max(version) AS version
  FROM cells_split WHERE len(parts) >= 2 GROUP BY ALL),
creq AS (
  SELECT event_id AS request_id, user_id || '~' || event_type || '~' || event_id AS row_key,
         'cf' AS family, 's' AS qualifier
  FROM events),
preq AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid, 'cf' AS family, 's' AS qualifier,
         CAST(user_id % 7 - 1 AS INTEGER) AS lim
  FROM events),
pcand AS (
  SELECT r.uid, c.row_key, TRY_CAST(c.value AS DOUBLE) AS score, r.lim
  FROM preq r JOIN cells_latest c
    ON c.family = r.family AND c.qualifier = r.qualifier
   AND c.row_key >= r.uid || '~' AND c.row_key < r.uid || '~~'),
pranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, row_key) AS rk
  FROM pcand WHERE score IS NOT NULL)"""


def keyed_queries() -> dict[str, str]:
    w = lambda s: _with(KEYED_CTES, s)
    return {
        "zset_append": w("SELECT key, member, score FROM zlast LEFT JOIN zbar USING (key) WHERE b IS NULL OR version >= b"),
        "zset_ttl": _with(
            """RECURSIVE zt AS (
  SELECT 'z:' || (user_id % 50) AS key, event_type AS member, value AS score, event_id % 29 = 0 AS fresh,
         CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id % 5 * 43200 END AS ttl, ts,
         row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts, event_id) AS r
  FROM events),
fold(key, r, life, expires) AS (
  SELECT key, r, r, CASE WHEN ttl > 0 THEN ts + to_seconds(ttl) END FROM zt WHERE r = 1
  UNION ALL
  SELECT o.key, o.r, CASE WHEN o.fresh OR coalesce(f.expires <= o.ts, false) THEN o.r ELSE f.life END,
         CASE WHEN o.ttl > 0 THEN o.ts + to_seconds(o.ttl)
              WHEN o.fresh OR coalesce(f.expires <= o.ts, false) THEN NULL ELSE f.expires END
  FROM fold f JOIN zt o ON o.key = f.key AND o.r = f.r + 1),
ended AS (SELECT key, arg_max(life, r) AS life, max(r) AS r FROM fold GROUP BY key)""",
            """
SELECT m.key, m.member, m.score, f.expires AS expires_at
FROM (SELECT key, member, arg_max(score, r) AS score, max(r) AS r FROM zt GROUP BY ALL) m
JOIN ended e USING (key) JOIN fold f ON f.key = e.key AND f.r = e.r
WHERE m.r >= e.life AND (f.expires IS NULL OR f.expires > TIMESTAMP '2024-01-31 00:00:00')""",
        ),
        "hash_log": w("SELECT key, field, json_extract_string(template, '$.' || field) AS value FROM hv CROSS JOIN hfields"),
        "kv_log": w("SELECT * FROM kvv WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-31 00:00:00'"),
        "hash_replace": w("SELECT key, field, json_extract_string(template, '$.' || field) AS value FROM hv CROSS JOIN hfields"),
        "kv_ttl": w("SELECT * FROM kvv WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-31 00:00:00'"),
        "cells_latest": w("SELECT * FROM cells_latest"),
        "row_lookup": w(
            "SELECT r.request_id, r.row_key, c.family, c.qualifier, c.value, c.version "
            "FROM creq r LEFT JOIN cells_latest c USING (row_key)"
        ),
        "cell_lookup": w(
            "SELECT r.request_id, r.row_key, r.family, r.qualifier, c.value "
            "FROM creq r LEFT JOIN cells_latest c USING (row_key, family, qualifier)"
        ),
        "prefix_newest": w('SELECT uid, row_key, score, lim AS "limit" FROM pranked WHERE lim < 0 OR rk <= lim'),
    }


# ---------------------------------------------------------------------------
# Graph
# ---------------------------------------------------------------------------
GRAPH_CTES = """
nodes AS (
  SELECT 'u:' || c_custkey AS id, 'USER' AS label, CAST(c_custkey AS VARCHAR) AS uid, c_name AS name FROM customer
  UNION ALL SELECT 'm:' || p_partkey, 'MOVIE', NULL, p_name FROM part
  UNION ALL SELECT 'c:' || s_suppkey, 'CELEBRITY', NULL, s_name FROM supplier),
likes AS (
  SELECT 'u:' || o.o_custkey AS src, 'm:' || l.l_partkey AS dst, 'LIKE' AS type, CAST(count(*) AS INTEGER) AS frequency,
         max(CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
                  ELSE CAST(strftime(o.o_orderdate, '%Y%m%d%H%M%S') AS BIGINT) END) AS last_time
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey, l.l_partkey),
acts AS (
  SELECT DISTINCT 'c:' || l_suppkey AS src, 'm:' || l_partkey AS dst, 'ACT' AS type,
         CAST(NULL AS INTEGER) AS frequency, CAST(NULL AS BIGINT) AS last_time
  FROM lineitem),
edges AS (SELECT * FROM likes UNION ALL SELECT * FROM acts),
gusers AS (SELECT id, uid FROM nodes WHERE label = 'USER' AND uid IS NOT NULL),
ulike AS (SELECT src AS a, dst AS b FROM edges WHERE type = 'LIKE' UNION ALL SELECT dst, src FROM edges WHERE type = 'LIKE'),
uact AS (SELECT src AS a, dst AS b FROM edges WHERE type = 'ACT' UNION ALL SELECT dst, src FROM edges WHERE type = 'ACT'),
work_names AS (
  SELECT DISTINCT work, name FROM (
    SELECT id AS work, name FROM nodes
    UNION ALL SELECT x.a AS work, n.name FROM uact x JOIN nodes n ON n.id = x.b)
  WHERE name IS NOT NULL),
liked_all AS (
  SELECT DISTINCT u.uid, w.name FROM gusers u JOIN ulike l ON l.a = u.id JOIN work_names w ON w.work = l.b),
liked AS (
  SELECT uid, name FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY name) AS r FROM liked_all) WHERE r <= 50),
greq AS (SELECT DISTINCT CAST((s_suppkey // 2 + 1) * 37 AS VARCHAR) AS uid FROM supplier),
goc AS (
  SELECT r.uid, coalesce(n.id, 'u:' || r.uid) AS id, n.id IS NULL AS created
  FROM greq r LEFT JOIN (SELECT uid, min(id) AS id FROM nodes WHERE label = 'USER' GROUP BY uid) n USING (uid)),
gnew AS (SELECT uid, id, row_number() OVER (ORDER BY uid) - 1 AS i FROM goc WHERE created),
gcel AS (SELECT id AS cid, row_number() OVER (ORDER BY id) - 1 AS ci FROM nodes WHERE label = 'CELEBRITY'),
gcpu AS (SELECT (SELECT count(*) FROM gcel) // (SELECT count(*) FROM goc) AS c),
ulikes AS (SELECT e.* FROM edges e JOIN gusers u ON u.id = e.src WHERE e.type = 'LIKE'),
kept AS (SELECT DISTINCT src AS id FROM ulikes WHERE NOT coalesce(last_time < 20010625000000, false)),
xcand AS (SELECT u.* FROM gusers u ANTI JOIN kept USING (id)),
touch AS (
  SELECT src AS id FROM edges WHERE type <> 'LIKE'
  UNION SELECT dst FROM edges WHERE type <> 'LIKE'
  UNION SELECT dst FROM edges WHERE type = 'LIKE'),
interest AS (
  SELECT o.o_orderkey % 2 AS parity, CAST(o.o_custkey AS VARCHAR) AS uid, s.s_name AS word,
         CAST(strftime(o.o_orderdate, '%Y%m%d%H%M%S') AS BIGINT) AS t
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey),
istored AS (SELECT uid, word, CAST(count(*) AS INTEGER) AS frequency, max(t) AS last_time FROM interest WHERE parity = 1 GROUP BY ALL),
ibatch AS (SELECT uid, word, CAST(count(*) AS INTEGER) AS frequency, max(t) AS last_time FROM interest WHERE parity = 0 GROUP BY ALL),
imerge AS (
  SELECT coalesce(s.uid, b.uid) AS uid, coalesce(s.word, b.word) AS word,
         s.frequency AS sf, s.last_time AS st, b.frequency AS bf, b.last_time AS bt
  FROM istored s FULL OUTER JOIN ibatch b ON s.uid = b.uid AND s.word = b.word)"""


def graph_queries() -> dict[str, str]:
    w = lambda s: _with(GRAPH_CTES, s)
    return {
        "liked_items": w("SELECT uid, name FROM liked"),
        "liked_export": w(
            """
SELECT u.uid, u.uid || ': ' || coalesce(string_agg(l.name || ' ', '' ORDER BY l.name), '') AS line
FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS uid FROM customer) u LEFT JOIN liked l USING (uid)
GROUP BY u.uid"""
        ),
        "graph_get_or_create": w("SELECT uid, id, created FROM goc"),
        "graph_assign": w(
            """
SELECT n.id AS src, c.cid AS dst, 'LIKE' AS type, 1 AS frequency, CAST(20010725000000 AS BIGINT) AS last_time
FROM gnew n JOIN gcel c ON (SELECT c FROM gcpu) > 0
  AND c.ci // CASE WHEN (SELECT c FROM gcpu) > 0 THEN (SELECT c FROM gcpu) ELSE 1 END = n.i"""
        ),
        "graph_expire_edges": w(
            "SELECT src, dst, frequency, last_time, coalesce(last_time < 20010625000000, false) AS expired FROM ulikes"
        ),
        "graph_expire_users": w("SELECT id, uid FROM xcand ANTI JOIN touch USING (id)"),
        "all_uids": w("SELECT DISTINCT uid FROM gusers"),
        "interest_merge": w(
            """
SELECT uid, word,
  CAST(CASE WHEN sf IS NOT NULL AND bf IS NOT NULL AND st > bt THEN sf + bf
            WHEN sf IS NOT NULL THEN sf ELSE bf END AS INTEGER) AS frequency,
  coalesce(st, bt) AS last_time,
  CASE WHEN sf IS NULL THEN 'created' WHEN bf IS NOT NULL AND st > bt THEN 'updated'
       WHEN bf IS NULL THEN 'untouched' ELSE 'unchanged' END AS action
FROM imerge"""
        ),
        "interest_merge_newer": w(
            """
SELECT uid, word, CAST(coalesce(sf, 0) + coalesce(bf, 0) AS INTEGER) AS frequency,
  greatest(st, bt) AS last_time,
  CASE WHEN sf IS NULL THEN 'created' WHEN bf IS NOT NULL THEN 'updated' ELSE 'untouched' END AS action
FROM imerge"""
        ),
    }


# ---------------------------------------------------------------------------
# News, channels, messages, times
# ---------------------------------------------------------------------------
MISC_CTES = (
    """
news AS (
  SELECT doc_id AS row_id, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS doc_id,
    text AS title,
    CASE WHEN doc_id % 19 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) END AS created_time,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((doc_id // 20) % 10 AS INTEGER)) + to_hours(doc_id % 24) AS publish_time,
    [source, lang] AS channels
  FROM documents),
nf AS (
  SELECT * FROM news
  WHERE coalesce(list_bool_or(list_transform(channels, lambda c: contains(c, 'src1') OR contains(c, 'src2') OR contains(c, 'fr'))), false)
    AND publish_time BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'),
kw AS (SELECT * FROM (VALUES ('of the'), ('de la'), ('the'), ('les'), ('que'), ('zzzz')) k(keyword)),
kwn AS (SELECT keyword, array_to_string("""
    + _tokens("keyword")
    + """, ' ') AS kn FROM kw),
ntok AS (SELECT row_id, array_to_string("""
    + _tokens("title")
    + """, ' ') AS norm FROM news),
pm AS (
  SELECT k.keyword, n.row_id FROM kwn k JOIN ntok n
    ON k.kn <> '' AND contains(' ' || n.norm || ' ', ' ' || k.kn || ' ')),
pmf AS (SELECT pm.keyword, nf.* FROM pm JOIN nf USING (row_id)),"""
    + _index("tidx", "news", "row_id", "title")
    + ","
    + _scored("tq", "kw", "keyword", "tidx", "row_id")
    + """,
prel AS (
  SELECT p.*, coalesce(s.score, 0.0) AS score
  FROM pmf p LEFT JOIN tq_scored s ON s.q = p.keyword AND s.row_id = p.row_id),
clist AS (
  SELECT event_id,
    '[' || CASE WHEN event_id % 6 = 0 THEN '{"y":0}' ELSE '{"channelId":' || (user_id % 5) || '}' END || ',{"x":1}]' AS json
  FROM events),
cids AS (
  SELECT event_id,
    list_transform(list_filter(json_extract(json, '$[*]'), lambda x: json_exists(x, '$.channelId')),
                   lambda x: json_extract_string(x, '$.channelId')) AS ids
  FROM clist),
ctext AS (
  SELECT event_id,
    CASE WHEN event_id % 31 = 0 THEN 'c1'
         ELSE 'c' || (user_id % 5) || ':' || event_id || '~c' || (event_id % 5) || ':9' END AS value
  FROM events),
citems AS (
  SELECT event_id,
    list_transform(string_split(regexp_replace(value, '~+$', ''), '~'),
                   lambda it: string_split(regexp_replace(it, ':+$', ''), ':')) AS items
  FROM ctext),
cbad AS (SELECT event_id, items, list_bool_or(list_transform(items, lambda p: len(p) < 2)) AS bad FROM citems),
crows AS (
  SELECT event_id, i AS pos, items[i][1] AS channel, items[i][2] AS value
  FROM (SELECT event_id, items, unnest(generate_series(1, len(items))) AS i FROM cbad WHERE NOT bad)),
msgs AS (
  SELECT event_id // 2 AS msg_id, 't' AS topic, event_type AS tag, props AS body, ts AS store_ts,
         CAST(user_id % 4 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset"
  FROM events),
mlatest AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY store_ts DESC, partition DESC, "offset" DESC) AS r FROM msgs)
  WHERE r = 1),
merr AS (SELECT DISTINCT msg_id FROM msgs WHERE tag = 'error'),
mfail AS (SELECT msg_id, max(attempt) AS attempt FROM (
  SELECT msg_id, 1 AS attempt FROM merr UNION ALL SELECT msg_id, 2 FROM merr WHERE msg_id % 2 = 0) GROUP BY msg_id),
mj AS (SELECT l.*, f.attempt FROM mlatest l JOIN mfail f USING (msg_id)),
times AS (
  SELECT event_id, CASE WHEN event_id % 37 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS t FROM events),
tparsed AS (SELECT event_id, t, try_strptime(t, '%Y-%m-%d %H:%M:%S') AS ts FROM times)"""
)


def misc_queries() -> dict[str, str]:
    w = lambda s: _with(MISC_CTES, s)
    return {
        "title_newest": w(
            """
SELECT keyword, doc_id, coalesce(CAST(strftime(created_time, '%Y%m%d%H%M%S') AS DOUBLE), 1.0) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY created_time DESC NULLS LAST, row_id) AS r FROM pmf)
WHERE r <= 3 AND doc_id IS NOT NULL"""
        ),
        "title_relevance": w(
            """
SELECT DISTINCT keyword, doc_id, 1.0::DOUBLE AS score
FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY score DESC, row_id) AS r FROM prel)
WHERE r <= 30 AND doc_id IS NOT NULL"""
        ),
        "title_num_found": w(
            """
SELECT k.keyword, count(p.row_id) AS num_found, least(count(p.row_id), 10) AS page_size
FROM kw k LEFT JOIN pmf p USING (keyword) GROUP BY k.keyword"""
        ),
        "channel_ids": w(
            "SELECT event_id, i - 1 AS idx, ids[i] AS channel_id "
            "FROM (SELECT event_id, ids, unnest(generate_series(1, len(ids))) AS i FROM cids)"
        ),
        "channel_decode": w("SELECT event_id, channel, arg_max(value, pos) AS value FROM crows GROUP BY ALL"),
        "channel_decode_rejects": w("SELECT event_id, 'missing_value' AS reason FROM cbad WHERE bad"),
        "channel_topk": w(
            """
SELECT channel, item_id, max(score) AS score FROM (
  SELECT event_type AS channel, CAST(user_id AS VARCHAR) AS item_id, value AS score,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, CAST(user_id AS VARCHAR)) AS r
  FROM events) WHERE r <= 5 GROUP BY ALL"""
        ),
        "offset_range": w(
            'SELECT msg_id, tag, partition, "offset" FROM msgs WHERE "offset" >= 100 AND "offset" < 500 AND body IS NOT NULL'
        ),
        "offset_for_time": w(
            """
SELECT p.partition, coalesce(b.o, -1) AS "offset"
FROM (SELECT DISTINCT partition FROM msgs) p
LEFT JOIN (SELECT partition, max("offset") AS o FROM msgs WHERE store_ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY partition) b
USING (partition)"""
        ),
        "tag_subscribe": w(
            """SELECT msg_id, tag, partition, "offset" FROM msgs WHERE topic = 't' AND tag IN ('click', 'view')"""
        ),
        "msg_dedup": w("SELECT * FROM mlatest"),
        "msg_redeliver": w('SELECT msg_id, partition, "offset", attempt + 1 AS attempt FROM mj WHERE attempt <= 1'),
        "msg_dead_letter": w('SELECT msg_id, partition, "offset", attempt FROM mj WHERE attempt > 1'),
        "time_normalize": w(
            "SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM tparsed WHERE ts IS NOT NULL"
        ),
        "time_lenient": """
WITH x AS (
  SELECT event_id, date_trunc('second', ts) AS ts, event_id % 6 AS k, date_trunc('month', ts) AS m,
         date_trunc('second', ts) - date_trunc('month', ts) AS rest
  FROM events),
y AS (
  SELECT event_id, CASE WHEN event_id % 37 = 0 THEN NULL
    WHEN k = 1 THEN m + INTERVAL 12 MONTH + rest WHEN k = 5 THEN date_trunc('year', m) - INTERVAL 1 MONTH + rest
    WHEN k = 2 THEN ts + INTERVAL 31 DAY WHEN k = 3 THEN ts + INTERVAL 25 HOUR WHEN k = 4 THEN ts + INTERVAL 75 SECOND
    ELSE ts END AS ts
  FROM x)
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, strftime(ts, '%d.%m.%Y %H:%M') AS text FROM y""",
        "time_rejects": w("SELECT event_id, t FROM tparsed WHERE ts IS NULL"),
    }


def all_queries() -> dict[str, str]:
    out = {}
    out.update(recall_queries())
    out.update(keyed_queries())
    out.update(graph_queries())
    out.update(misc_queries())
    out["raw_records"] = _with(
        RECALL_CTES,
        'SELECT hex(encode(value)) AS bytes_hex, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS request_id, 0 AS partition, event_id AS "offset" FROM log',
    )
    out["label_scan"] = _with(GRAPH_CTES, "SELECT * FROM nodes WHERE label = 'CELEBRITY'")
    out["collection_scan"] = "SELECT doc_id, quality, toxic FROM labels"
    out["record_rejects"] = _with(
        RECALL_CTES,
        """SELECT event_id, 'bad_bytes' AS reason FROM rec WHERE event_id % 41 = 0
UNION ALL SELECT event_id, reason FROM rejects WHERE event_id % 41 <> 0 OR reason = 'incomplete'""",
    )
    # The stream's view must equal the batch sorted-set view, its misses and rejects the batch ones.
    out["stream_recall_zset"] = out["recall_zset"]
    out["stream_misses"] = out["miss_report"]
    out["stream_rejects"] = out["parse_rejects"]
    out["stream_catalogue_refresh"] = refreshed_zset()
    return out
