"""Parse jobs P1-P5: raw log lines -> records -> one row per song.

Every job returns one frame with a nullable ``reason`` column; ``split`` turns
it into the accepted table and the reject table.  All work is column
expressions (split / filter / from_json / posexplode), so it stays inside
whole-stage codegen and runs the same on a batch or a streaming frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldflow.functions.text import (
    LOG_FIELD_SEP,
    LOG_KV_SEP,
    SINGER_NAME_KEY,
    SONG_NAME_KEY,
    kv_last_value,
    singer_list,
)

WANTED_KEYS = ("uid", "audios")
SONGS_SCHEMA = "array<map<string,string>>"

REASON_INCOMPLETE = "incomplete"
REASON_BAD_BYTES = "bad_bytes"
REASON_BAD_JSON = "bad_json"
REASON_NULL_FIELD = "null_field"


def split(df: DataFrame, reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(accepted without the reason column, rejected with it)."""
    ok = df.where(F.col(reason_col).isNull()).drop(reason_col)
    bad = df.where(F.col(reason_col).isNotNull())
    return ok, bad


def log_terms(value: Column) -> Column:
    """ARRAY<ARRAY<STRING>>: the line split on U+001F, every term split on '~' (empties kept)."""
    return F.transform(F.split(value, LOG_FIELD_SEP, -1), lambda t: F.split(t, LOG_KV_SEP, -1))


def parse_log(
    raw: DataFrame,
    wanted: Sequence[str] = WANTED_KEYS,
    value_col: str = "value",
    carry: Sequence[str] = ("event_id",),
) -> DataFrame:
    """P1 + P2: key/value log line -> one column per wanted key, plus ``reason``.

    A term is ``key~value``; it counts if it has >= 2 parts, the key is wanted
    and the value is non-empty; text after a second '~' is ignored; the last
    counted term of a key wins.  A line lacking any wanted key (or NULL) is
    rejected as ``incomplete``, a complete one whose bytes are no UTF-8 text as ``bad_bytes``.
    """
    # Each step is its own projection so the split / filter work happens once
    # per row (Catalyst does not re-inline non-cheap expressions).
    x = raw.select(*carry, F.col(value_col).cast("string").alias("_line"))  # cast never throws on bad bytes
    x = x.select(*carry, "_line", F.is_valid_utf8("_line").alias("_text"))
    x = x.select(*carry, "_line", "_text", log_terms(F.col("_line")).alias("_terms"))
    x = x.select(*carry, "_line", "_text", *[kv_last_value(F.col("_terms"), k).alias(k) for k in wanted])
    complete = F.lit(True)
    for k in wanted:
        complete = complete & F.col(k).isNotNull()
    reason = F.when(F.col("_line").isNull() | ~complete, F.lit(REASON_INCOMPLETE)).when(~F.col("_text"), F.lit(REASON_BAD_BYTES))
    return x.select(*carry, *wanted, reason.alias("reason"))


def songs_array(audios: Column) -> Column:
    return F.from_json(audios, SONGS_SCHEMA)


def _present_but_null(m: Column, key: str) -> Column:
    return F.map_contains_key(m, F.lit(key)) & F.try_element_at(m, F.lit(key)).isNull()


def parse_songs(records: DataFrame, audios_col: str = "audios", keep: Sequence[str] | None = None) -> DataFrame:
    """P3 reject step: adds ``songs`` (ARRAY<MAP>) and ``reason``.

    Bad JSON, a non-array root or a non-object element make the whole array
    NULL -> ``bad_json``.  A read key present with a JSON null -> ``null_field``
    (the record is lost in the reference).
    """
    keep = list(keep) if keep is not None else [c for c in records.columns if c != audios_col]
    x = records.select(*keep, songs_array(F.col(audios_col)).alias("songs"))
    arr = F.col("songs")
    nullf = F.exists(arr, lambda m: _present_but_null(m, SONG_NAME_KEY) | _present_but_null(m, SINGER_NAME_KEY))
    reason = F.when(arr.isNull(), F.lit(REASON_BAD_JSON)).when(nullf, F.lit(REASON_NULL_FIELD))
    return x.select(*keep, "songs", reason.alias("reason"))


def song_rows(parsed: DataFrame, keep: Sequence[str] = ("event_id", "uid")) -> DataFrame:
    """P3 + P4: one row per kept song (keep..., pos, song_name, singer_text).

    ``pos`` is the element's position in the original array.  A missing key
    reads as ''; a song is kept if name or singer text is non-empty (tested
    before trimming).
    """
    x = parsed.select(*keep, F.posexplode("songs").alias("pos", "m"))
    name = F.coalesce(F.try_element_at(F.col("m"), F.lit(SONG_NAME_KEY)), F.lit(""))
    singer = F.coalesce(F.try_element_at(F.col("m"), F.lit(SINGER_NAME_KEY)), F.lit(""))
    x = x.select(*keep, "pos", name.alias("song_name"), singer.alias("singer_text"))
    return x.where((F.col("song_name") != "") | (F.col("singer_text") != ""))


def with_singers(songs: DataFrame, mode: str = "faithful") -> DataFrame:
    """P5: add ``singers`` ARRAY<STRING> (trimmed, split, empties kept) and ``first_singer``."""
    s = singer_list(F.col("singer_text"), mode)
    return songs.withColumn("singers", s).withColumn("first_singer", F.get(F.col("singers"), 0))
