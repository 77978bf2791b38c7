"""Column-level text helpers (all JVM-side built-ins, no Python UDF).

Every function takes and returns ``Column`` objects so that callers keep the
work inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Field separator of a log line and the key/value separator inside a field.
LOG_FIELD_SEP = "\x1f"
LOG_KV_SEP = "~"
# Song JSON keys read from every element of the audios array.
SONG_NAME_KEY = "d_songname"
SINGER_NAME_KEY = "d_singername"
# Singer separator class, exactly as the reference writes it: ',' then the
# range '_'..'、' (U+005F..U+3001), then '、' again.  The range makes every
# lower-case Latin letter a separator; that is reproduced on purpose.
SINGER_SEP_FAITHFUL = "[,_-、、]"
# The class the reference evidently meant: ',', '_', '-', '、'.
SINGER_SEP_LITERAL = "[,_\\-、]"
# Java's String.trim() strips every code point from U+0000 to U+0020.
JAVA_TRIM_PATTERN = "^[\\x00-\\x20]+|[\\x00-\\x20]+$"
# Key prefix of the live recall sorted sets.
RECALL_KEY_PREFIX = "res:recom:fancy:"

SINGER_SEPARATORS = {"faithful": SINGER_SEP_FAITHFUL, "literal": SINGER_SEP_LITERAL}


def java_trim(c: Column) -> Column:
    """Java ``String.trim``: strip U+0000..U+0020 at both ends (Spark trim only strips spaces)."""
    return F.regexp_replace(c, F.lit(JAVA_TRIM_PATTERN), F.lit(""))


def split_keep_empty(c: Column, pattern: str) -> Column:
    """Java ``split(regex, -1)``: all parts, empty ones included."""
    return F.split(c, pattern, -1)


def singer_list(raw: Column, mode: str = "faithful") -> Column:
    """P5: trim, then split on the singer separator class, keeping empties."""
    sep = SINGER_SEPARATORS.get(mode, mode)
    return split_keep_empty(java_trim(raw), sep)


# One token per Han letter/digit, otherwise runs of letters/digits (Java
# regex class intersection; one pass over the text).
TOKEN_PATTERN = "[\\p{IsHan}&&[\\p{L}\\p{N}]]|[\\p{L}\\p{N}&&[^\\p{IsHan}]]+"


def analyze(text: Column) -> Column:
    """Full-text analyzer: ARRAY<STRING> of terms.

    Lower-case; every Han letter or digit is a term of its own; otherwise
    maximal runs of letters and digits.  (Equivalent to isolating Han
    characters by spaces and taking runs of letters/digits, in one pass.)
    """
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def kv_last_value(terms_as_pairs: Column, key: str) -> Column:
    """Value of the last accepted ``key~value`` term, NULL if none.

    ``terms_as_pairs`` is ARRAY<ARRAY<STRING>> (each term split on '~').
    A term is accepted if it has >= 2 parts, its key matches and part 1 is
    non-empty; text after a second '~' is ignored.
    """
    hits = F.filter(
        terms_as_pairs,
        lambda p: (F.size(p) >= 2) & (p.getItem(0) == F.lit(key)) & (p.getItem(1) != F.lit("")),
    )
    return F.try_element_at(hits, F.lit(-1)).getItem(1)
