"""Time helpers (P6, P12, P13) that do not depend on the session time zone.

Text is parsed into TIMESTAMP_NTZ (wall-clock time) and epoch values are
computed from the NTZ value as UTC, so the same input gives the same
numbers on every cluster.
"""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
DEFAULT_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-M-d H:m:s", "yyyy-M-d")


def parse_ntz(text: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """First format that parses, as TIMESTAMP_NTZ; NULL when none does (never throws).

    The reference's lenient parser accepts single-digit fields; the later
    formats of the default list cover that.
    """
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


_FIELDS = {"y": "year", "M": "month", "d": "day", "H": "hour", "m": "minute", "s": "second", "S": "milli"}
# English month names of the lenient parser, first three letters (fixed values).
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MAX_FIELD = 10_000_000


def _lenient_pattern(fmt: str) -> tuple[str, list[str]]:
    """(regular expression anchored at the start, field of each group) of a date pattern."""
    whole = [m.group(0) for m in re.finditer(r"'(?:[^']|'')*'|([A-Za-z])\1*|[^A-Za-z']", fmt)]
    out, fields = "^", []
    for k, part in enumerate(whole):
        if part[0] == "'":
            out += re.escape(part[1:-1].replace("''", "'") or "'")
        elif not part[0].isalpha():
            out += re.escape(part)
        elif part.startswith("MMM"):
            out += r"\s*([A-Za-z]+)"
            fields.append("month_name")
        elif part[0] not in _FIELDS or part == "yy":
            raise ValueError(f"pattern letters {part!r} are not supported")
        else:  # directly before another number, a number has as many digits as letters
            abuts = k + 1 < len(whole) and whole[k + 1][0] in _FIELDS and not whole[k + 1].startswith("MMM")
            out += rf"\s*(\d{{{len(part)}}})" if abuts else r"\s*(-?\d+)"
            fields.append(_FIELDS[part[0]])
    return out, fields


def lenient_ntz(text: Column, fmt: str) -> Column:
    """``text`` read by a date pattern the lenient way, as TIMESTAMP_NTZ; NULL if it does not fit.

    Fields may have any number of digits and run over: 2016-02-30 is 2016-03-01, month 13 the next
    January, month 0 the December before, hour 25 the next day at one.  Missing fields are those of
    1970-01-01 00:00.  Text behind the pattern is ignored.  Letters y M d H m s S and
    English month names (MMM, in full or their first three letters) are known; the calendar is Gregorian at
    all times; a field beyond ``MAX_FIELD`` gives NULL.
    """
    pattern, names = _lenient_pattern(fmt)
    raw = {name: F.regexp_extract(text, pattern, k + 1) for k, name in enumerate(names)}
    value = {}
    for name, missing in (("year", 1970), ("month", 1), ("day", 1), ("hour", 0), ("minute", 0), ("second", 0), ("milli", 0)):
        value[name] = raw[name].try_cast("bigint") if name in raw else F.lit(missing).cast("bigint")
    if "month_name" in raw:
        name = F.lower(raw["month_name"])
        short = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(name, 1, 3))
        full = F.array(*[F.lit(m) for m in ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")])
        value["month"] = F.when((F.length(name) == 3) & (short > 0), short).when(F.array_position(full, name) > 0, F.array_position(full, name))
    fits = text.rlike(pattern)
    for v in value.values():
        fits = fits & (F.abs(v) <= MAX_FIELD)
    months = value["year"] * 12 + value["month"] - 1
    year = F.floor(months / 12)
    first = F.try_make_timestamp_ntz(year.cast("int"), (months - year * 12 + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    more = F.make_dt_interval(
        (value["day"] - 1).cast("int"), value["hour"].cast("int"), value["minute"].cast("int"),
        (value["second"] + value["milli"] / F.lit(1000)).cast("decimal(18,6)"),
    )
    return F.when(F.coalesce(fits, F.lit(False)), first + more)


def formatted(ts: Column, fmt: str) -> Column:
    """P12, the other way: a time as text in a given format."""
    return F.date_format(ts, fmt)


def epoch_millis(ts_ntz: Column) -> Column:
    """Milliseconds since 1970-01-01 00:00 of an NTZ value, read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), ts_ntz)


def stamp14(ts: Column) -> Column:
    """yyyyMMddHHmmss text."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def request_id(ts_ntz: Column) -> Column:
    """Request id = ingest epoch ms as text."""
    return epoch_millis(ts_ntz).cast("string")
