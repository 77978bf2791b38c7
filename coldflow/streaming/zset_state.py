"""K2 + K5 as a stream: sorted sets whose keys expire, kept as keyed state with timers.

The stream form of ``coldflow.operators.keyed.zset_ttl_view``: each key's state is
its members with scores and its expiry.  A write changes it; an event-time timer
empties it when the watermark passes the expiry.  The output is a log of
changes (key, member, score, at, seq): score is null for a member that left.  A member's last change in
(at, seq) order is what a client sees.

State holds one sorted set per key, as the store would.  Writes of a key within one
micro-batch are applied in (write_ts, version) order; a micro-batch is bounded by the
source's rate options.  Spark drops writes that arrive behind the watermark; ``delay`` says
how late one may come.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key string, member string, score double, at timestamp, seq long"
_STATE = "members array<string>, scores array<double>, expires long"


def _changes(key: str, rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["member", "score", "at", "seq"])
    frame.insert(0, "key", key)
    frame["score"] = frame["score"].astype("float64")
    frame["at"] = pd.to_datetime(frame["at"], unit="ms")
    return frame


def apply_writes(members: dict[str, float], expires: int | None, writes: pd.DataFrame) -> tuple[dict[str, float], int | None, list[tuple]]:
    """State after the writes of one key, and its changes (member, score or None, epoch ms, number)."""
    out: list[tuple] = []
    for (at, version), rows in writes.groupby(["ms", "version"], sort=True):
        if expires is not None and at >= expires:
            out += [(m, None, expires, -1) for m in members]
            members, expires = {}, None
        first = rows.iloc[0]
        if first["op"] in ("replace", "delete"):
            left = set(members) - (set(rows["member"].dropna()) if first["op"] == "replace" else set())
            out += [(m, None, at, int(version)) for m in sorted(left)]
            members, expires = {}, None
        if first["op"] != "delete":
            for member, score in zip(rows["member"], rows["score"], strict=True):
                if member is not None:
                    members[member] = score
                    out.append((member, score, at, int(version)))
        if first["ttl"] is not None and first["ttl"] > 0:
            expires = int(at) + 1000 * int(first["ttl"])
    return members, expires, out


def _fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    members, expires = {}, None
    if state.exists:
        names, scores, expires = state.get
        members = dict(zip(names, scores, strict=True))
    if state.hasTimedOut:
        state.remove()
        if members:
            yield _changes(key[0], [(m, None, expires, -1) for m in members])
        return
    writes = pd.concat(list(parts))
    members, expires, out = apply_writes(members, expires, writes)
    mark = state.getCurrentWatermarkMs()
    if expires is not None and expires <= mark:
        out += [(m, None, expires, -1) for m in members]
        members, expires = {}, None
    if members:
        state.update((list(members), list(members.values()), expires))
        if expires is not None:
            state.setTimeoutTimestamp(expires)
    elif state.exists:
        state.remove()
    if out:
        yield _changes(key[0], out)


def expiring_sets(ops: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Changes of the sorted sets that a stream of writes (key, member, score, op, ttl, write_ts TIMESTAMP, version) makes."""
    rows = ops.where(F.col("key").isNotNull()).withWatermark("write_ts", delay)
    rows = rows.withColumn("ms", F.unix_millis("write_ts"))
    return rows.groupBy("key").applyInPandasWithState(_fold, OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def current_members(changes: DataFrame) -> DataFrame:
    """(key, member, score) after all changes."""
    last = changes.groupBy("key", "member").agg(F.max_by("score", F.struct("at", "seq")).alias("score"))
    return last.where(F.col("score").isNotNull())
