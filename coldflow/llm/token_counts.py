"""Offset-mapped token counts (1): encode whole documents once, attribute tokens to sections by interval.

Tokens of a byte-level vocabulary cover the text's bytes without gaps, so
their spans are the running sum of their byte lengths.  Sections are
character spans of the same text; the interval join of the two sorted lists
is a pair of binary searches per section, inside the task that encoded the
document.  Sections may leave gaps, overlap or be empty.

A token that crosses a section boundary is allocated by ``rule``:

* ``start`` (default): to the sections that hold its first byte;
* ``end``: to the sections that hold its last byte;
* ``share``: to every section by the share of its bytes in it (counts are
  fractions; they add up to the document's tokens where sections tile it).

Defined cases: a null text is empty and has no token; an empty text has one
empty line section with 0 tokens; a null section list has no rows; spans are
cut to the text; repeated rows each give their own rows; further columns of
the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldflow.llm.encode import encoder
from coldflow.llm.text import blocks, column_bytes

RULES = ("start", "end", "share")
SCHEMA = "doc_id long, section int, start_char int, end_char int, n_tokens double, n_crossing int, doc_tokens long"


def allocate(token_end: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of byte spans ``begin:end`` over tokens that end at ``token_end`` (ascending)."""
    token_start = np.concatenate([[0], token_end[:-1]]).astype(np.int64)
    starts_in = np.searchsorted(token_start, end) - np.searchsorted(token_start, begin)
    ends_in = np.searchsorted(token_end, end, side="right") - np.searchsorted(token_end, begin, side="right")
    inside = np.maximum(0, np.searchsorted(token_end, end, side="right") - np.searchsorted(token_start, begin))
    # tokens that touch the span: first one ending after begin, last one starting before end
    touch = np.maximum(0, np.searchsorted(token_start, end) - np.searchsorted(token_end, begin, side="right"))
    empty = end <= begin
    crossing = np.where(empty, 0, touch - np.minimum(inside, touch))
    if rule == "start":
        n = starts_in.astype(np.float64)
    elif rule == "end":
        n = ends_in.astype(np.float64)
    else:
        covered = np.concatenate([[0.0], np.cumsum(np.ones(len(token_end)))])
        at = np.concatenate([[0], token_end])
        n = np.interp(end, at, covered) - np.interp(begin, at, covered) if len(token_end) else np.zeros(len(begin))
    return np.where(empty, 0.0, n), crossing.astype(np.int64)


def attribute(docs: DataFrame, vocabulary: str, sections: Column | None = None, rule: str = "start", id_column: str = "doc_id") -> DataFrame:
    """One row per section of each document of ``docs`` (an id, text).

    ``sections`` is an array of structs (start, end) in characters, end
    exclusive; without it every line, with the line feed that ends it, is a
    section.  ``n_tokens`` follows ``rule``; ``n_crossing`` counts the tokens
    that lie only partly in the section; ``doc_tokens`` those of the document.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    own = sections is not None
    columns = [F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if own:
        columns.append(F.transform(sections, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))).alias("sections"))

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            spans = b.column("sections").to_pylist() if own else None
            for i, j in blocks(offsets):
                ids, count = enc.block(data, offsets[i : j + 1])
                size = enc.id_bytes[ids]
                upto = np.cumsum(count)
                out: list[list[np.ndarray]] = []
                for k in range(j - i):
                    text = data[offsets[i + k] : offsets[i + k + 1]]
                    token_end = np.cumsum(size[upto[k] - count[k] : upto[k]])
                    char_at = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))  # byte offset of each character
                    if own:
                        s = np.array([(x["start"] or 0, x["end"] or 0) for x in spans[i + k] or [] if x], np.int64).reshape(-1, 2)
                        s = np.clip(s, 0, len(char_at) - 1)
                        first, last = s[:, 0], np.maximum(s[:, 0], s[:, 1])
                        begin, end = char_at[first], char_at[last]
                    else:
                        feed = np.flatnonzero(text == 10) + 1
                        end = feed if len(feed) and feed[-1] == len(text) else np.append(feed, len(text))
                        begin = np.concatenate([[0], end[:-1]])
                        first, last = np.searchsorted(char_at, begin), np.searchsorted(char_at, end)
                    n, crossing = allocate(token_end, begin, end, rule)
                    out.append([np.full(len(n), i + k), np.arange(len(n)), first, last, n, crossing, np.full(len(n), count[k])])
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(cols[0])), *(pa.array(c.astype(np.int32)) for c in cols[1:4]), pa.array(cols[4]), pa.array(cols[5].astype(np.int32)), pa.array(cols[6].astype(np.int64))],
                    ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"],
                )

    return docs.select(*columns).mapInArrow(run, SCHEMA)


def attribute_fields(rows: DataFrame, vocabulary: str, fields: list[str], separator: str = "\n", rule: str = "start", id_column: str = "doc_id") -> DataFrame:
    """Encode the ``fields`` of each row as one document, joined by ``separator``; section k is the k-th field."""
    text, spans, at = F.lit(""), [], F.lit(0)
    for k, name in enumerate(fields):
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if k:
            text, at = F.concat(text, F.lit(separator)), at + len(separator)
        spans.append(F.struct(at.alias("start"), (at + F.length(value)).alias("end")))
        text, at = F.concat(text, value), at + F.length(value)
    whole = rows.select(F.col(id_column), text.alias("text"), F.array(*spans).alias("own_sections"))
    return attribute(whole, vocabulary, F.col("own_sections"), rule, id_column)
