"""Occurrences come from the automata over passages, wherever those were cut."""

import numpy as np
import pyarrow as pa

from coldflow.llm import substring


def _located(texts, passages, **kwargs):
    w = substring.block_words(texts)
    gone = substring.located(w, pa.chunked_array([pa.array([p.encode() for p in passages], pa.binary())]), **kwargs)
    return [int(gone[a:z].sum()) for a, z in zip(w.offset[:-1], w.offset[1:], strict=True)]


def _words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_passages_of_other_blocks_are_found():
    texts = ["before " + _words("p", 40) + " after", _words("q", 60), None, "", _words("p", 40)]
    assert _located(texts, [_words("p", 40)]) == [40, 0, 0, 0, 40]
    assert _located(texts, []) == [0, 0, 0, 0, 0]
    assert _located(texts, [_words("strange", 40)]) == [0, 0, 0, 0, 0]


def test_overlapping_and_nested_passages_in_several_automata():
    text = _words("p", 100)
    w = text.split()
    found = [" ".join(w[a:z]) for a, z in ((0, 40), (3, 40), (30, 70), (65, 100))]
    for size in (1, 50, 10_000):
        assert _located([text, text + " x"], found, shard_words=size) == [100, 100]
    assert _located([text], found[:2], shard_words=1) == [40]


def test_a_passage_is_filed_under_its_rarest_anchor():
    w = substring.block_words([_words("p", 50)])
    start = np.array([0, 1, 2, 10])
    anchor, found = np.array([7, 8, 9, 9], np.uint64), np.array([5, 2, 2, 3])
    got = substring.block_passages(w, start, anchor, found)
    assert sorted(got.values()) == sorted([(8, _words("p", 37).encode()), (9, " ".join(f"p{i}" for i in range(10, 45)).encode())])
