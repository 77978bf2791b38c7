"""Graph cases of FIXTURES.md 1.4."""

import datetime as dt

from coldflow.operators import graph
from tests.conftest import rows

NODE = "id string, label string, uid string, name string"
EDGE = "src string, dst string, type string, frequency int, last_time long"


def test_edge_and_user_expiry(spark):
    nodes = spark.createDataFrame(
        [("u1", "USER", "1", None), ("u2", "USER", "2", None), ("u3", "USER", "3", None), ("m", "MOVIE", None, "m")], NODE
    )
    edges = spark.createDataFrame(
        [("u1", "m", "LIKE", 1, 20240130235959), ("u2", "m", "LIKE", 1, 20240131000000), ("u1", "m", "LIKE", 1, None)], EDGE
    )
    today = dt.date(2024, 3, 1)
    exp = graph.expire_likes(nodes, edges, today)
    assert set(rows(exp, "src", "last_time", "expired")) == {
        ("u1", None, False),
        ("u1", 20240130235959, True),
        ("u2", 20240131000000, False),
    }
    removed, blocked = graph.expire_users(nodes, edges, today)
    assert rows(removed, "uid") == [("3",)]  # u3 never had a LIKE
    assert blocked.count() == 0


def test_uid_file(spark):
    lines = spark.createDataFrame([("n1 u1  ",), ("u1",), ("",), ("   ",), ("a b u2",)], "value string")
    assert rows(graph.uid_file(lines)) == [("u1",), ("u2",)]


def test_liked_two_hops(spark):
    nodes = spark.createDataFrame(
        [("u", "USER", "1", None), ("m", "MOVIE", None, "m"), ("c", "CELEBRITY", None, "c"), ("m2", "MOVIE", None, "m2"), ("m3", "MOVIE", None, "m3")],
        NODE,
    )
    edges = spark.createDataFrame(
        [("u", "m", "LIKE", 1, 1), ("c", "m", "ACT", None, None), ("m2", "m", "ACT", None, None), ("c", "m3", "ACT", None, None)], EDGE
    )
    assert rows(graph.liked_names(nodes, edges), "name") == [("c",), ("m",), ("m2",)]
    uids = spark.createDataFrame([("1",), ("9",)], "uid string")
    lines = dict(rows(graph.export_lines(uids, graph.liked_names(nodes, edges)), "uid", "line"))
    assert lines == {"1": "1: c m m2 ", "9": "9: "}


def test_assign(spark):
    nodes = spark.createDataFrame(
        [("u:b", "USER", "b", None)] + [(f"c:{i}", "CELEBRITY", None, str(i)) for i in range(1, 8)], NODE
    )
    req = spark.createDataFrame([("a",), ("b",), ("c",)], "uid string")
    out = graph.assign_celebrities(req, nodes, 20240101000000)
    assert rows(out, "src", "dst") == [("u:a", "c:1"), ("u:a", "c:2"), ("u:c", "c:3"), ("u:c", "c:4")]
