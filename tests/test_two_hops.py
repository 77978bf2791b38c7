"""Two hops: edges computed once, a work met again only for names below the bound."""

import pytest
from pyspark.sql import functions as F

from coldflow.operators import graph
from coldflow.session import scratch_path
from tests.conftest import rows


def test_edges_are_computed_once_for_both_directions(spark):
    edges = spark.range(20).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit("LIKE").alias("type"))
    both = graph.undirected(edges, "LIKE")
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert rows(both) == sorted([(i, i + 1) for i in range(20)] + [(i + 1, i) for i in range(20)])


def test_only_pairs_with_names_below_the_bound_meet_a_work_again(spark):
    nodes = [(f"u{i}", "USER", str(i), f"u{i}") for i in range(6)] + [(f"m{i}", "MOVIE", None, f"m{i}") for i in range(8)]
    nodes += [(f"c{i}", "CELEBRITY", None, f"c{i * 7 % 90:02d}") for i in range(90)]
    edges = [(f"u{i}", f"m{j}", "LIKE") for i in range(6) for j in range(8) if (i + j) % 3]
    edges += [(f"c{i}", f"m{i * j % 8}", "ACT") for i in range(90) for j in (1, 3)]
    n = spark.createDataFrame(nodes, "id string, label string, uid string, name string")
    e = spark.createDataFrame(edges, "src string, dst string, type string")
    every = {}
    for uid, name in rows(graph.liked_names(n, e, None)):
        every.setdefault(uid, []).append(name)
    staged = {}

    def stage(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        staged[name] = spark.read.parquet(path)
        return staged[name]

    for limit in (2, 10, 500):
        assert rows(graph.liked_names(n, e, limit, stage)) == sorted((u, x) for u, names in every.items() for x in sorted(names)[:limit])
    assert staged["heads"].count() == staged["likes"].count()  # a pair is one row, its first names an array


def graph_of(spark, names_of_actors):
    """30 users, 12 works, 200 actors; users 0 and 1 like every work, user 29 none."""
    nodes = [(f"u{i}", "USER", str(i), None if i % 3 else f"n{i}") for i in range(30)] + [(f"m{i}", "MOVIE", None, f"m{i}") for i in range(12)]
    nodes += [(f"c{i}", "CELEBRITY", None, names_of_actors(i)) for i in range(200)]
    edges = [(f"u{i}", f"m{j}", "LIKE") for i in range(29) for j in range(12) if i < 2 or (i * j) % 5 == 1] + [("m3", "u5", "LIKE"), ("u6", "u7", "LIKE")] * 2
    edges += [(f"c{i}", f"m{j}", "ACT") for i in range(200) for j in range(12) if (i + j) % 4 == 0] + [("m0", "c3", "ACT")] * 3
    n = spark.createDataFrame(nodes, "id string, label string, uid string, name string")
    return n, spark.createDataFrame(edges, "src string, dst string, type string")


@pytest.mark.parametrize("few_names", [False, True])
@pytest.mark.parametrize("list_names", [60, 200_000])
def test_names_in_lists_are_the_names_one_by_one(spark, monkeypatch, few_names, list_names):
    """A work whose actors share few names is looked at again; users with long lists go name by name."""
    monkeypatch.setattr(graph, "LIST_NAMES", list_names)
    n, e = graph_of(spark, lambda i: f"a{i % 7}" if few_names else f"a{i * 37 % 200:03d}")
    every, staged = {}, {}
    for uid, name in rows(graph.liked_names(n, e, None)):
        every.setdefault(uid, []).append(name)

    def stage(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        staged[name] = spark.read.parquet(path)
        return staged[name]

    assert len(every) > 20
    for limit in (1, 8, 20):
        expected = {u: sorted(names)[:limit] for u, names in every.items()}
        assert dict(rows(graph.liked_names(n, e, limit, stage, lists=True))) == expected
        assert rows(graph.liked_names(n, e, limit, stage)) == sorted((u, x) for u, names in expected.items() for x in names)
        busy = staged["busy-users"].count()
        assert staged["first-names"].count() == len(every) - busy  # a user is one row
        assert (busy > 0) == (list_names == 60 and limit >= 8)
    assert ("work-more-names" in staged) == few_names


def test_export_takes_a_users_names_as_a_list(spark):
    n, e = graph_of(spark, lambda i: f"a{i:03d}")
    uids = spark.createDataFrame([("0",), ("5",), ("29",), ("x",)], "uid string")
    lines = rows(graph.export_lines(uids, graph.liked_names(n, e, lists=True)))
    assert lines == rows(graph.export_lines(uids, graph.liked_names(n, e))) and [x for x in lines if x[0] == "29"] == [("29", "29: ")]
    listed = graph.export_lines(uids, spark.createDataFrame([("0", ["a", "b"])], "uid string, names array<string>"))
    assert "collect_list" not in listed._jdf.queryExecution().optimizedPlan().toString()
    assert rows(listed)[0] == ("0", "0: a b ")
