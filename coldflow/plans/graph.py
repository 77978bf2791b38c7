"""Registered graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from coldflow.operators import graph
from coldflow.session import scratch_path, stage_table
from coldflow.sources import fixtures
from coldflow.sources.tables import Tables


def _graph(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t, fixtures.nodes(t), fixtures.edges(t)


def q_liked_items(spark, sf_dir):
    _, n, e = _graph(spark, sf_dir)
    return graph.liked_names(n, e, stage=stage_table)


def q_liked_export(spark, sf_dir):
    """S10 -> J8 -> A3 -> K8: uid file and exported lines are written as text and read back."""
    t, n, e = _graph(spark, sf_dir)
    path = scratch_path(spark, "uid-file")
    fixtures.uid_lines(t).write.mode("overwrite").text(path)
    uids = graph.uid_file(spark.read.text(path))
    out = scratch_path(spark, "liked-export")
    graph.write_export(graph.export_lines(uids, graph.liked_names(n, e, stage=stage_table, lists=True)), out)
    return spark.read.text(out).select(F.substring_index("value", ": ", 1).alias("uid"), F.col("value").alias("line"))


def q_graph_get_or_create(spark, sf_dir):
    t, n, _ = _graph(spark, sf_dir)
    return graph.get_or_create(fixtures.requested_users(t), n)


def q_graph_assign(spark, sf_dir):
    t, n, _ = _graph(spark, sf_dir)
    now_stamp = int(fixtures.GRAPH_TODAY.strftime("%Y%m%d") + "000000")
    return graph.assign_celebrities(fixtures.requested_users(t), n, now_stamp)


def q_graph_expire_edges(spark, sf_dir):
    _, n, e = _graph(spark, sf_dir)
    return graph.expire_likes(n, e, fixtures.GRAPH_TODAY)


def q_graph_expire_users(spark, sf_dir):
    _, n, e = _graph(spark, sf_dir)
    removed, _ = graph.expire_users(n, e, fixtures.GRAPH_TODAY)
    return removed


def q_all_uids(spark, sf_dir):
    _, n, _ = _graph(spark, sf_dir)
    return graph.all_uids(n)


def q_interest_merge(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return graph.merge_interests(fixtures.interest_stored(t), fixtures.interest_batch(t), "as_written")


def q_interest_merge_newer(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return graph.merge_interests(fixtures.interest_stored(t), fixtures.interest_batch(t), "newer_wins")


QUERIES = {
    "liked_items": q_liked_items,
    "liked_export": q_liked_export,
    "graph_get_or_create": q_graph_get_or_create,
    "graph_assign": q_graph_assign,
    "graph_expire_edges": q_graph_expire_edges,
    "graph_expire_users": q_graph_expire_users,
    "all_uids": q_all_uids,
    "interest_merge": q_interest_merge,
    "interest_merge_newer": q_interest_merge_newer,
}
