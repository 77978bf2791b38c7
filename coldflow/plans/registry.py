"""All registered queries: key -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from coldflow.plans import graph, keyed, misc, recall, streams


def queries():
    out = {}
    out.update(recall.QUERIES)
    out.update(keyed.QUERIES)
    out.update(graph.QUERIES)
    out.update(misc.QUERIES)
    out.update(streams.QUERIES)
    return out
