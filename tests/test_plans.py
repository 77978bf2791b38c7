"""Plan checks over every registered query.

No Python evaluation in the plan, no cartesian product or nested-loop join,
no window without a partition key (a single-partition window), and scans
read only the columns they use.
"""

import pytest

import __spark_entry__ as se
from coldflow.plans import registry
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_plan_is_clean(spark, key):
    df = se.queries()[key](spark, SF_SMALL)
    plan = _plan(df)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"
    assert "SinglePartition" not in plan, f"{key}: single-partition exchange"


def test_scan_prunes_columns(spark):
    df = se.queries()["kv_ttl"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # events has 6 columns; the view reads 5 (not ``props``)
    assert "props" not in plan


@pytest.mark.parametrize("key", ["channel_topk", "liked_items", "title_relevance", "recall_capped"])
def test_topk_is_trimmed_before_the_shuffle(spark, key):
    """Top-k per group with a literal bound plans a WindowGroupLimit (partial, map-side)."""
    df = se.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan, key


def test_match_topk_is_trimmed(spark):
    """The top-5 singer match (written as a stage table in the registered query) trims map-side too."""
    from pyspark.sql import functions as F

    from coldflow.operators.match import build_index, match
    from coldflow.sources import fixtures
    from coldflow.sources.tables import Tables

    ring = fixtures.ring(Tables(spark, SF_SMALL))
    idx = build_index(ring, "item_id", "singer", payload=["fire"])
    for prune in (False, True):
        df = match(ring.select(F.col("singer").alias("q")), "q", idx, 5, prune=prune)
        assert "WindowGroupLimit" in _plan(df)
