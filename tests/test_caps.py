"""Limits that are features of the reference hold on the registered queries (sf0.001)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from tests.conftest import SF_SMALL


@pytest.mark.parametrize(
    "key,group,cap",
    [
        ("liked_items", "uid", 50),
        ("channel_topk", "channel", 5),
        ("title_newest", "keyword", 3),
        ("title_relevance", "keyword", 30),
        ("recall_zset", "key", 200),
        ("recall_capped", "event_id", 3),
    ],
)
def test_cap_holds(spark, key, group, cap):
    df = se.queries()[key](spark, SF_SMALL)
    worst = df.groupBy(group).count().agg(F.max("count")).collect()[0][0]
    assert worst is None or worst <= cap
