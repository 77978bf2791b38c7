"""Files of queue records grow with the records."""

import glob

from coldflow.operators.batches import BatchTable
from coldflow.plans import recall as batch_plans
from coldflow.plans import streams
from tests.conftest import SF_SMALL, rows


def test_record_files_grow_with_the_records(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_RECORDS", 50)
    monkeypatch.setattr(streams, "_REPLAYS", {})
    base = streams._replay(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert len(glob.glob(f"{base.removeprefix('file:')}/in/*.parquet")) >= n // 50
    assert len(BatchTable(f"{base}/zset/batches").finished(spark)) == 2
    assert rows(streams.ZsetTable(f"{base}/zset").view(spark)) == rows(batch_plans.q_recall_zset(spark, SF_SMALL))
