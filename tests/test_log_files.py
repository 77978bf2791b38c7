"""Files of a written log grow with its rows."""

import glob

from coldflow.operators import batches
from coldflow.operators.batches import BatchTable, KeyedLog
from tests.conftest import rows


def test_log_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "FILE_ROWS", 10)
    writes = [(f"k{i % 7}", '{"individual":"%d"}' % i, i) for i in range(40)]
    log = KeyedLog(str(tmp_path / "log"), "hash", 2)
    batches.write_profiles(log, spark.createDataFrame(writes, "key string, template string, version long"), 0)
    assert len(glob.glob(f"{BatchTable(log.path).folder(0)}/bucket=*/*.parquet")) > 10  # 280 rows
    found = log.view(spark).where("field = 'individual'").select("key", "value")
    assert rows(found) == sorted((f"k{i % 7}", str(i)) for i in range(33, 40))
