"""Stream = batch: same view with 1 or 2 files per trigger,
and a restart from the checkpoint reads nothing twice."""

from coldflow.operators import recall
from coldflow.plans import recall as batch_plans
from coldflow.plans.streams import q_stream_recall_zset, write_log_records
from coldflow.session import scratch_path
from coldflow.sources import fixtures
from coldflow.sources.logsource import file_log_stream
from coldflow.sources.tables import Tables
from coldflow.streaming.recall_stream import ZsetTable, materialize_catalogue, run_recall_stream
from tests.conftest import SF_SMALL, rows


def test_stream_equals_batch(spark):
    batch = rows(batch_plans.q_recall_zset(spark, SF_SMALL))
    assert rows(q_stream_recall_zset(spark, SF_SMALL, files=3, files_per_trigger=1)) == batch
    assert rows(q_stream_recall_zset(spark, SF_SMALL, files=3, files_per_trigger=2)) == batch


def test_restart_reads_nothing_twice(spark):
    base = scratch_path(spark, "restart")
    write_log_records(spark, SF_SMALL, f"{base}/in", 2)
    cat = materialize_catalogue(recall.build_catalogue(fixtures.ring(Tables(spark, SF_SMALL))), f"{base}/index")
    for _ in range(2):
        stream = file_log_stream(spark, f"{base}/in", 1)
        run_recall_stream(spark, stream, cat, f"{base}/zset", f"{base}/ckpt")
    batches = spark.read.parquet(f"{base}/zset/batches").select("batch_id").distinct().count()
    assert batches == 2  # the second run found no new files
    assert rows(ZsetTable(f"{base}/zset").view(spark)) == rows(batch_plans.q_recall_zset(spark, SF_SMALL))


def test_stream_dedup_by_message_id(spark):
    """T-6 stream form: each msg_id leaves the stream once."""
    from pyspark.sql import functions as F

    from coldflow.operators.messages import dedup_stream

    base = scratch_path(spark, "dedup")
    msgs = fixtures.messages(Tables(spark, SF_SMALL))
    msgs.repartitionByRange(3, "store_ts").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = (
        dedup_stream(stream, "100 days")
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ck")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == out.select("msg_id").distinct().count() == msgs.select("msg_id").distinct().count()
    assert out.groupBy("msg_id").agg(F.count("*").alias("n")).where("n > 1").count() == 0


def test_rewriting_a_batch_id_changes_nothing(spark):
    """A retried micro-batch overwrites its own files: the view is unchanged."""
    base = scratch_path(spark, "retry")
    table = ZsetTable(f"{base}/zset")
    rows1 = spark.createDataFrame([("k", "a", 1.0, 1), ("k", "b", 2.0, 1)], "key string, member string, score double, version long")
    rows2 = spark.createDataFrame([("k", "c", 3.0, 2)], "key string, member string, score double, version long")
    table.write_batch(rows1, 0)
    table.write_batch(rows2, 1)
    before = rows(table.view(spark))
    table.write_batch(rows2, 1)
    assert rows(table.view(spark)) == before == [("k", "c", 3.0)]


def test_stream_metrics_written(spark):
    """K9: one metrics row per recall write, with a non-negative latency from the sink clock."""
    base = scratch_path(spark, "metrics")
    write_log_records(spark, SF_SMALL, f"{base}/in", 2)
    cat = materialize_catalogue(recall.build_catalogue(fixtures.ring(Tables(spark, SF_SMALL))), f"{base}/index")
    run_recall_stream(spark, file_log_stream(spark, f"{base}/in", 2), cat, f"{base}/zset", f"{base}/ck", f"{base}/m")
    m = spark.read.parquet(f"{base}/m")
    assert m.count() > 0
    assert m.where("latency_ms < 0 OR n_items < 1 OR n_items > 200").count() == 0


def test_compaction_keeps_the_view(spark):
    """Compacting the sorted-set log into a base changes no visible row; later batches still apply."""
    base = scratch_path(spark, "compact")
    table = ZsetTable(f"{base}/zset")
    schema = "key string, member string, score double, version long"
    table.write_batch(spark.createDataFrame([("k", "a", 1.0, 1), ("j", "x", 5.0, 1)], schema), 0)
    table.write_batch(spark.createDataFrame([("k", "b", 2.0, 2)], schema), 1)
    before = rows(table.view(spark))
    table.compact(spark)
    assert rows(table.view(spark)) == before == [("j", "x", 5.0), ("k", "b", 2.0)]
    table.write_batch(spark.createDataFrame([("j", "y", 6.0, 3)], schema), 2)
    table.compact(spark)
    table.write_batch(spark.createDataFrame([("k", "c", 7.0, 4)], schema), 3)
    assert rows(table.view(spark)) == [("j", "y", 6.0), ("k", "c", 7.0)]


def test_runner_cli_with_files(spark):
    """The job runner replays queue records from files and leaves the same view as the batch query."""
    from coldflow.streaming.run import main

    base = scratch_path(spark, "runner")
    write_log_records(spark, SF_SMALL, f"{base}/in", 2)
    fixtures.ring(Tables(spark, SF_SMALL)).write.parquet(f"{base}/ring")
    main(
        ["--catalogue", f"{base}/ring", "--table", f"{base}/zset", "--checkpoint", f"{base}/ck",
         "--files", f"{base}/in", "--files-per-trigger", "2", "--once"],
        spark=spark,
    )
    assert rows(ZsetTable(f"{base}/zset").view(spark)) == rows(batch_plans.q_recall_zset(spark, SF_SMALL))


def test_catalogue_changes_while_the_job_runs(spark):
    """An item added and one removed between two micro-batches change the second; misses and rejects are per batch."""
    from coldflow.operators.batches import BatchTable
    from coldflow.operators.posting_store import CatalogueStore

    base = scratch_path(spark, "midstream")
    ring = "item_id string, name string, singer string, fire int"
    store = recall.build_store(spark.createDataFrame([("1", "old song", "A", 1), ("2", "other", "B", 2), ("3", "no fire", "C", None)], ring), f"{base}/index")
    assert isinstance(store, CatalogueStore)
    line = '[{"d_songname":"new song","d_singername":""},{"d_songname":"other","d_singername":"B"}]'
    for n in range(2):
        if n:
            changes = spark.createDataFrame([("9", "new song", "D", 9, False), ("2", None, None, None, True), ("1", "x", "y", None, False)], ring + ", deleted boolean")
            assert recall.change_store(store, changes) == 1
        log = [(f"uid~u{n}\x1faudios~{line}".encode(), 0, 10 * n, None), (b"uid~1\x1faudios~[]\x1f\xff", 0, 10 * n + 1, None)]
        df = spark.createDataFrame(log, "value binary, partition int, offset long, timestamp timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        run_recall_stream(
            spark, file_log_stream(spark, f"{base}/in", 4), store, f"{base}/zset", f"{base}/ck",
            misses_path=f"{base}/misses", rejects_path=f"{base}/rejects", ttl_seconds=60,
        )
    table = ZsetTable(f"{base}/zset")
    assert rows(table.view(spark), "key", "member") == [("res:recom:fancy:u0", "1"), ("res:recom:fancy:u0", "2"), ("res:recom:fancy:u1", "9")]
    assert rows(BatchTable(f"{base}/misses").read(spark), "batch_id", "pos", "kind", "text") == [(1, 1, "name", "other"), (1, 1, "singer", "B")]
    assert rows(BatchTable(f"{base}/rejects").read(spark), "batch_id", "reason") == [(0, "bad_bytes"), (1, "bad_bytes")]
    from coldflow.sources.fixtures import ntz

    import datetime as dt

    assert table.view(spark, ntz(dt.datetime(2000, 1, 1))).count() == 3 and table.view(spark, ntz(dt.datetime(2200, 1, 1))).count() == 0


def test_messages_of_several_lines(spark):
    """A decode step makes three records of one message; a restart reads none of them twice."""
    from pyspark.sql import functions as F

    from coldflow.streaming.recall_stream import decode_lines

    base = scratch_path(spark, "decode")
    store = recall.build_store(spark.createDataFrame([("1", "a", "A", 1), ("2", "b", "B", 2)], "item_id string, name string, singer string, fire int"), f"{base}/index")
    song = lambda u, s: f'uid~{u}\x1faudios~[{{"d_songname":"{s}"}}]'
    message = "\n".join([song("u1", "a"), song("u2", "b"), "", song("u1", "b")])
    for n, value in enumerate((message, song("u2", "a"))):
        df = spark.createDataFrame([(value.encode(), 0, n, None)], "value binary, partition int, offset long, timestamp timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        for _ in range(2):  # the second run finds nothing new
            run_recall_stream(spark, file_log_stream(spark, f"{base}/in", 4), store, f"{base}/zset", f"{base}/ck", decode=decode_lines)
    table = ZsetTable(f"{base}/zset")
    assert rows(table.view(spark), "key", "member") == [("res:recom:fancy:u1", "2"), ("res:recom:fancy:u2", "1")]
    log = table.log(spark)
    assert rows(log.select(F.col("version.offset").alias("o"), F.col("version.part").alias("p")), "o", "p") == [(0, 1), (0, 2), (1, 0)]


def test_readers_take_finished_batches_only(spark):
    """T-3: a batch without its _SUCCESS mark is not seen; batches below a base are not read."""
    from coldflow.session import path_exists, remove_path

    table = ZsetTable(scratch_path(spark, "finished"))
    schema = "key string, member string, score double, version long"
    table.write_batch(spark.createDataFrame([("k", "a", 1.0, 1)], schema), 0)
    table.write_batch(spark.createDataFrame([("k", "b", 2.0, 2)], schema), 1)
    remove_path(spark, f"{table.batches}/batch_id=1/_SUCCESS")
    assert rows(table.view(spark)) == [("k", "a", 1.0)]
    table.write_batch(spark.createDataFrame([("k", "b", 2.0, 2)], schema), 1)
    table.compact(spark)
    remove_path(spark, f"{table.batches}/batch_id=0")  # retention
    table.write_batch(spark.createDataFrame([("j", "c", 3.0, 3)], schema), 2)
    assert not path_exists(spark, f"{table.batches}/batch_id=0")
    assert rows(table.view(spark)) == [("j", "c", 3.0), ("k", "b", 2.0)]
