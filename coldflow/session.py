"""Session helpers.

Nothing here overrides settings a cluster already provides: the checkpoint
directory is read from ``spark.checkpoint.dir`` and only set when missing
(local tests).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings that matter at scale; each is only applied when the session does
# not already carry a value (a cluster's spark-defaults win).
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only what is small after filtering; AQE re-plans at runtime.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "coldflow") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # Per-row parsing is CPU-bound relative to its bytes: let AQE coalesce
        # small shuffle outputs into partitions of >= 256 KB rather than 1 MB,
        # so a few MB of log lines still spread over every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for k, v in SCALE_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Reads ``spark.checkpoint.dir``; only when it is unset (local tests) a
    fresh scratch folder is created and registered; a master that is not local
    without that setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - sessions without a SparkContext handle (Spark Connect)
            current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="coldflow-ckpt-", dir=os.environ.get("COLDFLOW_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if (work := _work.get()) is not None:
        work.append(path)
    return path


_work: ContextVar[list[str] | None] = ContextVar("work tables", default=None)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end; results must have been written to a path taken before."""
    token = _work.set([])
    try:
        yield
    finally:
        paths = _work.get()
        _work.reset(token)
        for path in paths:
            remove_path(spark, path)


def stage_table(df, name: str):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Used at stage boundaries of multi-branch jobs: the branches read the
    written table instead of recomputing its lineage, and a lost executor
    costs a re-read, not a re-run of everything before the boundary.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, in whatever store Spark reads it from?"""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def files_version(df) -> str:
    """Names, sizes and times of the files behind ``df``: changes when one of them does."""
    import hashlib

    found = []
    for name in sorted(df.inputFiles()):
        fs, p = _file_system(df.sparkSession, name)
        st = fs.getFileStatus(p)
        found.append(f"{name}|{st.getLen()}|{st.getModificationTime()}")
    return hashlib.md5("\n".join(found).encode()).hexdigest()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own (work tables of a finished batch)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def spread(df):
    """Spread rows over the cluster's cores when the input has fewer splits than cores.

    CPU-heavy per-row work (tokenizing whole texts) directly on a scan runs
    one task per input split; a table stored as one row group would use one
    core.  The split count is known at planning time, so this only adds a
    round-robin shuffle when the input is that coarse - a large input with
    many splits is left alone.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave the plan alone
        return df
    return df.repartition(target) if splits < target else df
