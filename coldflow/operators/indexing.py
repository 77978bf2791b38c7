"""Dense 0-based numbering of rows in a global (or per-group) order.

A ``row_number()`` window without PARTITION BY pulls every row into one task.
Here rows are range-partitioned on the order key, each Spark partition is
sorted locally and numbered by ``monotonically_increasing_id`` (whose upper
bits are the partition id), and only one count per (Spark partition, group)
is brought to the driver to turn local positions into global ones.  The
numbered frame is checkpointed into the shared checkpoint folder first, so
the sampling of the range partitioner and the ids cannot change between the
counting job and later use, and executor loss recomputes nothing.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldflow.session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def dense_index(
    df: DataFrame,
    order_cols: list[str],
    group_cols: list[str] | None = None,
    out: str = "idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of the row in ``order_cols`` order within its group.

    ``order_cols`` must be unique within a group.  The number of groups is
    expected to be small (a handful of source partitions, or one): the driver
    receives one count per (Spark partition, group).
    """
    spark = df.sparkSession
    group_cols = list(group_cols or [])
    keys = group_cols + list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    ranged = (
        df.repartitionByRange(n, *[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .withColumn("_mono", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    stats = (
        ranged.groupBy(F.shiftright("_mono", 33).alias("_pid"), *group_cols)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
        .collect()
    )
    # Prefix offsets per group, partitions in id order (range order).
    by_group = defaultdict(list)
    for r in stats:
        by_group[tuple(r[g] for g in group_cols)].append((r["_pid"], r["_n"], r["_first"]))
    base = {}
    for g, parts in by_group.items():
        acc = 0
        for pid, cnt, first in sorted(parts):
            base[(pid,) + g] = acc - (first & _LOW_BITS)
            acc += cnt
    if not base:
        return ranged.withColumn(out, F.lit(None).cast("bigint")).drop("_mono")
    # One entry per (partition, group): a tiny literal table, broadcast by size.
    schema_fields = ["_pid bigint"] + [f"`{g}` {ranged.schema[g].dataType.simpleString()}" for g in group_cols] + ["_base bigint"]
    lut = spark.createDataFrame([k + (v,) for k, v in base.items()], ", ".join(schema_fields))
    joined = ranged.withColumn("_pid", F.shiftright("_mono", 33)).join(F.broadcast(lut), ["_pid"] + group_cols)
    return joined.withColumn(out, (F.col("_mono").bitwiseAND(F.lit(_LOW_BITS)) + F.col("_base")).cast("bigint")).drop(
        "_mono", "_pid", "_base"
    )
