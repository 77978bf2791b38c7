"""Readers for the input tables.

Every table is read lazily from parquet; callers select only the columns they
use so that the scan's ReadSchema stays narrow and filters reach the reader.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy accessor: ``Tables(spark, "/data/sf1").orders`` -> DataFrame."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            df = self.read(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def part_count(self) -> int:
        """Number of catalogue rows (parquet footers answer this without a scan)."""
        return self.read("part").count()
