"""Python workers: making this package importable there, and the tables they keep between tasks."""

from __future__ import annotations

import ctypes
import gc
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import coldflow
from coldflow.llm.text import forget_powers


def importable(spark: SparkSession) -> None:
    """Add the folder that holds the package to the workers' PYTHONPATH.

    A cluster gets the package by installation or ``--py-files``; this covers
    sessions whose driver found it through ``sys.path`` alone.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(coldflow.__file__)))
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, path) if p)


def extended(df: DataFrame, **types: str) -> T.StructType:
    """The schema of ``df`` with further columns, for mapInArrow."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in types.items())])


_caches: dict[str, dict] = {}


def cache(owner: str) -> dict:
    """What this worker keeps of an operator between tasks; what it kept of other operators goes first.

    Workers live through all queries and stages of a session, which would
    otherwise add up the tables of every operator that ran in them.
    """
    others = [k for k in _caches if k != owner]
    for k in others:
        _caches.pop(k).clear()
    if others:
        forget_powers()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)  # small freed blocks too go back to the system
        except (OSError, AttributeError):  # a C library without it
            pass
    return _caches.setdefault(owner, {})
