"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from coldflow.plans import oracle, registry
from coldflow.sources.tables import TABLE_NAMES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.mark.parametrize("key", sorted(oracle.all_queries()))
def test_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF_SMALL)
    res = con.sql(se.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.all_queries())
    assert set(registry.queries()) <= set(se.queries()) and set(oracle.all_queries()) <= set(se.oracle_sql())
