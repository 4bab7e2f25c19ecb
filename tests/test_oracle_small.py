"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
check, on the smallest tables)."""

import math
from datetime import datetime

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from ebbflow.plans import registry
from ebbflow.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_oracle(spark, con, name):
    df = registry()[name].build(spark, SF_SMALL)
    got = df.collect()
    res = con.sql(registry()[name].oracle)
    assert sorted(df.columns) == sorted(res.columns)
    cols = sorted(df.columns)
    idx = [res.columns.index(c) for c in cols]
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in got), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["window_start", "window_end", "event_type", "cnt", "rank"]


def test_every_query_has_an_oracle():
    assert [n for n, q in registry().items() if not q.oracle] == []
    assert set(registry()) <= set(E.queries()) and set(registry()) <= set(E.oracle_sql())


CHUNKED = ["most_active_user", "running_count", "running_keyed_max", "count_window_avg",
           "window_sequence", "watermark_trace", "late_main", "late_side", "broadcast_rules",
           "cep_times_consecutive", "state_machine", "cep_followed_by", "buffered_sink",
           "periodic_pv"]


@pytest.mark.parametrize("name", CHUNKED)
def test_query_equals_oracle_with_small_chunks(spark, con, name):
    """The same queries with ~100-row chunks: every running value crosses chunks."""
    from ebbflow.operators.running import ROWS_PER_CHUNK_CONF
    spark.conf.set(ROWS_PER_CHUNK_CONF, "97")
    try:
        test_query_equals_oracle(spark, con, name)
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)
