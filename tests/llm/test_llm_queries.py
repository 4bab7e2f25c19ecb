"""Every llm query that SQL can express, against DuckDB on the small tables."""

import math

import duckdb
import pytest
from .conftest import SF_SMALL

from ebbflow.llm.queries import ORACLES, QUERIES

TABLES = ["documents", "embeddings", "labels"]


def norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


def compare(spark, name, folder=SF_SMALL):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    at = [want.columns.index(c) for c in cols]
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    b = sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    compare(spark, name)


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
