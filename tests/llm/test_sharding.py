from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from .test_llm_queries import compare

from ebbflow.llm import sharding as S
from ebbflow.llm.common import configure, table
from ebbflow.session import work_dir


def check(df, limit):
    got = S.assign(df, limit).collect()
    assert len(got) == df.count()
    sums, rows = defaultdict(int), defaultdict(int)
    for r in got:
        sums[r["shard"]] += r["n_bytes"]
        rows[r["shard"]] += 1
    for r in got:
        assert r["depth"] == len(r["shard"]) and r["shard_bytes"] == sums[r["shard"]]
        assert r["oversize"] == (r["shard_bytes"] > limit)
        assert not r["oversize"] or rows[r["shard"]] == 1
    names = sorted(sums)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # split only because the parent was too large
        if name:
            assert sum(v for k, v in sums.items() if k.startswith(name[:-1])) > limit
    return got


@pytest.mark.parametrize("limit", [1, 20, 5_000, 10**9])
def test_awkward_rows(spark, awkward, nothing, limit):
    configure(spark)
    check(awkward, limit)
    assert S.assign(nothing, limit).count() == 0


def test_a_key_of_a_third_of_the_rows(spark):
    configure(spark)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("word " * 10).alias("text"))
    assert len({r["shard"] for r in check(df, 2_000)}) > 60


def test_written_shards(spark, awkward):
    configure(spark)
    path = work_dir(spark, "shards") + "/out"
    S.write(awkward, 100, path)
    back = spark.read.parquet(path).drop("shard")
    assert sorted(back.select(*awkward.columns).collect(), key=str) == sorted(awkward.collect(), key=str)


def test_query(spark):
    compare(spark, "op7_sharding", "/root/testdata/sf0.01")
    configure(spark)
    check(table(spark, "/root/testdata/sf0.01", "documents"), 50_000)
