"""The chunked running aggregate equals the one-task window form, for any
chunk size (many chunks per key, chunks with no rows of a key, keyless)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ebbflow.operators import running as R
from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE, run_state_machine
from ebbflow.operators import patterns as P


@pytest.fixture(scope="module")
def ev(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "v", F.when(F.col("event_type") == "purchase", F.col("value")))


@pytest.mark.parametrize("rpc", [7, 50, 400, 10**9])
@pytest.mark.parametrize("desc", [False, True])
def test_keyed_matches_window(spark, ev, rpc, desc):
    aggs = {"n": R.count(), "n_before": R.count(exclusive=True), "s": R.rsum("event_id"),
            "mx": R.rmax("value"), "mn": R.rmin("value", exclusive=True),
            "fst": R.first("event_type"), "prev": R.last("event_type", exclusive=True),
            "lastv": R.last("v")}
    got = R.running(ev, ["user_id"], ["ts", "event_id"], aggs, descending=desc,
                    rows_per_chunk=rpc)
    o = [F.col("ts").desc(), F.col("event_id").desc()] if desc else ["ts", "event_id"]
    w = Window.partitionBy("user_id").orderBy(*o)
    inc = w.rowsBetween(Window.unboundedPreceding, 0)
    exc = w.rowsBetween(Window.unboundedPreceding, -1)
    want = ev.select(
        "*", F.count(F.lit(1)).over(inc).alias("n"),
        F.coalesce(F.count(F.lit(1)).over(exc), F.lit(0)).alias("n_before"),
        F.sum("event_id").over(inc).alias("s"), F.max("value").over(inc).alias("mx"),
        F.min("value").over(exc).alias("mn"), F.first("event_type").over(inc).alias("fst"),
        F.last("event_type", True).over(exc).alias("prev"), F.last("v", True).over(inc).alias("lastv"))
    cols = ["event_id", *aggs]
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("rpc", [13, 10**9])
def test_global_matches_window(spark, ev, rpc):
    got = R.running(ev, [], ["event_id"], {"mx": R.rmax("ts", exclusive=True),
                                          "n": R.count()}, rows_per_chunk=rpc)
    w = Window.orderBy("event_id")
    want = ev.select("event_id", F.max("ts").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"),
                     F.row_number().over(w).cast("long").alias("n"))
    assert rows(got, "event_id", "mx", "n") == rows(want, "event_id", "mx", "n")


@pytest.mark.parametrize("rpc", [5, 60, 10**9])
def test_state_machine_chunks_equal_strict_pattern(spark, ev, rpc):
    df = ev.withColumn("event", F.when(F.col("event_type") == "error", "fail")
                       .when(F.col("event_type") == "purchase", "success")
                       .otherwise(F.col("event_type")))
    sm = run_state_machine(df, LOGIN_FAILURE_MACHINE, "user_id", ["ts", "event_id"], "event",
                           ["event_id"], rows_per_chunk=rpc)
    pat = P.Pattern.begin("f", F.col("event") == "fail").times(3)
    strict = P.strict_matches(df, pat, "user_id", ["ts", "event_id"], ["event_id"],
                              rows_per_chunk=rpc)
    assert rows(sm, "user_id", "event_id") == rows(strict, "user_id", "f3_event_id")
    assert sm.count() > 0


def test_chunks_stay_balanced_with_outlier(spark):
    """Equal-width chunks would put every row but one in chunk 0 here."""
    data = [(i, i) for i in range(2000)] + [(2000, 10**12)]
    df = spark.createDataFrame(data, "seq long, t long")
    cut, split = R.chunked(df, [], F.col("t"), 200, "c")
    sizes = [r["count"] for r in cut.groupBy("c").count().collect()]
    assert split and len(sizes) >= 8 and max(sizes) <= 400
    got = R.running(df, [], ["t"], {"n": R.count()}, rows_per_chunk=200)
    assert rows(got, "seq", "n") == [(i, i + 1) for i in range(2001)]


def test_more_cuts_than_one_group_holds(spark):
    df = spark.range(1000).select(F.col("id").alias("t"))
    cut, _ = R.chunked(df, [], F.col("t"), 5, "c")
    by = rows(cut, "t", "c")
    assert [c for _, c in by] == sorted(c for _, c in by) and len({c for _, c in by}) >= 150


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("rpc", [2, 3, 9, 40, 10**9])
def test_nulls_ties_and_a_hot_key_equal_the_plain_window(spark, rpc, desc):
    """Null values first in a key, null keys, null order values, one hot key."""
    data = [(i, None if i % 11 == 3 else "hot" if i % 3 else f"k{i % 5}", None if i % 13 == 5 else i // 2,
             None if i % 4 == 0 else i * 7 % 31) for i in range(160)]
    df = spark.createDataFrame(data, "seq long, k string, t long, v long")
    aggs = {"fst": R.first("v"), "lst": R.last("v", exclusive=True), "prev": R.lag("v"), "s": R.rsum("v"),
            "mx": R.rmax("v"), "n": R.count()}
    got = R.running(df, ["k"], ["t", "seq"], aggs, descending=desc, rows_per_chunk=rpc)
    o = [F.col("t").desc(), F.col("seq").desc()] if desc else ["t", "seq"]
    w = Window.partitionBy("k").orderBy(*o)
    inc, exc = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.first("v").over(inc).alias("fst"), F.last("v", True).over(exc).alias("lst"), F.lag("v").over(w).alias("prev"),
                     F.sum("v").over(inc).alias("s"), F.max("v").over(inc).alias("mx"), F.count(F.lit(1)).over(inc).alias("n"))
    key = lambda r: r[0]
    cols = ["seq", *aggs]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == \
        sorted((tuple(r[c] for c in cols) for r in want.collect()), key=key)


def test_one_exchange_of_the_rows(spark):
    """A split plan shuffles the rows once; no array of quantiles reaches the driver's plan beyond the cuts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(500).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("k"), F.lit("payload").alias("wide"))
        out = R.running(df, ["k"], ["seq"], {"n": R.count()}, rows_per_chunk=50)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the rows, the chunk totals (partial sums), and the prefixes by key and to the join
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_rc_key" in line and "_rc_chunk" in line for line in exchanges) <= 2
    assert "wide" in plan


@pytest.mark.parametrize("desc", [False, True])
def test_rows_of_equal_order_values_are_split_too(spark, desc):
    """A third of a hot key's rows share one time, another third have none."""
    data = [(1, i, None if i % 3 == 0 else 5_000 if i % 3 == 1 else i, i % 17) for i in range(1500)]
    data += [(2, 5000 + i, 5_000, i) for i in range(40)] + [(None, 6000 + i, None, i) for i in range(300)]
    df = spark.createDataFrame(data, "k long, id long, at long, v long")
    aggs = {"n": R.count(), "s": R.rsum("v"), "mx": R.rmax("v"), "prev": R.lag("v"), "fst": R.first("id"), "lst": R.last("v", exclusive=True)}
    split = R.running(df, ["k"], ["at", "id"], aggs, descending=desc, rows_per_chunk=60)
    whole = R.running(df, ["k"], ["at", "id"], aggs, descending=desc, rows_per_chunk=10**9)
    assert rows(split.fillna(-1), "id", *aggs) == rows(whole.fillna(-1), "id", *aggs)
    cut, found = R.chunked(df, ["k"], F.col("at"), 60, tie=F.col("id"))
    assert found and cut.filter("_rc_hot").groupBy("k", "_rc_chunk").count().agg(F.max("count")).first()[0] <= 180
    assert cut.count() == df.count()


def test_state_machine_splits_rows_of_equal_times(spark):
    data = [(1, i, 7 if i % 4 else None, ["fail", "fail", "success", "other"][i * 7 % 11 % 4]) for i in range(600)]
    df = spark.createDataFrame(data, "user_id long, id long, at long, event string")
    run = lambda rpc: rows(run_state_machine(df, LOGIN_FAILURE_MACHINE, "user_id", ["at", "id"], "event", ["id"], rows_per_chunk=rpc))
    assert run(25) == run(10**9) != []
