"""Joins and partitioners on small tables drawn by a rule, against plain Python."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbflow.functions.time import from_epoch_seconds
from ebbflow.operators import joins as J
from ebbflow.operators import partitioning as K


def test_connect_join_pairs(spark):
    """Depots and parcels: the later of each pair emits it, ties go to the right side."""
    depots = [(k, 10 * k) for k in range(1, 5)]
    parcels = [(k, t) for k in range(2, 7) for t in (10 * k - 3, 10 * k, 10 * k + 4)]
    left = spark.createDataFrame(depots, "depot long, open_at long")
    right = spark.createDataFrame(parcels, "to_depot long, sent_at long")
    want = sorted((k, "right" if t >= o else "left", max(t, o), min(t, o)) for k, o in depots for p, t in parcels if p == k)
    out = J.connect_join(left, right, "depot", "to_depot", "open_at", "sent_at", tag_l="left", tag_r="right")
    assert rows(out, "key", "emitted_by", "arriving_ts", "stored_ts") == want


MOVES = ["up", "down", None, "left", "up", "up", "down", "left", None, "up", "left", "down"]


def moves(spark):
    """Two robots take the moves in turn, shifted against each other."""
    data = [(n, f"bot{n % 2}", MOVES[(n * 5) % 12]) for n in range(36)]
    return data, spark.createDataFrame(data, "seq long, bot string, move string")


def follows(data, rules):
    before, out = {}, []
    for seq, bot, move in data:
        if (before.get(bot), move) in rules:
            out.append((bot, seq, before[bot], move))
        before[bot] = move
    return sorted(out)


@pytest.mark.parametrize("rules", [[("up", "up")], [("up", "down"), ("left", "up"), ("down", "left")], []])
def test_broadcast_rules(spark, rules):
    data, df = moves(spark)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "seq long, action1 string, action2 string")
    assert rows(J.broadcast_rules(df, table, "bot", "move", "seq")) == follows(data, rules)
    latest = J.broadcast_rules(df, J.latest_rule(table, "seq"), "bot", "move", "seq")
    assert rows(latest) == follows(data, rules[-1:])


@pytest.mark.parametrize("lower,upper,bucket", [(-5000, 5000, None), (-7000, 9000, 3000), (2000, 6000, 1000)])
def test_interval_join_bounds_are_inclusive(spark, lower, upper, bucket):
    lamps = [(k, 60 + 17 * i) for k in "ab" for i in range(4)]
    ticks = [(k, s) for k in "abc" for s in range(50, 130, 3)]
    left = spark.createDataFrame(lamps, "id string, lsec long").select("id", "lsec", from_epoch_seconds("lsec").alias("lts"))
    right = spark.createDataFrame(ticks, "id string, rsec long").select("id", "rsec", from_epoch_seconds("rsec").alias("rts"))
    out = J.interval_join(left, right, "id", "lts", "rts", lower, upper, bucket=bucket)
    want = sorted((k, a, b) for k, a in lamps for q, b in ticks if q == k and lower <= 1000 * (b - a) <= upper)
    assert rows(out, "id", "lsec", "rsec") == want and want


def test_custom_partitioner(spark):
    df = spark.createDataFrame([(i,) for i in range(3, 24)], "v long")
    out = K.custom(df, 3, (F.col("v") % 3).cast("int")).select("v", F.spark_partition_id().alias("p"))
    assert all(r["v"] % 3 == r["p"] for r in out.collect()) and out.count() == 21


def test_broadcast_mode_replicates(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "v long")
    out = K.broadcast_all(df, 3).select("v", F.spark_partition_id().alias("p"))
    assert rows(out.groupBy("p").count(), "p", "count") == [(0, 10), (1, 10), (2, 10)]


def test_partition_report_counts(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(50)], "k long, c long")
    got = dict(rows(K.partition_report(df, "k", "c", 3), "mode", "rows"))
    assert got == {"shuffle": 50, "rebalance": 50, "rescale": 50, "custom": 50, "broadcast": 4, "global": 4}
