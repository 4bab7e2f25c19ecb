"""Operators against brute-force Python on random small inputs, with tiny
chunks so every cross-chunk path runs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbflow.operators import joins as J
from ebbflow.operators import patterns as P
from ebbflow.operators.process import periodic_counts

T0 = datetime(2024, 1, 1)


def random_events(seed, n=300, users=4):
    rnd = random.Random(seed)
    out, t = [], T0
    for i in range(n):
        t += timedelta(minutes=rnd.choice([0, 1, 3, 7, 20, 45, 90]))
        # user 0 is hot: about half of all rows
        u = 0 if rnd.random() < 0.5 else rnd.randrange(1, users)
        out.append((i, u, rnd.choice(["view", "purchase", "signup", "error"]), t))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts timestamp_ntz")


@pytest.mark.parametrize("seed", [1, 2])
def test_periodic_counts_brute(spark, seed):
    data = random_events(seed)
    period = timedelta(hours=2)
    want = []
    for u in {d[1] for d in data}:
        ts = sorted(d[3] for d in data if d[1] == u)
        start = ts[0]
        while start is not None:
            timer = start + period
            want.append((u, timer, sum(1 for t in ts if t <= timer)))
            start = next((t for t in ts if t > timer), None)
    got = periodic_counts(frame(spark, data), "user_id", "ts", "2 hours", rows_per_chunk=17)
    assert rows(got, "user_id", "timer_ts", "cnt") == sorted(want)


@pytest.mark.parametrize("seed", [3, 4])
def test_followed_by_within_brute(spark, seed):
    data = random_events(seed)
    within = timedelta(hours=1)
    want = []
    for i, u, e, t in data:
        if e != "signup":
            continue
        later = [d for d in data if d[1] == u and d[2] == "purchase" and (d[3], d[0]) > (t, i)]
        nxt = min(later, key=lambda d: (d[3], d[0])) if later else None
        status = "matched" if nxt and nxt[3] - t < within else "timeout"
        want.append((i, status))
    pat = (P.Pattern.begin("create", F.col("event_type") == "signup")
           .followed_by("pay", F.col("event_type") == "purchase").within("1 hour"))
    got = P.followed_by_within(frame(spark, data), pat, "user_id", "ts", "event_id", ["event_id"],
                               rows_per_chunk=11)
    assert rows(got, "create_event_id", "status") == sorted(want)


@pytest.mark.parametrize("seed", [5])
def test_strict_chain_brute(spark, seed):
    data = random_events(seed)
    want = []
    for u in {d[1] for d in data}:
        seq = sorted((d for d in data if d[1] == u), key=lambda d: (d[3], d[0]))
        for a, b in zip(seq, seq[1:]):
            if a[2] == "view" and b[2] == "purchase":
                want.append((u, a[0], b[0]))
    pat = (P.Pattern.begin("v", F.col("event_type") == "view")
           .next("p", F.col("event_type") == "purchase"))
    got = P.strict_matches(frame(spark, data), pat, "user_id", ["ts", "event_id"], ["event_id"],
                           rows_per_chunk=13)
    assert rows(got, "user_id", "v_event_id", "p_event_id") == sorted(want)


@pytest.mark.parametrize("seed", [6])
def test_interval_join_brute(spark, seed):
    data = random_events(seed)
    lo, hi = timedelta(minutes=-30), timedelta(minutes=45)
    want = sorted((a[0], b[0]) for a in data for b in data
                  if a[1] == b[1] and a[2] == "view" and b[2] == "purchase"
                  and a[3] + lo <= b[3] <= a[3] + hi)
    df = frame(spark, data)
    left = df.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("l_id"),
                                                   F.col("ts").alias("l_ts"))
    right = df.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("r_id"),
                                                        F.col("ts").alias("r_ts"))
    got = J.interval_join(left, right, "user_id", "l_ts", "r_ts", -1_800_000,
                          2_700_000, bucket=600_000)
    assert rows(got, "l_id", "r_id") == want
