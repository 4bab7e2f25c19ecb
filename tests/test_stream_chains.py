"""Operators that feed one another, state that is read after it expired, printed lines."""

import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbflow.plans import state_queries as Q
from ebbflow.plans.catalog import REGISTRY
from ebbflow.sinks.console import lines, printed
from ebbflow.streaming import chained as CH
from ebbflow.streaming import runner as RUN
from ebbflow.streaming import sources as SS

T0 = datetime(2024, 3, 1)
SCHEMA = "event_id long, user_id long, event_type string, ts timestamp_ntz"


def events(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    return con


@pytest.fixture(scope="module")
def busy(spark, tmp_path_factory):
    """600 events, a third of them of one user; users null and -1 among them."""
    folder, rng, at = str(tmp_path_factory.mktemp("busy")), random.Random(4), T0
    data = []
    for i in range(600):
        at += timedelta(minutes=rng.choice([1, 5, 40, 400]))
        data.append((i, rng.choice([1, 1, 1, 1, 2, 3, 4, None, -1, 0]), rng.choice(["view", "signup", "purchase"]), at))
    return folder, data, events(spark, folder, data)


def test_leader_equals_a_plain_loop(spark, busy):
    folder, data, _ = busy
    counts, best, want = Counter(), (0, None), []
    for i, user, *_ in data:
        counts[user] += 1
        if counts[user] >= best[0]:
            best = (counts[user], user)
        want.append((i, best[1], best[0]))
    got = Q.stream_most_active_user(spark, folder).collect()
    assert sorted((r["event_id"], r["leader_user_id"], r["leader_cnt"]) for r in got) == want


def test_only_rows_that_lead_a_bucket_meet(spark):
    data = [(i, i % 50) for i in range(1000)] + [(1000 + i, 7) for i in range(500)]
    df = spark.createDataFrame(data, "seq long, id long")
    rep = SS.Replay(spark, "leaders", df.schema, SS.arrival_ranges(df, "seq", 3))
    got = RUN.replay_append([rep], CH.leader_changes(rep.stream(), 8), "leaders")
    counts, best, want = Counter(), 0, []
    for seq, user in data:
        counts[user] += 1
        if counts[user] >= best:
            best = counts[user]
            want.append((seq, user, best))
    assert rows(got, "seq", "id", "cnt") == want


@pytest.mark.parametrize("stream", ["stream_window_sequence", "stream_cep_outputs"])
def test_equals_sql_with_odd_users(spark, busy, stream):
    folder, _, con = busy
    want = con.sql(REGISTRY[stream].oracle)
    got = REGISTRY[stream].build(spark, folder).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("ranges, hours", [(6, 3), (20, 12), (1, 1)])
def test_expired_values_are_read_until_cleaned(spark, busy, ranges, hours):
    folder, data, con = busy
    # SQL joins batches on equal users; null users are checked by the loop below
    got = Q.stream_ttl_visible(spark, folder, ranges, hours)
    mine = sorted((r["event_id"], r["user_id"], r["found"], r["cnt"]) for r in got.collect())
    want = con.sql(f"SELECT event_id, user_id, found, cnt FROM ({Q.ttl_oracle(ranges, hours)}) ORDER BY 1").fetchall()
    assert mine == want
    # the same by a loop over batches
    lo, hi = data[0][3], data[-1][3]
    us = lambda t: round((t - datetime(1970, 1, 1)).total_seconds() * 1e6)
    number = lambda t: (us(t) - us(lo)) * ranges // (us(hi) - us(lo) + 1)
    state, out, wm = {}, [], None
    for no in range(ranges):
        part = [d for d in data if number(d[3]) == no]
        for i, user, _, t in part:
            n, last = state.get(user, (0, None))
            found = "first" if last is None else "stale" if t - last > timedelta(hours=hours) else "live"
            state[user] = (n + 1, t)
            out.append((i, user, found, n + 1))
        if wm is not None:
            state = {u: s for u, s in state.items() if s[1] + timedelta(hours=hours) > wm}
        if part:
            wm = part[-1][3]
    assert mine == out
    if ranges == 20:
        assert {m[2] for m in mine} == {"first", "stale", "live"}


def test_printed_lines(spark):
    df = spark.createDataFrame([(1, "a\nb"), (None, None), (3, "c\\d"), (4, "e")], "k long, v string")
    assert [r[0] for r in lines(df, "1").orderBy("k").collect()] == [
        "1> (null, null)", "1> (1, a\\nb)", "1> (3, c\\\\d)", "1> (4, e)"]
    rep = SS.Replay(spark, "printed", df.schema, SS.Ranges([df.filter("k = 1"), df.filter("k is null or k > 1")]))
    got = printed([rep], rep.stream(), "printed", {"all": lambda d: d, "odd": lambda d: d.filter("k % 2 = 1").select("k")})
    assert rows(got) == [("all", "all> (1, a\\nb)"), ("all", "all> (3, c\\\\d)"), ("all", "all> (4, e)"), ("all", "all> (null, null)"),
                         ("odd", "odd> (1)"), ("odd", "odd> (3)")]


def test_empty_inputs(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_most_active_user", "stream_window_sequence", "stream_ttl_visible", "stream_print", "stream_broadcast_rules",
                 "stream_cep_outputs", "stream_event_timers", "stream_manual_window", "stream_late_data"):
        assert REGISTRY[name].build(spark, str(tmp_path)).count() == 0, name
