"""One running query over ranges, due-time buckets, several tables from one run,
starts from a retained checkpoint, connected streams."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ebbflow.plans import state_queries as Q
from ebbflow.session import work_dir
from ebbflow.streaming import connected as CO
from ebbflow.streaming import late as L
from ebbflow.streaming import processors as PR
from ebbflow.streaming import runner as RUN
from ebbflow.streaming import savepoint as SP
from ebbflow.streaming import sinks as SK
from ebbflow.streaming import sources as SS

T0 = datetime(2024, 3, 1)


def local(path):
    return path.removeprefix("file:")


def numbers(spark, n, ranges, **kw):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    return SS.Replay(spark, "numbers", df.schema, SS.arrival_ranges(df, "k", ranges, **kw))


# ------------------------------------------------------------ the source ---

@pytest.mark.parametrize("interval", [None, "1500 milliseconds"])
def test_one_query_takes_one_range_a_batch(spark, interval):
    rep = numbers(spark, 500, 5)
    RUN.feed_all([rep])
    out = work_dir(spark, "t-out")
    if interval:
        spark.conf.set(RUN.TRIGGER_CONF, interval)
    try:
        q = RUN.finish(rep.stream().writeStream.format("parquet").option("path", out)
                       .option("checkpointLocation", work_dir(spark, "t-ckpt")))
    finally:
        spark.conf.unset(RUN.TRIGGER_CONF)
    done = [p for p in q.recentProgress if p["numInputRows"]]
    assert len(done) == 5 and len({p["runId"] for p in q.recentProgress}) == 1
    assert rows(spark.read.parquet(out), "k", "v") == [(i, i % 7) for i in range(500)]
    if interval:  # the setting is what the triggers follow
        at = [datetime.fromisoformat(p["timestamp"].rstrip("Z")) for p in done]
        assert (at[-1] - at[0]).total_seconds() >= 3 * 1.45  # the first trigger need not be on the grid


def test_ranges_meet_the_watermark_of_the_range_before(spark):
    rep = numbers(spark, 60, 3)
    ev = PR.widened(rep.stream().select((F.timestamp_seconds(F.col("k") + 1000)).alias("ts"), "k"), "ts", 60_000_000)
    trace = ev.groupBy("k").transformWithState(L.WatermarkTraceProcessor("k", "k", 0, 60_000_000), "key long, seq long, wm_us long", "Append", "EventTime")
    got = {r["key"]: r["wm_us"] for r in RUN.replay_append([rep], trace, "t-trace").collect()}
    tops = [f.agg(F.max("k")).first()[0] for f in rep.frames]
    assert sorted(got) == list(range(60)) and len(tops) == 3
    before = [None, *(1_000_000 * (1000 + t) for t in tops)]
    assert got == {k: before[sum(k > t for t in tops)] for k in range(60)}


def test_every_range_has_its_files_even_when_empty(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "k long, v string")
    frames = SS.Ranges([df, df.limit(0), df.filter("k = 1")])
    frames.files = 3
    rep = SS.Replay(spark, "few", df.schema, frames)
    for _ in range(2):  # feeding a range again changes nothing
        assert RUN.feed_all([rep]) == 3
    for r in sorted(os.listdir(local(rep.path))):
        assert len([f for f in os.listdir(local(f"{rep.path}/{r}")) if f.startswith("part-")]) == 3
    got = RUN.replay_append([rep], rep.stream(), "few")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect() + df.filter("k = 1").collect()))


def test_a_restart_goes_on_with_the_next_range(spark):
    rep = numbers(spark, 90, 3)
    out = RUN.replay_append([rep], rep.stream(), "again", restarts=True)
    assert sorted(r["k"] for r in out.collect()) == list(range(90))


def test_the_number_of_ranges_is_the_query_s(spark, monkeypatch):
    monkeypatch.setattr(SS, "ROWS_PER_RANGE", 10)
    monkeypatch.setattr(SS, "ROWS_PER_FILE", 10)
    frames = SS.arrival_ranges(spark.range(200), "id", 4)
    assert len(frames) == 4 and frames.files == 5


# ------------------------------------------------------- due-time buckets ---

class FakeList:
    def __init__(self):
        self.rows, self.read = [], 0

    def exists(self):
        return bool(self.rows)

    def get(self):
        self.read += len(self.rows)
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


class FakeHandle:
    def __init__(self):
        self.lists, self.timers = {}, set()

    def getListState(self, name, schema):
        return self.lists.setdefault(name, FakeList())

    def registerTimer(self, ms):
        self.timers.add(ms)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def run_fake(proc, handle, batches, row):
    """Batches of times with the watermark each leaves; all that comes out."""
    proc.init(handle)
    out, wm = [], 0
    for times, after in batches:
        if times:
            out += proc.handleInputRows(("k",), (row(t) for t in times), Now(wm))
        wm = after
        for ms in sorted(t for t in handle.timers if t <= wm):
            handle.timers.discard(ms)
            out += proc.handleExpiredTimer(("k",), Now(wm), None)
    return out


def test_reads_grow_with_the_timers(spark):
    from types import SimpleNamespace
    for n in (200, 800):
        handle = FakeHandle()
        got = run_fake(PR.EventTimerProcessor(3_000_000, 0, 0), handle,
                       [([i * 1_000_000 for i in range(n)] * 2, n * 500), ([], n * 1000 + 10_000)], lambda t: SimpleNamespace(us=t))
        assert sorted(r["timer_us"] for r in got) == [i * 1_000_000 + 3_000_000 for i in range(n)]
        assert handle.lists["due"].read <= 4 * n and not handle.timers


def test_late_windows_wake_up_once_a_batch(spark):
    from types import SimpleNamespace

    class Rec(SimpleNamespace):
        def __getitem__(self, name):
            return getattr(self, name)

    n, handle = 300, FakeHandle()
    proc = L.LateWindowProcessor("us", "seq", "seq", 1_000_000, 0, 2_000_000, 0)
    got = run_fake(proc, handle, [([i * 1_000_000 + 1 for i in range(n)], n * 1000 // 2), ([5, (n - 1) * 1_000_000 + 2], n * 1000 + 5000)],
                   lambda t: Rec(us=t, seq=t))
    assert Counter(r["tag"] for r in got) == {"main": n, "late": 1}
    assert {r["start_us"]: r["cnt"] for r in got if r["tag"] == "main"} == {i * 1_000_000: 1 + (i == n - 1) for i in range(n)}
    assert handle.lists["windows"].read <= 5 * n and not handle.timers and not handle.lists["windows"].rows


def test_followed_by_takes_each_start_once():
    logic, out = PR.FollowedByLogic("s", "e", 10), []
    state = logic.start()
    for seq in range(500):
        state = logic.fold(state, seq // 100, seq, "s", out.append)
    state = logic.load(logic.dump(state))
    assert logic.wakes(state) == 10 and len(state) == 500
    state = logic.passed(state, 10, out.append)
    assert len(out) == 100 and {o["status"] for o in out} == {"timeout"}
    state = logic.fold(state, 12, 500, "e", out.append)
    assert Counter(o["status"] for o in out) == {"timeout": 300, "matched": 200} and logic.wakes(state) is None


# ------------------------------------------------- two tables of one run ---

def test_a_batch_that_fails_between_two_tables_is_repeated(spark):
    rep = numbers(spark, 300, 3)
    RUN.feed_all([rep])
    path, ckpt, failed = work_dir(spark, "t-fan"), work_dir(spark, "t-ckpt"), []

    def odd(df):
        if not failed and df.filter("k >= 150").count():
            failed.append(True)
            raise RuntimeError("lost between two tables")
        return df.filter("v % 2 = 1")

    sink = SK.FanOut(spark, path, {"even": lambda df: df.filter("v % 2 = 0"), "odd": odd})
    with pytest.raises(Exception, match="lost between"):
        RUN.run_batches(rep.stream(), "fan", sink, ckpt)
    torn = sink.committed()
    assert torn == [0] and os.path.isdir(local(f"{path}/even/batch=1"))
    seen = rows(sink.read("even", rep.schema), "k")
    assert seen and max(seen)[0] < 150  # what the torn batch left is not seen
    RUN.run_batches(rep.stream(), "fan", sink, ckpt)
    assert sink.committed() == [0, 1, 2]
    assert rows(sink.read("even", rep.schema), "k") == [(i,) for i in range(300) if i % 7 % 2 == 0]
    assert rows(sink.read("odd", rep.schema), "k") == [(i,) for i in range(300) if i % 7 % 2 == 1]


def test_tables_without_batches_are_empty(spark):
    sink = SK.FanOut(spark, work_dir(spark, "t-none"), {"a": lambda df: df})
    assert sink.read("a", spark.range(1).schema).count() == 0


# --------------------------------------------------- retained checkpoints ---

@pytest.fixture(scope="module")
def counted(spark):
    """A finished word count over four ranges, and the words."""
    words = [(i, f"w{(i * i) % 13}") for i in range(400)]
    df = spark.createDataFrame(words, "k long, word string")
    frames = SS.arrival_ranges(df, "k", 4)
    rep = SS.Replay(spark, "sp", df.schema, frames)
    RUN.feed_all([rep])
    ckpt = work_dir(spark, "sp-ckpt")
    counts = rep.stream().groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    RUN.run_batches(counts, "sp", lambda b, n: b.write.format("noop").mode("overwrite").save(), ckpt, "update")
    return df, frames, ckpt, words


def test_state_of_every_retained_batch(spark, counted):
    df, frames, ckpt, words = counted
    assert SP.retained(spark, ckpt)[:4] == [0, 1, 2, 3]
    tops = [f.agg(F.max("k")).first()[0] for f in frames]
    for batch, top in enumerate(tops):
        got = SP.state_at(spark, ckpt, batch).select("key.word", "value.count")
        assert dict(rows(got)) == Counter(w for k, w in words if k <= top)
    with pytest.raises(ValueError):
        SP.state_at(spark, ckpt, 77)


@pytest.mark.parametrize("batch, partitions", [(0, 3), (2, 7)])
def test_another_query_starts_from_an_older_batch(spark, counted, batch, partitions):
    df, frames, ckpt, words = counted
    start = SP.state_at(spark, ckpt, batch).select("key.word", F.col("value.count").alias("cnt"))
    rest = SS.Replay(spark, "sp-rest", df.schema, frames[batch + 1:])
    RUN.feed_all([rest])
    second = work_dir(spark, "sp-second")
    RUN.run_batches(SP.resume_counts(rest.stream().select("word"), start), "sp2",
                    lambda b, n: b.write.format("noop").mode("overwrite").save(), second, "update", partitions=partitions)
    got = SP.state_at(spark, second, variable="count").select("key.word", "value.cnt")
    assert dict(rows(got)) == Counter(w for _, w in words)


# ------------------------------------------------------ connected streams ---

@pytest.mark.parametrize("hot", [[], [1, None]])
def test_pairs_come_once_from_the_later_arrival(spark, hot):
    people = [(1, 10, 0), (1, 11, 2), (2, 20, 1), (None, 30, 0), (3, 40, 1)]
    orders = [(1, 100 + i, i % 3) for i in range(60)] + [(2, 200, 0), (2, 201, 1), (None, 300, 1), (4, 400, 2)]

    def replay(data, name):
        df = spark.createDataFrame(data, "key long, ref long, at long").withColumn("seq", F.col("ref"))
        return SS.Replay(spark, name, df.schema, [df.filter(F.col("at") == i) for i in range(3)])

    one, two = replay(people, "p"), replay(orders, "o")
    narrow = lambda r: r.stream().select("key", "seq", "ref")
    got = RUN.replay_append([one, two], CO.connect(narrow(one), narrow(two), hot=hot, salts=5), "pairs")
    want = [(k, "stream-2", o, p) if b >= a else (k, "stream-1", p, o)
            for k, p, a in people for k2, o, b in orders if k is not None and k == k2]
    assert rows(got, "key", "emitted_by", "arriving", "stored") == sorted(want)


def test_hot_keys_are_few_and_found(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(k,) for k in range(2, 60)] + [(None,)] * 40, "k long")
    assert set(CO.hot_keys(df, "k", least=20, share=5)) == {1, None}
    assert CO.hot_keys(df, "k") == []


def test_two_inputs_with_every_busy_customer_salted(spark):
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    busy = [r[0] for r in con.sql("SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12").fetchall()]
    from ebbflow.plans.catalog import REGISTRY
    got = Q.stream_two_inputs(spark, SF_SMALL, hot=busy, salts=4)
    assert busy and rows(got, "cust_key", "order_key", "emitted_by") == sorted(con.sql(REGISTRY["stream_two_inputs"].oracle).fetchall())


@pytest.mark.parametrize("ranges", [3, 8])
def test_every_rule_is_met_whatever_the_ranges(spark, tmp_path, ranges):
    kinds = ["view", "error", "purchase", "signup", "click"]
    rng = random.Random(8)
    data = [(i, [None, -1, 0, 5][i % 4], rng.choice([*kinds, "purchase", None]), T0 + timedelta(minutes=i)) for i in range(800)]
    df = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts timestamp_ntz")
    df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.sql(Q.rules_oracle(ranges)).fetchall()
    got = Q.stream_broadcast_rules(spark, str(tmp_path), ranges=ranges)
    mine = [(r["user_id"], r["event_id"], r["prev_action"], r["event_type"]) for r in got.collect()]
    assert sorted(mine, key=str) == sorted(want, key=str)
    assert {m[0] for m in mine} == {None, -1, 0, 5}
    assert len({m[2] for m in mine}) == (5 if ranges == 8 else 3)
