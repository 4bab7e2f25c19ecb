"""Streams on disordered input lose no row; results follow their tables; state expires."""

import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbflow.plans import state_queries as Q
from ebbflow.session import ensure_checkpoint_dir, work_dir
from ebbflow.streaming import processors as PR
from ebbflow.streaming import sources as SS

T0 = datetime(2024, 3, 1)


def echo():
    class EchoLogic(PR.Logic):  # made here, so that it travels to the workers by value
        """Every row, as it is folded."""

        schema = "n long"

        def start(self):
            return (0,)

        def fold(self, state, us, seq, v, emit):
            emit({"seq": seq, "us": us, "v": v, "a": state[0]})
            return (state[0] + 1,)

    return EchoLogic()


@pytest.fixture(scope="module")
def disordered(spark, tmp_path_factory):
    """300 events whose ids (arrival) are far out of order of their times."""
    folder = str(tmp_path_factory.mktemp("disordered"))
    data = [(i, i % 3, ["view", "error", "purchase"][i % 3 - 1], T0 + timedelta(minutes=(i * 131) % 997)) for i in range(300)]
    df = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts timestamp_ntz")
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    return folder, data


def by_arrival(spark, folder, name):
    return Q.replayed_events(spark, folder, name, order="event_id")


def test_ordered_fold_accounts_for_every_row(spark, disordered):
    folder, data = disordered
    out = Q.ordered(spark, folder, "echo", echo(), replay=by_arrival(spark, folder, "echo")).filter("key >= 0").collect()
    assert sorted(r["seq"] for r in out) == [d[0] for d in data]
    tags = Counter(r["tag"] for r in out)
    assert tags["late"] > 0 and tags["main"] > 0
    for key in range(3):  # what was folded was folded in order of time
        main = sorted((r["a"], r["us"], r["seq"]) for r in out if r["tag"] == "main" and r["key"] == key)
        assert [m[1:] for m in main] == sorted(m[1:] for m in main)


def test_wide_bound_makes_nothing_late(spark, disordered):
    folder, data = disordered
    out = Q.ordered(spark, folder, "echo-wide", echo(), bound="2 days",
                    replay=by_arrival(spark, folder, "echo-wide")).filter("key >= 0").collect()
    assert {r["tag"] for r in out} == {"main"} and len(out) == len(data)


def test_manual_window_counts_every_row_of_disordered_input(spark, disordered):
    folder, data = disordered
    out = Q.stream_manual_window(spark, folder, replay=by_arrival(spark, folder, "disordered-window"))
    assert out.filter("event_type <> ''").agg(F.sum("cnt")).first()[0] == len(data)
    want = Counter((d[3].replace(minute=0), d[2]) for d in data)
    assert {(r["window_start"], r["event_type"]): r["cnt"] for r in out.collect() if r["event_type"]} == want


def test_late_data_accounts_for_every_row(spark, disordered):
    folder, data = disordered
    out = Q.stream_late_data(spark, folder)
    per = dict(rows(out.groupBy("tag").agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"), F.count("*").alias("c")), "tag", "n"))
    many = dict(rows(out.groupBy("tag").count(), "tag", "count"))
    assert per["main"] + many.get("update", 0) + many.get("late", 0) == len(data)


@pytest.fixture(scope="module")
def unnamed(spark, tmp_path_factory):
    """Users null, -1 (the id of the flush row) and 5, with the same events."""
    folder = str(tmp_path_factory.mktemp("unnamed"))
    kinds = ["signup", "error", "error", "error", "purchase", "signup"]
    data = [(i * 3 + j, user, kind, T0 + timedelta(hours=5 * i, minutes=j))
            for i, kind in enumerate(kinds) for j, user in enumerate((None, -1, 5))]
    df = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts timestamp_ntz")
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    return folder, data


@pytest.mark.parametrize("stream, batch", [
    ("stream_state_machine", "state_machine"), ("stream_cep_times", "cep_times_consecutive"), ("stream_cep_followed_by", "cep_followed_by"),
    ("stream_cep_timeout", "cep_timeout"), ("stream_periodic_pv", "periodic_pv")])
def test_every_user_is_kept(spark, unnamed, stream, batch):
    from ebbflow.plans.catalog import REGISTRY
    folder, _ = unnamed
    got = REGISTRY[stream].build(spark, folder)
    want = REGISTRY[batch].build(spark, folder)
    if stream != "stream_cep_followed_by":
        assert {r["user_id"] for r in got.collect()} == {None, -1, 5}
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.select(*got.columns).collect())))


def test_late_data_keeps_every_user(spark, unnamed):
    folder, data = unnamed
    out = Q.stream_late_data(spark, folder).collect()
    for user in (None, -1, 5):
        assert sum(r["cnt"] if r["tag"] == "main" else 1 for r in out if r["user_id"] == user) == len(data) // 3


def test_a_second_call_reads_the_table_again(spark, tmp_path):
    def events(n):
        df = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 2).alias("user_id"), F.lit("view").alias("event_type"),
                                   F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("ts"))
        df.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        spark.catalog.clearCache()
        return Q.stream_manual_window(spark, str(tmp_path)).agg(F.sum("cnt")).first()[0]
    assert [events(40), events(7)] == [40, 7]


def test_state_expires_after_a_pause(spark, tmp_path):
    schema = "event_id long, user_id long, event_type string, ts timestamp_ntz"
    frames = [spark.createDataFrame([(i, 1, "view", T0)], schema) for i in range(4)]

    class Paused(SS.Replay):
        def feed(self, i):
            if i == 2:
                time.sleep(12)
            return super().feed(i)

    rep = Paused(spark, "ttl", frames[0].schema, frames)
    from ebbflow.streaming import runner as RUN
    table = Q._rows(rep, F.col("user_id"), F.col("event_type")).drop("ts")
    out = table.groupBy("key").transformWithState(PR.ArrivalProcessor(PR.CountLogic(), 8_000), PR.output_schema("long"),
                                                  "Append", "ProcessingTime")
    got = rows(RUN.replay_append([rep], out, "ttl", until_caught_up=True, restarts=True), "seq", "a")
    assert got[2:] == [(2, 1), (3, 2)]


def test_ranges_keep_every_row(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i * i) for i in range(200)], "k long, at long")
    for even in (True, False):
        frames = SS.arrival_ranges(df, "at", 3, even_rows=even)
        assert sorted(r["k"] for f in frames for r in f.collect()) == list(range(200))
        tops = [f.agg(F.max("at")).first()[0] for f in frames]
        assert [t for t in tops if t is not None] == sorted(t for t in tops if t is not None)
    assert SS.range_count(10) == SS.LEAST_RANGES and SS.range_count(10 * SS.ROWS_PER_RANGE + 1) == 11


class _NoFolder:
    """A session on a cluster whose checkpoint folder is not set."""

    class sparkContext:
        master = "spark://somewhere:1"

        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_NoFolder())


def test_work_dirs_are_apart(spark):
    assert work_dir(spark, "a") != work_dir(spark, "a")
