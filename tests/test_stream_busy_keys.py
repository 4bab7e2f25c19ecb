"""Busy keys folded by buckets of time equal the plain fold."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE, StateMachine
from ebbflow.plans import state_queries as Q
from ebbflow.streaming import chunked as CK
from ebbflow.streaming import processors as PR

T0 = datetime(2024, 3, 1)
#: Two errors without a purchase between them, then any number of others, then an error.
TWO_ERRORS = StateMachine("calm", {("calm", "error"): "once", ("once", "error"): "twice", ("once", "view"): "once", ("twice", "error"): "alert",
                                   ("twice", "view"): "twice", ("twice", "signup"): "twice"}, emit=frozenset({"alert"}))
LOGICS = {
    "machine": PR.MachineLogic(LOGIN_FAILURE_MACHINE),
    "strict": PR.StrictLogic(["fail", "fail", "success"]),
    "two": PR.MachineLogic(TWO_ERRORS),
    "single": PR.StrictLogic(["fail"]),
    "followed": PR.FollowedByLogic("fail", "success", 40),
}


@pytest.mark.parametrize("name", LOGICS)
def test_composed_chunks_equal_the_fold(name):
    logic, rng = LOGICS[name], random.Random(11)
    chunk = CK.CHUNKS[type(logic)](logic)
    for _ in range(200):
        at, rows = 0, []
        for seq in range(rng.randrange(60)):
            at += rng.choice([0, 1, 5, 30])
            rows.append((at, seq, rng.choice(["fail", "fail", "success", "other", "error", "error", "view", None])))
        want: list = []
        state = logic.start()
        for r in rows:
            state = logic.fold(state, *r, want.append)
        got: list = []
        whole, lo = logic.start(), 0
        while lo < len(rows):
            hi = lo + rng.randint(1, 9)
            held = json.loads(json.dumps(chunk.summary(rows[lo:hi], got.append)))
            whole, lo = chunk.combine(logic.load(logic.dump(whole)), held, got.append), hi
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert logic.wakes(whole) == logic.wakes(state)


@pytest.fixture(scope="module")
def busy(spark, tmp_path_factory):
    """Users 1 and null hold most of 900 events."""
    folder, rng, at = str(tmp_path_factory.mktemp("busy")), random.Random(9), T0
    data = []
    for i in range(900):
        at += timedelta(minutes=rng.choice([0, 1, 20, 300]))
        data.append((i, rng.choice([1, 1, 1, None, None, 2, 3]), rng.choice(["error", "error", "purchase", "signup", "view"]), at))
    spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts timestamp_ntz").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("logic", [PR.StrictLogic(["error", "error", "purchase"]), PR.FollowedByLogic("signup", "purchase", 12 * 3_600_000_000),
                                   PR.MachineLogic(TWO_ERRORS)], ids=["strict", "followed", "machine"])
def test_hot_keys_give_the_same_rows(spark, busy, logic):
    def run(hot):
        out = Q._main(Q.ordered(spark, busy, "busy", logic, hot=hot)).collect()
        return Counter(tuple(r) for r in out)
    plain = run([])
    assert plain and {r[1] for r in plain} >= {1, None}
    assert run([1, None]) == plain
    assert run([1]) == plain


def test_rows_of_a_passed_bucket_are_late(spark, busy):
    rep = Q.replayed_events(spark, busy, "disordered", order="event_id")
    rep.frames = [rep.frames[1], rep.frames[0], *rep.frames[2:]]  # a range of older rows comes second
    out = Q.ordered(spark, busy, "busy-late", PR.StrictLogic(["view"]), replay=rep, hot=[1]).collect()
    tags = Counter((r["tag"], r["key"]) for r in out)
    assert tags["late", 1] > 0 and tags["main", 1] > 0
