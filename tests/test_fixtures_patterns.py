"""Patterns, timeouts and state machines on drawn event strings, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbflow.functions.time import from_epoch_ms
from ebbflow.operators import patterns as P
from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE, run_state_machine


def tape(seed, n=90, ties=True):
    """(seq, door, signal, at): three doors and a nameless one; some equal times."""
    rng = random.Random(seed)
    at, out = 0, []
    for i in range(n):
        at += rng.choice([0, 1, 1, 4]) if ties else 1
        out.append((i, rng.choice(["north", "south", "west", None]), rng.choice(["fail"] * 5 + ["success", "knock"]), at))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "seq long, door string, signal string, at long")


def per_door(data):
    doors = {}
    for row in sorted(data, key=lambda r: (r[3], r[0])):
        doors.setdefault(row[1], []).append(row)
    return doors


def key(t):
    return str(t)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_chunk", [3, 17, 10**9])
def test_three_in_a_row(spark, seed, rows_per_chunk):
    data = tape(seed)
    fail = F.col("signal") == "fail"
    want = sorted(((d, *(r[0] for r in run[i:i + 3])) for d, run in per_door(data).items()
                   for i in range(len(run) - 2) if all(r[2] == "fail" for r in run[i:i + 3])), key=key)
    for pattern in (P.Pattern.begin("f", fail).times(3), P.Pattern.begin("a", fail).next("b", fail).next("c", fail)):
        out = P.strict_matches(frame(spark, data), pattern, "door", ["at", "seq"], ["seq"], rows_per_chunk=rows_per_chunk)
        assert sorted((tuple(r) for r in out.collect()), key=key) == want
    assert want


@pytest.mark.parametrize("rows_per_chunk", [3, 17, 10**9])
def test_state_machine_alerts_on_every_third_failure_and_after(spark, rows_per_chunk):
    data = tape(5)
    want = []
    for door, run in per_door(data).items():
        failures = 0
        for seq, _, signal, _ in run:
            failures = failures + 1 if signal == "fail" else 0
            if failures >= 3:
                want.append((door, seq))
    out = run_state_machine(frame(spark, data), LOGIN_FAILURE_MACHINE, "door", ["at", "seq"], "signal", ["seq"],
                            rows_per_chunk=rows_per_chunk)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(want, key=key) and want


@pytest.mark.parametrize("rows_per_chunk", [4, 10**9])
def test_followed_by_within_or_timeout(spark, rows_per_chunk):
    """A knock is answered by the first success after it, in time (less than 12) or not."""
    data = tape(8, 150)
    want = []
    for door, run in per_door(data).items():
        for i, (seq, _, signal, at) in enumerate(run):
            if signal == "knock":
                end = next((r[3] for r in run[i + 1:] if r[2] == "success"), None)
                want.append((door, seq, "matched" if end is not None and end - at < 12 else "timeout"))
    df = frame(spark, data).withColumn("ts", from_epoch_ms(F.col("at") * 1000))
    pattern = P.Pattern.begin("k", F.col("signal") == "knock").followed_by("s", F.col("signal") == "success").within("12 seconds")
    out = P.followed_by_within(df, pattern, "door", "ts", "seq", ["seq"], rows_per_chunk=rows_per_chunk)
    got = sorted(((r["door"], r["k_seq"], r["status"]) for r in out.collect()), key=key)
    assert got == sorted(want, key=key) and {w[2] for w in want} == {"matched", "timeout"}
