"""Keys dealt to parts with state in blocks: the same rows, and trips to the
state that do not grow with the keys."""

import random
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE
from ebbflow.streaming import connected as CO
from ebbflow.streaming import late as L
from ebbflow.streaming import processors as PR
from ebbflow.streaming import savepoint as SP
from ebbflow.streaming import sources as SS

SECOND = 1_000_000


class Rec(SimpleNamespace):
    def __getitem__(self, name):
        return getattr(self, name)


class Fake:
    """A handle whose states count their reads and writes."""

    def __init__(self):
        self.trips, self.states, self.timers = 0, {}, set()

    def _state(self, name, *_, **__):
        return self.states.setdefault(name, FakeState(self))

    getListState = getValueState = getMapState = _state

    def registerTimer(self, ms):
        self.timers.add(ms)


class FakeState:
    def __init__(self, handle):
        self.handle, self.rows, self.value, self.map = handle, [], None, {}

    def _trip(self):
        self.handle.trips += 1

    def exists(self):
        self._trip()
        return bool(self.rows) or self.value is not None

    def get(self):
        self._trip()
        return iter(list(self.rows)) if self.value is None else self.value

    def put(self, rows):
        self._trip()
        self.rows = list(rows)

    def appendList(self, rows):
        self._trip()
        self.rows += rows

    def update(self, value):
        self._trip()
        self.value = value

    def clear(self):
        self._trip()
        self.rows, self.value = [], None

    def containsKey(self, k):
        self._trip()
        return k in self.map

    def getValue(self, k):
        self._trip()
        return self.map[k]

    def updateValue(self, k, v):
        self._trip()
        self.map[k] = v


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def run(proc, batches, part=(0,)):
    """Batches of rows with the watermark (ms) each leaves: all rows that come out, and the handle."""
    handle, out, wm = Fake(), [], 0
    proc.init(handle)
    for rows, after in batches:
        if rows:
            out += proc.handleInputRows(part, iter(rows), Now(wm))
        wm = after
        while due := sorted(t for t in handle.timers if t <= wm):
            handle.timers -= set(due)
            for _ in due:
                out += proc.handleExpiredTimer(part, Now(wm), None)
    return out, handle


# ------------------------------------------------------------ F1, two inputs ---

def test_pairs_of_many_keys_in_one_part():
    keys = [(k, salt) for k in range(500) for salt in (0, 1)]
    batches = [([Rec(side=s, key=k, salt=salt, seq=i, ref=1000 * i + k) for k, salt in keys for s in sides], i)
               for i, sides in enumerate([(0,), (1,), (0, 1)])]
    out, handle = run(CO.PairProcessor(), batches)
    # firsts in batches 0 and 2, seconds in 1 and 2: a second of batch 2 also meets the first of its batch
    assert Counter((r["key"], r["emitted_by"]) for r in out) == Counter(
        {(k, "stream-1"): 2 for k in range(500)} | {(k, "stream-2"): 6 for k in range(500)})
    assert all(r["arriving"] % 1000 == r["key"] == r["stored"] % 1000 for r in out)
    assert handle.trips <= 20


# -------------------------------------------- F3, F4, F5, order of event time ---

@pytest.mark.parametrize("logic", [PR.MachineLogic(LOGIN_FAILURE_MACHINE), PR.PeriodicLogic(40 * SECOND),
                                   PR.FollowedByLogic("fail", "success", 30 * SECOND)], ids=["machine", "periodic", "followed"])
def test_a_part_folds_each_of_its_keys(logic):
    rng, seq, batches, last = random.Random(3), 0, [], 0
    for b in range(4):
        rows = []
        for k in [None, *range(200)]:
            for at in sorted(rng.sample(range(100 * b, 100 * b + 100), 5)):
                rows.append(Rec(key=k, us=at * SECOND + 1, seq=seq, v=rng.choice(["fail", "fail", "fail", "success", "view", None])))
                seq += 1
        rng.shuffle(rows)
        last = 100 * b + 100
        batches.append((rows, last * 1000))
    batches.append(([], 10_000_000))
    want = Counter()
    for k in [None, *range(200)]:
        one = [([r for r in rows if r.key == k], after) for rows, after in batches]
        got: list = []
        state = logic.start()
        for rows, after in one:
            for r in sorted(rows, key=lambda r: (r.us, r.seq)):
                state = logic.fold(state, r.us, r.seq, r.v, got.append)
            state = logic.passed(state, after * 1000, got.append)
        want.update((k, tuple(sorted((n, v) for n, v in o.items() if v is not None))) for o in got)
    out, handle = run(PR.OrderedProcessor(logic, 0, 0), batches)
    assert Counter((r["key"], tuple(sorted((n, r[n]) for n in ("seq", "us", "v", "a", "b", "status") if r[n] is not None))) for r in out) == want
    assert want and {r["tag"] for r in out} == {"main"} and handle.trips <= 120 and not handle.timers


def test_rows_behind_what_their_key_has_folded_are_late():
    rec = lambda k, at: Rec(key=k, us=at, seq=at, v="fail")
    out, _ = run(PR.OrderedProcessor(PR.StrictLogic(["fail"]), 0, 0), [([rec(1, 5000)], 9), ([rec(1, 4000), rec(2, 4000)], 20)])
    assert sorted((r["tag"], r["key"], r["us"]) for r in out) == [("late", 1, 4000), ("main", 1, 5000), ("main", 2, 4000)]


# ------------------------------------------------------------------ F6, rules ---

def test_rules_of_many_ids_in_one_part():
    rule = Rec(action_no=None, rule_no=0, before="view", now="buy", id=None)
    batches = [([Rec(action_no=k, id=k, now="view") for k in range(400)] + [rule], 0),
               ([Rec(action_no=1000 + k, id=k, now="buy" if k % 2 else "view") for k in range(400)], 0),
               ([Rec(action_no=2000 + k, id=k, now="buy") for k in range(400)] + [Rec(action_no=3000, id=None, now="buy")], 0)]
    out, handle = run(CO.RuleProcessor(), batches)
    assert sorted((r["id"], r["action_no"]) for r in out) == [(k, 1000 + k if k % 2 else 2000 + k) for k in range(400)]
    assert handle.trips <= 40


# ------------------------------------------------------------------- F8, late ---

def test_late_windows_of_many_users_in_one_part():
    row = lambda u, at, seq: Rec(user=u, us=at, seq=seq)
    users = [None, *range(300)]
    batches = [([row(u, 10, 0) for u in users] * 2, 1500), ([row(u, 20, 1) for u in users], 5000), ([row(u, 30, 2) for u in users], 5000)]
    out, handle = run(L.LateWindowProcessor("us", "seq", "seq", SECOND, 0, 2 * SECOND, 0, "user"), batches)
    assert Counter((r["key"], r["tag"], r["cnt"]) for r in out) == Counter(
        {(u, *what): 1 for u in users for what in [("main", 2), ("update", 3), ("late", None)]})
    assert handle.trips <= 30 and not handle.timers and not handle.states["windows"].rows


# -------------------------------------------------------- F2, F7, word counts ---

def test_counts_of_many_words_in_one_part():
    proc, handle = SP.CountFrom(), Fake()
    proc.init(handle)
    proc.handleInitialState((0,), Rec(words=[{"word": f"w{i}", "cnt": i} for i in range(3000)]), None)
    out = list(proc.handleInputRows((0,), iter([Rec(word=f"w{i % 4000}", times=2) for i in range(8000)]), None))
    want = {f"w{i}": (i if i < 3000 else 0) + 4 for i in range(4000)}
    assert {r["word"]: r["cnt"] for r in out} == want and len(out) == 4000 and handle.trips <= 5
    assert {w: n for (words,), (counts,) in handle.states["count"].rows for w, n in zip(words, counts)} == want


def test_a_task_counts_its_words_over_its_batches(monkeypatch):
    batches = [pa.RecordBatch.from_arrays([pa.array([f"w{i % 7}" for i in range(100)] + [None])], ["word"]) for _ in range(50)]
    words = Counter([f"w{i % 7}" for i in range(100)] + [None])
    for limit, rows in ((200_000, 8), (10, 8 * 50)):
        monkeypatch.setattr(SP, "WORDS_AT_ONCE", limit)
        got = [r for b in SP._partial(iter(batches)) for r in b.to_pylist()]
        total = Counter()
        for r in got:
            total[r["word"]] += r["times"]
        assert total == Counter({w: 50 * n for w, n in words.items()}) and len(got) <= rows


def test_files_of_a_range_follow_the_bytes_too(spark, monkeypatch):
    df = spark.range(40).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    monkeypatch.setattr(SS, "BYTES_PER_FILE", 2_000)
    frames = SS.arrival_ranges(df, "id", 2)
    assert len(frames) == 2 and frames.files == 11 and frames.rows == 40 and frames.bytes == 40 * 1008
    staged = SS.staged_ranges(df, F.pmod("id", F.lit(4)), 4)
    assert staged.files == 6 and sum(f.count() for f in staged) == 40
