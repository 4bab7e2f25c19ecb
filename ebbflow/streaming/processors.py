"""Keyed state and timers on streams: ``transformWithState`` processors
(G1-G6, F2, F3, W9, C1-C7, A1, A2, A9, A10).

What a job does with a key's rows is a small *logic* object (a fold over rows
plus what happens when time passes); two processors run such a logic:

* :class:`OrderedProcessor` - in order of event time (C7). Keys are dealt to
  parts. Rows wait in list state until the watermark has passed them; one timer
  per part and batch wakes the part up, and everything due is folded in order of
  each key. What a logic dumps is a tuple that JSON can hold. A row that is older than
  what its key has already folded cannot be put in order any more: it goes to
  the output with the tag ``late``. No row is lost: the stream declares a wide
  watermark delay, so Spark drops nothing, and the processor keeps the real
  bound (:func:`widened`).
* :class:`ArrivalProcessor` - in order of arrival (a sequence number), with no
  event time: running values.

Processors whose state is a set of due times (:class:`ManualWindowProcessor`,
:class:`EventTimerProcessor`) hold it in buckets of due time: the bucket is part
of the grouping key, a key has one timer, for its earliest due time, and waking
up reads that bucket alone. So reads grow with the timers, not with their square.

Conventions: event time is epoch *microseconds* (long), timers milliseconds as
the watermark is. Input rows are ``us, seq, v`` (v: a string). Output rows are
``tag, key, seq, us, v, a, b, status``, of which a logic fills what it needs.
Handler parameter names are the ones Spark passes by keyword. State is read and
written once per key (or part) and batch, not once per row.
"""

from __future__ import annotations

import json
from collections import Counter, deque
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.operators.state_machine import StateMachine
from ebbflow.streaming import blocks as B

OUT = "seq long, us long, v string, a long, b long, status string"
_NONE = {"seq": None, "us": None, "v": None, "a": None, "b": None, "status": None}


def output_schema(key_type: str) -> str:
    return f"tag string, key {key_type}, {OUT}"


def widened(df: DataFrame, ts: str, delay_us: int) -> DataFrame:
    """``df`` with a watermark ``delay_us`` behind, for a processor that keeps
    the real bound itself. With a delay of the whole span of event times no row
    can be behind it."""
    return df.withWatermark(ts, f"{delay_us} microseconds")


class Clock:
    """The effective watermark of a processor behind a widened one."""

    def __init__(self, bound_us: int, delay_us: int):
        self.shift = delay_us - bound_us

    def now(self, timer_values) -> int | None:
        ms = timer_values.getCurrentWatermarkInMs()
        return None if ms <= 0 else ms * 1000 + self.shift

    def timer(self, us: int) -> int:
        """The timer (ms) that fires once the effective watermark is at ``us``."""
        return -((self.shift - us) // 1000)


class OrderedProcessor(StatefulProcessor):
    """Fold each key's rows in order of (event time, sequence number). The
    grouping key is one of the parts that keys are dealt to (:mod:`.blocks`)."""

    def __init__(self, logic, bound_us: int, delay_us: int):
        self.logic, self.clock = logic, Clock(bound_us, delay_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", B.SCHEMA)  # key, us, seq, v
        self.keys = handle.getListState("keys", B.SCHEMA)  # key, state, folded up to here, times to wake up at
        self.woken = None  # part and watermark that were dealt with, since rows came

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        done = {k: at for k, _, at, _ in B.stored(self.keys)}
        fresh, self.woken = [], None
        for r in rows:
            at = done.get(r.key)
            if at is not None and r.us <= at:
                yield Row(tag="late", key=r.key, **_NONE | {"seq": r.seq, "us": r.us, "v": r.v})
            else:
                fresh.append((r.key, r.us, r.seq, r.v))
        if fresh:
            B.append(self.waiting, fresh)
            self.handle.registerTimer(self.clock.timer(min(r[1] for r in fresh)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.clock.now(timerValues)
        if self.woken == (key[0], now):  # another timer of the part: all that is due is done
            return
        self.woken = key[0], now
        held: dict = {}
        for k, us, seq, v in B.stored(self.waiting):
            held.setdefault(k, []).append((us, seq, v))
        known = {k: entry for k, *entry in B.stored(self.keys)}
        for k in [*held, *(k for k in known if k not in held)]:
            stored, _, wakes = known.get(k, (None, None, []))
            rows = held.get(k, [])
            if not any(r[0] <= now for r in rows) and not any(w <= now for w in wakes):
                continue
            state = self.logic.load(tuple(stored)) if stored is not None else self.logic.start()
            out: list[dict] = []
            for us, seq, v in sorted((r for r in rows if r[0] <= now), key=lambda r: r[:2]):
                state = self.logic.fold(state, us, seq, v, out.append)
            state = self.logic.passed(state, now, out.append)
            held[k] = rest = [r for r in rows if r[0] > now]
            wake = self.logic.wakes(state)
            if wake is not None and wake <= min((r[0] for r in rest), default=wake):
                wakes = [*wakes, wake]
            known[k] = self.logic.dump(state), now, sorted({w for w in wakes if w > now})
            for o in out:
                yield Row(tag="main", key=k, **_NONE | o)
        B.replace(self.waiting, ((k, *r) for k, rows in held.items() for r in rows))
        B.replace(self.keys, ((k, *entry) for k, entry in known.items()))
        due = [min(r[0] for r in rows) for rows in held.values() if rows] + [w[0] for _, _, w in known.values() if w]
        if due:
            self.handle.registerTimer(self.clock.timer(min(due)))

    def close(self) -> None:
        pass


class ArrivalProcessor(StatefulProcessor):
    """Fold each key's rows in order of their sequence number within every
    batch (batches follow the sequence). ``ttl_ms``: processing time after
    which a key that got no row starts afresh (G6)."""

    def __init__(self, logic, ttl_ms: int | None = None):
        self.logic, self.ttl = logic, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.logic.schema, **({"ttlDurationMs": self.ttl} if self.ttl else {}))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.logic.load(tuple(self.state.get())) if self.state.exists() else self.logic.start()
        out: list[dict] = []
        for r in sorted(rows, key=lambda r: r.seq):
            state = self.logic.fold(state, r.us, r.seq, r.v, out.append)
        self.state.update(self.logic.dump(state))
        for o in out:
            yield Row(tag="main", key=key[0], **_NONE | o)

    def close(self) -> None:
        pass


class Logic:
    """A fold: ``schema`` and ``start()`` of its state, ``fold`` for a row,
    ``passed`` when the watermark is at ``now``, ``wakes``: when it wants that
    next (None: not on its own account). ``emit`` takes a dict of output fields.
    ``load`` and ``dump``, once a batch, turn what the state store holds into
    what is folded and back."""

    schema = ""

    def start(self):
        raise NotImplementedError

    def load(self, stored: tuple):
        return stored

    def dump(self, state) -> tuple:
        return state

    def fold(self, state, us: int, seq: int, v: str, emit: Callable[[dict], None]):
        raise NotImplementedError

    def passed(self, state, now: int, emit: Callable[[dict], None]):
        return state

    def wakes(self, state) -> int | None:
        return None


class MachineLogic(Logic):
    """A state machine; one row for each alert."""

    schema = "state string"

    def __init__(self, sm: StateMachine):
        self.sm = sm

    def start(self):
        return (self.sm.initial,)

    def fold(self, state, us, seq, v, emit):
        nxt, alert = self.sm.step(state[0], v)
        if alert:
            emit({"seq": seq, "us": us})
        return (nxt,)


class StrictLogic(Logic):
    """``len(steps)`` rows in a row with these values; overlapping
    matches are all kept. Emits the last row, with the times of the first two
    as ``a`` and ``b``."""

    schema = "recent string"

    def __init__(self, steps: list[str]):
        self.steps = steps

    def start(self):
        return deque(maxlen=len(self.steps))

    def load(self, stored):
        return deque(json.loads(stored[0]), maxlen=len(self.steps))

    def dump(self, state):
        return (json.dumps(list(state)),)

    def fold(self, state, us, seq, v, emit):
        state.append([v, us])
        if [r[0] for r in state] == self.steps:
            emit({"seq": seq, "us": us, "a": state[0][1], "b": state[min(1, len(state) - 1)][1]})
        return state


class FollowedByLogic(Logic):
    """Every start row takes the first end row after it (``matched`` if
    it comes in less than ``within``), or times out. Starts that wait stand in
    order of their times, so each is added once and taken once."""

    schema = "pending string"

    def __init__(self, start_value: str, end_value: str, within_us: int):
        self.start_value, self.end_value, self.within = start_value, end_value, within_us

    def start(self):
        return deque()

    def load(self, stored):
        return deque(map(tuple, json.loads(stored[0])))

    def dump(self, state):
        return (json.dumps(list(state)),)

    def fold(self, state, us, seq, v, emit):
        if v == self.end_value:
            while state:
                s, at = state.popleft()
                ok = us - at < self.within
                emit({"seq": s, "us": at, "a": us if ok else None, "status": "matched" if ok else "timeout"})
        elif v == self.start_value:
            state.append((seq, us))
        return state

    def passed(self, state, now, emit):
        while state and state[0][1] + self.within <= now:
            s, at = state.popleft()
            emit({"seq": s, "us": at, "status": "timeout"})
        return state

    def wakes(self, state):
        return state[0][1] + self.within if state else None


class PeriodicLogic(Logic):
    """a timer one period after the first row sets it; it emits (timer,
    rows so far) and the next row sets the next."""

    schema = "n long, timer long"

    def __init__(self, period_us: int):
        self.period = period_us

    def start(self):
        return (0, None)

    def fold(self, state, us, seq, v, emit):
        n, timer = state
        if timer is not None and us > timer:
            emit({"us": timer, "a": n})
            timer = None
        return (n + 1, us + self.period if timer is None else timer)

    def passed(self, state, now, emit):
        n, timer = state
        if timer is not None and timer <= now:
            emit({"us": timer, "a": n})
            return (n, None)
        return state

    def wakes(self, state):
        return state[1]


class CountLogic(Logic):
    """The running count as ``a`` and as text."""

    schema = "n long"

    def start(self):
        return (0,)

    def fold(self, state, us, seq, v, emit):
        emit({"seq": seq, "a": state[0] + 1, "status": f"count：{state[0] + 1}"})
        return (state[0] + 1,)


class MaxLogic(Logic):
    """A1: the running maximum of the time with the first row's value."""

    schema = "v string, us long"

    def start(self):
        return (None, None)

    def fold(self, state, us, seq, v, emit):
        new = (v, us) if state[1] is None else (state[0], max(state[1], us))
        emit({"seq": seq, "v": new[0], "us": new[1]})
        return new


class MeanLogic(Logic):
    """Every ``n``-th row emits the mean (long division) of the time in
    milliseconds so far (G5); the sum is held as text, it may pass a long."""

    schema = "n long, total string"

    def __init__(self, every: int):
        self.every = every

    def start(self):
        return (0, "0")

    def fold(self, state, us, seq, v, emit):
        n, total = state[0] + 1, int(state[1]) + us // 1000
        if n % self.every == 0:
            emit({"seq": seq, "a": n, "b": total // n})
        return (n, str(total))


class PreviousLogic(Logic):
    """Each row's value with that of the row before (``status``)."""

    schema = "v string"

    def start(self):
        return (None,)

    def fold(self, state, us, seq, v, emit):
        emit({"seq": seq, "v": v, "status": state[0]})
        return (v,)


class ManualWindowProcessor(StatefulProcessor):
    """Map state ``window start -> count`` (G3) and a timer for the earliest
    end. The grouping key ends in what the windows are counted by and holds a
    bucket of their starts (:func:`bucket_of`). Rows of a window that has fired
    give a further partial count, so counts of a window add up to its rows."""

    def __init__(self, size_us: int, bound_us: int, delay_us: int):
        self.size, self.clock = size_us, Clock(bound_us, delay_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "start long", "cnt long")

    def _wake(self, starts) -> None:
        self.handle.registerTimer(self.clock.timer(min(starts) + self.size - 1000))

    def _held(self) -> dict[int, int]:
        return {k[0]: v[0] for k, v in self.counts.iterator()} if self.counts.exists() else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        got = Counter(r.us // self.size * self.size for r in rows)
        held = self._held()
        for start, n in got.items():
            self.counts.updateValue((start,), (held.get(start, 0) + n,))
        self._wake(got)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.clock.now(timerValues)
        held = self._held()
        for start, cnt in held.items():
            if start + self.size - 1000 <= now:
                self.counts.removeKey((start,))
                yield Row(start_us=start, end_us=start + self.size, key=key[-1], cnt=cnt)
        rest = [start for start in held if start + self.size - 1000 > now]
        if rest:
            self._wake(rest)

    def close(self) -> None:
        pass


class EventTimerProcessor(StatefulProcessor):
    """one event-time timer a fixed delay after every row; timers at the
    same time collapse into one, as they meet in one key. List state holds those
    that are set, of the due times of the key's bucket (:func:`bucket_of`): rows
    of a batch are appended without reading it."""

    def __init__(self, after_us: int, bound_us: int, delay_us: int):
        self.after, self.clock = after_us, Clock(bound_us, delay_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getListState("due", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = sorted({r.us + self.after for r in rows})
        self.due.appendList([(at,) for at in fresh])
        self.handle.registerTimer(self.clock.timer(fresh[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.clock.now(timerValues)
        held = sorted({r[0] for r in self.due.get()}) if self.due.exists() else []
        rest = [at for at in held if at > now]
        if rest:
            self.due.put([(at,) for at in rest])
            self.handle.registerTimer(self.clock.timer(rest[0]))
        elif held:
            self.due.clear()
        for at in held[:len(held) - len(rest)]:
            yield Row(timer_us=at)

    def close(self) -> None:
        pass


def bucket_of(us, width_us: int):
    """The bucket of a time (epoch microseconds) for a grouping key."""
    return F.floor(us / F.lit(width_us)).cast("long")


def keyed_rows(df: DataFrame, key, ts: str, seq: str, value) -> DataFrame:
    """``key, us, seq, v`` (and the event time) for the processors above."""
    return df.select(key.alias("key"), F.unix_micros(F.col(ts)).alias("us"), F.col(seq).alias("seq"),
                     value.cast("string").alias("v"), F.col(ts))
