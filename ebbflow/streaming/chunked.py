"""Busy keys on a stream, folded in order of event time by many tasks.

:class:`~ebbflow.streaming.processors.OrderedProcessor` folds a key's rows one
after the other. For keys that hold a large share of all rows two operators do
the same in one query: the first is keyed by the key and a bucket of time, waits
until the watermark has passed the bucket, folds its rows in order and leaves a
summary of what the bucket does to any state it may be entered with; what does
not depend on that state comes out at once. The second is keyed by the key alone
and composes the summaries in order: a few rows for each bucket.

A *chunk* of a logic is ``summary(rows, emit)`` - a value that JSON can hold -
and ``combine(state, summary, emit)``. The rows that come out are those of the
plain fold. Rows of a bucket that has been passed come out with the tag ``late``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.streaming import blocks as B
from ebbflow.streaming import processors as PR

_NONE = {"seq": None, "us": None, "v": None, "a": None, "b": None, "status": None}


class MachineChunk:
    """A state machine: where each state leads, and the alerts on the way until
    all states have met; from there on alerts depend on nothing."""

    def __init__(self, logic: PR.MachineLogic):
        self.logic = logic

    def summary(self, rows, emit):
        sm = self.logic.sm
        at = {s: s for s in sm.states()}
        alerts: dict[str, list] = {s: [] for s in at}
        for us, seq, v in rows:
            moved = {now: sm.step(now, v) for now in set(at.values())}
            if len(moved) == 1:
                (now, alert), = moved.values()
                at = dict.fromkeys(at, now)
                if alert:
                    emit({"seq": seq, "us": us})
                continue
            for s, now in at.items():
                at[s], alert = moved[now]
                if alert:
                    alerts[s].append([seq, us])
        return {s: [at[s], alerts[s]] for s in at}

    def combine(self, state, summary, emit):
        now, alerts = summary[state[0]]
        for seq, us in alerts:
            emit({"seq": seq, "us": us})
        return (now,)


class StrictChunk:
    """A strict pattern: matches inside the bucket come out, its first and last
    rows meet those of its neighbours."""

    def __init__(self, logic: PR.StrictLogic):
        self.logic, self.k = logic, len(logic.steps) - 1

    def summary(self, rows, emit):
        state = self.logic.start()
        for us, seq, v in rows:
            state = self.logic.fold(state, us, seq, v, emit)
        ends = [[us, seq, v] for us, seq, v in rows]
        return {"rows": len(rows), "first": ends[:self.k], "last": [[v, us] for us, _, v in ends[-self.k:]] if self.k else []}

    def combine(self, state, summary, emit):
        state = deque(state, maxlen=self.k + 1)
        if len(state) > self.k:
            state.popleft()  # only what a coming row can complete
        for us, seq, v in summary["first"]:  # too few to match among themselves
            state = self.logic.fold(state, us, seq, v, emit)
        kept = [*state, *summary["last"]] if summary["rows"] > self.k else list(state)
        return deque(kept[-self.k:] if self.k else [], maxlen=self.k + 1)


class FollowedByChunk:
    """A relaxed pattern: starts with an end row in the bucket come out; the
    first end row is for starts of earlier buckets, the last starts go on."""

    def __init__(self, logic: PR.FollowedByLogic):
        self.logic = logic

    def summary(self, rows, emit):
        state, first = self.logic.start(), None
        for us, seq, v in rows:
            if first is None and v == self.logic.end_value:
                first = us
            state = self.logic.fold(state, us, seq, v, emit)
        return {"end": first, "open": list(state)}

    def combine(self, state, summary, emit):
        if summary["end"] is not None:
            state = self.logic.fold(state, summary["end"], None, self.logic.end_value, emit)
        state.extend(map(tuple, summary["open"]))
        return state


CHUNKS = {PR.MachineLogic: MachineChunk, PR.StrictLogic: StrictChunk, PR.FollowedByLogic: FollowedByChunk}


class BucketProcessor(StatefulProcessor):
    """The rows of a key and a bucket of time, until the watermark has passed it."""

    def __init__(self, chunk, width_us: int, bound_us: int, delay_us: int):
        self.chunk, self.width, self.clock = chunk, width_us, PR.Clock(bound_us, delay_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "us long, seq long, v string")

    def _row(self, key, tag, summary=None, **fields):
        # the bucket's end is the row's event time, for the operator that follows
        end = datetime.fromtimestamp((key[1] + 1) * self.width // 1_000_000, timezone.utc)
        return Row(tag=tag, key=key[0], **_NONE | fields, bucket=key[1], summary=summary, end=end)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end, now = (key[1] + 1) * self.width, self.clock.now(timerValues)
        if now is not None and end <= now:
            for r in rows:
                yield self._row(key, "late", seq=r.seq, us=r.us, v=r.v)
        else:
            self.rows.appendList([(r.us, r.seq, r.v) for r in rows])
            self.handle.registerTimer(self.clock.timer(end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = sorted(((r[0], r[1], r[2]) for r in self.rows.get()), key=lambda r: (r[0], r[1])) if self.rows.exists() else []
        self.rows.clear()
        if held:
            out: list[dict] = []
            summary = json.dumps(self.chunk.summary(held, out.append))
            for o in out:
                yield self._row(key, "main", **o)
            yield self._row(key, "summary", summary)

    def close(self) -> None:
        pass


class ComposeProcessor(StatefulProcessor):
    """Composes a key's summaries in order of their buckets."""

    def __init__(self, logic, chunk, width_us: int, bound_us: int, delay_us: int):
        self.logic, self.chunk, self.width, self.clock = logic, chunk, width_us, PR.Clock(bound_us, delay_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.logic.schema)

    def _keep(self, state) -> None:
        self.state.update(self.logic.dump(state))
        due = self.logic.wakes(state)
        if due is not None:  # not before the bucket that holds the time is composed
            self.handle.registerTimer(self.clock.timer((due // self.width + 1) * self.width))

    def _state(self):
        return self.logic.load(tuple(self.state.get())) if self.state.exists() else self.logic.start()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        summaries, out = [], []
        for r in rows:
            if r.tag == "summary":
                summaries.append((r.bucket, r.summary))
            else:
                yield Row(tag=r.tag, key=key[0], seq=r.seq, us=r.us, v=r.v, a=r.a, b=r.b, status=r.status)
        if summaries:
            state = self._state()
            for _, summary in sorted(summaries):
                state = self.chunk.combine(state, json.loads(summary), out.append)
            self._keep(state)
        for o in out:
            yield Row(tag="main", key=key[0], **_NONE | o)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        out: list[dict] = []
        now = self.clock.now(timerValues) // self.width * self.width  # composed up to here
        self._keep(self.logic.passed(self._state(), now, out.append))
        for o in out:
            yield Row(tag="main", key=key[0], **_NONE | o)

    def close(self) -> None:
        pass


def ordered_fold(rows: DataFrame, logic, bound_us: int, delay_us: int, key_type: str = "long", hot: list | None = None,
                 width_us: int = 6 * 3_600_000_000, parts: int | None = None) -> DataFrame:
    """All output of ``logic`` over the widened stream ``key, us, seq, v, ts``.
    Rows of ``hot`` keys (null may be one) go by buckets of ``width_us``, other
    keys are dealt to ``parts`` (None: those of a small input)."""
    schema = PR.output_schema(key_type)
    part = B.part_of(parts or B.part_count(rows.sparkSession), "key")

    def plain(df):
        return df.withColumn("part", part).groupBy("part").transformWithState(PR.OrderedProcessor(logic, bound_us, delay_us), schema, "Append", "EventTime")

    if not hot or type(logic) not in CHUNKS:
        return plain(rows)
    busy = F.col("key").isin([k for k in hot if k is not None]) if set(hot) - {None} else F.lit(False)
    busy = F.coalesce(busy, F.lit(None in hot))
    chunk = CHUNKS[type(logic)](logic)
    parts = (rows.filter(busy).withColumn("bucket", PR.bucket_of(F.col("us"), width_us)).groupBy("key", "bucket")
             .transformWithState(BucketProcessor(chunk, width_us, bound_us, delay_us), schema + ", bucket long, summary string, end timestamp", "Append", "EventTime",
                                eventTimeColumnName="end"))
    whole = parts.groupBy("key").transformWithState(ComposeProcessor(logic, chunk, width_us, bound_us, delay_us), schema, "Append", "EventTime")
    return plain(rows.filter(~busy)).unionByName(whole)
