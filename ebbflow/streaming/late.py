"""Allowed lateness and the late-row side output on a stream.

Spark's own window aggregation drops rows behind the watermark silently
and has no allowed-lateness re-firing. This processor rebuilds both with
``transformWithState`` (SURVEY H1, P6, P7):

* The stream declares a *wide* watermark delay ``D``, so Spark never drops a
  row before the processor sees it. Inside, the effective watermark is
  ``spark_wm + D - bound``, the watermark of the original job. With ``D`` the
  span of event times (as the replaying queries take it) no row can be later.
* A key is a part of the users and a bucket of window starts; its list state
  holds, in blocks (:mod:`.blocks`), ``(user, window start, on-time count, total
  count, fired)`` for windows not yet purged, read and written once a batch. A row meets the watermark of the
  previous micro-batch: window still open -> counted; window fired but
  ``end + lateness`` not yet reached -> counted and an ``update`` row is emitted
  at once; otherwise the row itself goes to the ``late`` side output.
* One timer a key, for the next thing that is due: at ``end`` (shifted by
  ``D - bound``) a window emits the ``main`` row with its on-time count (rows of
  a batch are handled before that batch's timers, so rows already counted as
  updates are kept apart); at ``end + lateness`` it is purged. Waking up reads
  the windows of its own bucket only.

Output is one tagged stream: ``tag`` = ``main`` | ``update`` | ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.streaming import blocks as B


class LateWindowProcessor(StatefulProcessor):
    """``user``: the column of the rows that names their user (None: the grouping
    key does)."""

    def __init__(self, ts: str, seq: str, order: str, size_us: int, bound_us: int,
                 lateness_us: int, declared_delay_us: int, user: str | None = None):
        self.ts, self.seq, self.order, self.user = ts, seq, order, user
        self.size, self.bound, self.lateness = size_us, bound_us, lateness_us
        self.shift = declared_delay_us - bound_us   # effective wm = spark wm + shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # user, start, rows counted before the window fired, all rows counted, fired
        self.windows = handle.getListState("windows", B.SCHEMA)
        self.woken = None  # part and watermark that were dealt with, since rows came

    def _timer(self, effective_us: int) -> int:
        """Timer (ms, Spark watermark clock) firing once the effective
        watermark reaches ``effective_us``."""
        spark_us = effective_us - self.shift
        return -((-spark_us) // 1000)

    def _now(self, timer_values) -> int | None:
        ms = timer_values.getCurrentWatermarkInMs()
        return None if ms <= 0 else ms * 1000 + self.shift

    def _held(self) -> dict[tuple, list]:
        return {(who, start): counts for who, start, *counts in B.stored(self.windows)}

    def _keep(self, held: dict[tuple, list]) -> None:
        """Write the windows and set the timer of the next thing due."""
        B.replace(self.windows, ((*window, *counts) for window, counts in held.items()))
        if held:
            self.handle.registerTimer(self._timer(min(
                start + self.size + (self.lateness if fired or not ontime else 0) for (_, start), (ontime, _, fired) in held.items())))

    def _row(self, tag, who, start, cnt, seq):
        return Row(tag=tag, key=who, start_us=start, end_us=start + self.size, cnt=cnt,
                   seq=seq)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        eff = self._now(timerValues)
        held, self.woken = None, None
        for r in sorted(rows, key=lambda x: (x[self.order], x[self.seq])):
            who = r[self.user] if self.user else key[0]
            start = r[self.ts] // self.size * self.size
            end = start + self.size
            if eff is not None and end + self.lateness <= eff:
                yield self._row("late", who, start, None, r[self.seq])
                continue
            held = self._held() if held is None else held
            counts = held.setdefault((who, start), [0, 0, False])
            counts[1] += 1
            if eff is not None and end <= eff:
                yield self._row("update", who, start, counts[1], r[self.seq])
            else:
                counts[0] += 1
        if held is not None:
            self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._now(timerValues)
        if self.woken == (tuple(key), now):  # another timer of the part: all that is due is done
            return
        self.woken = tuple(key), now
        held = self._held()
        for (who, start), counts in list(held.items()):
            end = start + self.size
            if not counts[2] and counts[0] > 0 and end <= now:
                yield self._row("main", who, start, counts[0], None)
                counts[2] = True
            if end + self.lateness <= now:
                del held[who, start]
        self._keep(held)

    def close(self) -> None:
        pass


class WatermarkTraceProcessor(StatefulProcessor):
    """T7 on a stream (no state; the key only spreads the rows): each row with the watermark it met (the one left by the
    previous micro-batch), read with ``getCurrentWatermarkInMs`` and shifted
    back from the wide declared delay to the real bound. None before the
    first watermark."""

    def __init__(self, seq: str, user: str, bound_us: int, declared_delay_us: int):
        self.seq, self.user = seq, user
        self.shift = declared_delay_us - bound_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm_ms = timerValues.getCurrentWatermarkInMs()
        wm = None if wm_ms <= 0 else wm_ms * 1000 + self.shift
        for r in rows:
            yield Row(key=r[self.user], seq=r[self.seq], wm_us=wm)

    def close(self) -> None:
        pass
