"""State with a time to live whose expired value is visible until it is cleaned
(G6). Spark's own TTL never returns an expired value; here the value carries the
time of its last write, and a timer cleans it lazily.

The clock is the event time of the rows: a manual clock, under which a run can
be repeated. A row finds its key's state

* ``live``: written at most ``ttl`` ago;
* ``stale``: expired, but no cleaning has come by yet: the old value is read,
  and the write that follows refreshes it;
* ``first``: never written, or cleaned since.

Cleaning is a timer at the last write plus ``ttl``; a newer write moves it. It
comes by after the rows of the first micro-batch whose watermark, left by the
batch before, has reached it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class VisibleTtl(StatefulProcessor):
    """Counts a key's rows ``us, seq``; the count lives for ``ttl_us``."""

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long, written long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, written = self.count.get() if self.count.exists() else (0, None)
        for r in sorted(rows, key=lambda r: (r.us, r.seq)):
            found = "first" if written is None else "stale" if r.us - written > self.ttl else "live"
            n, written = n + 1, r.us
            yield Row(key=key[0], seq=r.seq, cnt=n, found=found)
        self.count.update((n, written))
        self.handle.registerTimer(-(-(written + self.ttl) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.count.exists() and -(-(self.count.get()[1] + self.ttl) // 1000) <= timerValues.getCurrentWatermarkInMs():
            self.count.clear()
        return iter(())

    def close(self) -> None:
        pass
