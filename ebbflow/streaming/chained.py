"""Stateful operators that feed one another in one query: the running leader
(A3) and per-key state across windows (W8)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.operators.windows import window_col

LEADER = "seq long, id long, none boolean, cnt long"


class BucketLeader(StatefulProcessor):
    """The running counts of a bucket's keys (map state), and its leader: a row
    whose count reaches the leader's takes over, so ties go to the newer row.
    Only rows that take over come out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "id long, none boolean", "cnt long")
        self.best = handle.getValueState("best", "cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        counts: dict[tuple, int] = {}
        best = self.best.get()[0] if self.best.exists() else 0
        for r in sorted(rows, key=lambda r: r.seq):
            who = (r.id or 0, r.id is None)
            if who not in counts:
                counts[who] = self.counts.getValue(who)[0] if self.counts.containsKey(who) else 0
            counts[who] += 1
            if counts[who] >= best:
                best = counts[who]
                yield Row(seq=r.seq, id=who[0], none=who[1], cnt=best)
        for who, n in counts.items():
            self.counts.updateValue(who, (n,))
        self.best.update((best,))

    def close(self) -> None:
        pass


class LeaderOfLeaders(StatefulProcessor):
    """The leader among the rows that lead their buckets."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = self.best.get()[0] if self.best.exists() else 0
        for r in sorted(rows, key=lambda r: r.seq):
            if r.cnt >= best:
                best = r.cnt
                yield Row(seq=r.seq, id=r.id, none=r.none, cnt=best)
        self.best.update((best,))

    def close(self) -> None:
        pass


def leader_changes(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """Every change of the leader by running count of the stream ``seq, id``:
    ``seq, id, cnt``. Rows go to the bucket of their key; what meets in one task
    are the rows that led their bucket."""
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    leads = dealt.groupBy("bucket").transformWithState(BucketLeader(), LEADER, "Append", "None")
    top = leads.withColumn("all", F.lit(0)).groupBy("all").transformWithState(LeaderOfLeaders(), LEADER, "Append", "None")
    return top.select("seq", F.when(~F.col("none"), F.col("id")).alias("id"), "cnt")


class WindowSequence(StatefulProcessor):
    """Numbers a key's windows as they close (value state across windows)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.seen.get()[0] if self.seen.exists() else 0
        for r in sorted(rows, key=lambda r: r.window_start):
            n += 1
            yield Row(key=key[0], window_start=r.window_start, window_end=r.window_end, cnt=r.cnt, window_no=n)
        self.seen.update((n,))

    def close(self) -> None:
        pass


def window_sequence(events: DataFrame, ts: str, size, key: str, key_type: str = "long") -> DataFrame:
    """Each tumbling window of a key with its count and its number among the
    key's windows. A window aggregate feeds a processor; windows leave the
    aggregate in order of time, as the watermark passes them."""
    counts = events.groupBy(window_col(ts, size).alias("w"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    rows = counts.select("key", "cnt", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    return rows.groupBy("key").transformWithState(
        WindowSequence(), f"key {key_type}, window_start timestamp, window_end timestamp, cnt long, window_no long", "Append", "EventTime",
        eventTimeColumnName="window_end")
