"""Event-sequence patterns per key.

A pattern is a small description object; it compiles to DataFrame
operations, not to an automaton of our own:

* strict contiguity (``next`` / ``times(n).consecutive()``): number the rows
  of each key in event-time order (chunked running count); each row votes
  for the match end positions its step conditions allow, and an end position
  with a vote from every step is a match. Positions are unique per key, so
  the ``(key, end)`` groups hold at most ``n`` rows and every match
  (overlapping ones included) is found once.
* relaxed contiguity with a time bound (``followedBy(...).within(t)``): each
  start row looks up the nearest later end row (a chunked as-of lookup in
  descending order); ``end - start < within`` is a match, anything else is a
  timeout (side output).
* state machines (C6): see :mod:`ebbflow.operators.state_machine`.

C7 (rows sorted by event time per key before matching) is the ``order``
argument: event time, then the arrival sequence as the tie-break.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.time import duration_ms, epoch_us
from ebbflow.operators import running as R


@dataclass(frozen=True)
class Step:
    name: str
    where: Column


@dataclass
class Pattern:
    """``Pattern.begin("a", cond).next("b", cond)...`` (strict steps) or
    ``begin(...).followed_by(...).within("15 minutes")`` (relaxed, two steps)."""

    steps: list[Step] = field(default_factory=list)
    relaxed: list[bool] = field(default_factory=list)
    window: str | int | None = None

    @staticmethod
    def begin(name: str, where: Column) -> Pattern:
        return Pattern([Step(name, where)], [False])

    def next(self, name: str, where: Column) -> Pattern:
        return Pattern(self.steps + [Step(name, where)], self.relaxed + [False], self.window)

    def followed_by(self, name: str, where: Column) -> Pattern:
        return Pattern(self.steps + [Step(name, where)], self.relaxed + [True], self.window)

    def times(self, n: int) -> Pattern:
        """``times(n).consecutive()`` of the last step."""
        last = self.steps[-1]
        extra = [Step(f"{last.name}{i}", last.where) for i in range(2, n + 1)]
        return Pattern(self.steps[:-1] + [Step(f"{last.name}1", last.where)] + extra,
                       self.relaxed + [False] * (n - 1), self.window)

    def within(self, spec) -> Pattern:
        return Pattern(self.steps, self.relaxed, spec)


def strict_matches(df: DataFrame, pattern: Pattern, key: str, order: list[str],
                   emit: list[str], **kw) -> DataFrame:
    """All matches of a strictly contiguous pattern.

    Output: ``key`` and, per step ``s`` and column ``c`` in ``emit``,
    ``{s}_{c}``. Overlapping matches are all kept (no-skip strategy).

    Rows are numbered per key (chunked running count). A row at position
    ``p`` that satisfies step ``i`` votes for a match ending at ``p + n - 1 -
    i``; a match is an end position that collects all ``n`` votes. That is
    one aggregation on ``(key, end)`` (at most ``n`` rows per group, partial
    aggregation before the shuffle) instead of ``n - 1`` joins.
    """
    if any(pattern.relaxed[1:]):
        raise ValueError("strict_matches handles next/consecutive steps only")
    n = len(pattern.steps)
    cols = list(dict.fromkeys([key, *order, *emit]))
    flags = [F.coalesce(s.where, F.lit(False)).alias(f"_ok{i}")
             for i, s in enumerate(pattern.steps)]
    base = df.select(*cols, *flags)
    any_ok = F.lit(False)
    for i in range(n):
        any_ok = any_ok | F.col(f"_ok{i}")
    numbered = R.running(base, [key], order, {"_pos": R.count()}, **kw).filter(any_ok)

    votes = F.array(*[F.struct(F.lit(i).alias("step"),
                               (F.col("_pos") + F.lit(n - 1 - i)).alias("end"),
                               F.col(f"_ok{i}").alias("ok")) for i in range(n)])
    cast = numbered.select(key, *emit, F.explode(F.filter(votes, lambda v: v["ok"])).alias("_v"))
    per_step = [F.max(F.when(F.col("_v.step") == F.lit(i), F.col(c))).alias(f"{s.name}_{c}")
                for i, s in enumerate(pattern.steps) for c in emit]
    ends = (cast.groupBy(key, F.col("_v.end").alias("_end"))
                .agg(F.count(F.lit(1)).alias("_votes"), *per_step))
    names = [f"{s.name}_{c}" for s in pattern.steps for c in emit]
    return ends.filter(F.col("_votes") == F.lit(n)).select(key, *names)


def followed_by_within(df: DataFrame, pattern: Pattern, key: str, ts: str, seq: str,
                       emit: list[str], **kw) -> DataFrame:
    """``begin(start).followed_by(end).within(t)`` with its timeout side
    output, as one DataFrame tagged ``status`` = ``matched`` | ``timeout``.

    Each start row takes the first end row after it (relaxed contiguity skips
    anything in between); it matches when ``end.ts - start.ts < within``.
    Every start row yields exactly one output row: matches + timeouts = starts.
    """
    if len(pattern.steps) != 2 or not pattern.relaxed[1] or pattern.window is None:
        raise ValueError("expected begin(...).followed_by(...).within(...)")
    start, end = pattern.steps
    cols = list(dict.fromkeys([key, ts, seq, *emit]))
    rows = df.select(*cols, start.where.alias("_is_start"), end.where.alias("_is_end")) \
             .filter(F.col("_is_start") | F.col("_is_end"))
    nxt = F.when(F.col("_is_end"), F.struct(*[F.col(c).alias(c) for c in dict.fromkeys([ts, *emit])]))
    looked = R.running(rows, [key], [ts, seq], {"_next": R.last(nxt, exclusive=True)},
                       descending=True, chunk_on=ts, **kw)
    within_us = duration_ms(pattern.window) * 1000
    gap = epoch_us(F.col(f"_next.{ts}")) - epoch_us(F.col(ts))
    matched = F.col("_next").isNotNull() & (gap < F.lit(within_us))
    starts = looked.filter(F.col("_is_start"))
    return starts.select(
        key,
        *[F.col(c).alias(f"{start.name}_{c}") for c in dict.fromkeys([ts, *emit])],
        *[F.when(matched, F.col(f"_next.{c}")).alias(f"{end.name}_{c}")
          for c in dict.fromkeys([ts, *emit])],
        F.when(matched, F.lit("matched")).otherwise(F.lit("timeout")).alias("status"))
