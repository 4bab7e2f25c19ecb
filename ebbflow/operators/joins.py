"""Joins of keyed streams.

* J1 full-history connect join: an inner equi-join; the later arrival of each
  pair is the side that emits it.
* J2 interval join: same key, right time within ``[left + lower, left +
  upper]`` (both ends inclusive). Planned as an equi-join on ``(key, time
  bucket)`` so one busy key is spread over many buckets instead of one
  sort-merge task doing a quadratic range scan.
* J3 rule broadcast: ``(previous action, action)`` per key matched against a
  rule table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.time import duration_ms, epoch_us
from ebbflow.operators import running as R


def connect_join(left: DataFrame, right: DataFrame, key_l: str, key_r: str,
                 ts_l: str, ts_r: str, tag_l: str = "stream-1",
                 tag_r: str = "stream-2", extra_l: list[str] = (),
                 extra_r: list[str] = ()) -> DataFrame:
    """Every (left, right) pair with equal keys, emitted once by the later
    arrival as ``arriving => (key, stored ts)``. Arrival order is event time;
    on a tie the left stream is taken to arrive first."""
    l = left.select(F.col(key_l).alias("key"), F.col(ts_l).alias("_lts"),
                    *[F.col(c) for c in extra_l])
    r = right.select(F.col(key_r).alias("_rkey"), F.col(ts_r).alias("_rts"),
                     *[F.col(c) for c in extra_r])
    j = l.join(r, F.col("key") == F.col("_rkey"), "inner")
    right_later = F.col("_rts") >= F.col("_lts")
    return j.select(
        "key",
        F.when(right_later, F.lit(tag_r)).otherwise(F.lit(tag_l)).alias("emitted_by"),
        F.when(right_later, F.col("_rts")).otherwise(F.col("_lts")).alias("arriving_ts"),
        F.when(right_later, F.col("_lts")).otherwise(F.col("_rts")).alias("stored_ts"),
        *extra_l, *extra_r)


def interval_join(left: DataFrame, right: DataFrame, key: str, ts_l: str, ts_r: str,
                  lower, upper, bucket=None) -> DataFrame:
    """Inner join on ``key`` with ``ts_l + lower <= ts_r <= ts_l + upper``.

    Both inputs keep their own column names (they must not collide except for
    ``key``). ``bucket`` defaults to the interval length: each left row is
    sent to the (at most two) buckets its interval touches, each right row to
    its own bucket, and the exact bound is applied after the equi-join.
    """
    lo_us = duration_ms(lower) * 1000
    hi_us = duration_ms(upper) * 1000
    width = max(1, (duration_ms(bucket) * 1000) if bucket else (hi_us - lo_us) or 1)
    l_us = epoch_us(ts_l)
    first_b = F.floor((l_us + F.lit(lo_us)) / F.lit(width))
    last_b = F.floor((l_us + F.lit(hi_us)) / F.lit(width))
    l = (left.withColumn("_lb", F.explode(F.sequence(first_b.cast("long"), last_b.cast("long"))))
             .alias("_l"))
    r = (right.withColumnRenamed(key, "_rkey")
              .withColumn("_rb", F.floor(epoch_us(ts_r) / F.lit(width)).cast("long"))
              .alias("_r"))
    r_us = epoch_us(F.col(f"_r.{ts_r}"))
    l_ts_us = epoch_us(F.col(f"_l.{ts_l}"))
    cond = ((F.col(f"_l.{key}") == F.col("_r._rkey")) & (F.col("_l._lb") == F.col("_r._rb"))
            & (r_us >= l_ts_us + F.lit(lo_us)) & (r_us <= l_ts_us + F.lit(hi_us)))
    j = l.join(r, cond, "inner")
    keep_l = [F.col(f"_l.{c}") for c in left.columns]
    keep_r = [F.col(f"_r.{c}") for c in right.columns if c != key]
    return j.select(*keep_l, *keep_r)


def latest_rule(rules: DataFrame, seq: str) -> DataFrame:
    """Single-rule mode: only the most recently read rule is in force."""
    cols = [c for c in rules.columns if c != seq]
    top = rules.agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_r"))
    return top.select("_r.*")


def broadcast_rules(actions: DataFrame, rules: DataFrame, key: str, action: str, seq: str,
                    first_col: str = "action1", second_col: str = "action2") -> DataFrame:
    """Emit ``(key, seq, prev, action)`` where the key's previous action
    and this action equal a rule ``(first_col, second_col)``.

    The previous action per key is a chunked ``lag`` (no whole key in one
    task), null if that action was null. The rules are an ordinary join side:
    Spark broadcasts them if it measures them small.
    """
    prev = R.running(actions.select(key, seq, action), [key], [seq],
                     {"prev_action": R.lag(action)})
    r = rules.select(F.col(first_col).alias("_a1"), F.col(second_col).alias("_a2")).distinct()
    j = prev.join(r, (prev["prev_action"] == r["_a1"]) & (prev[action] == r["_a2"]), "inner")
    return j.select(key, seq, "prev_action", action)
