"""Process-function style operators in batch form."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ebbflow.functions.time import duration_ms, epoch_us, interval
from ebbflow.operators.running import DEFAULT_ROWS_PER_CHUNK, HOT, chunked, last, rsum, running
from ebbflow.session import checkpointed


def with_task_index(df: DataFrame) -> DataFrame:
    """each record with the index of the task (partition) handling it."""
    return df.withColumn("task", F.spark_partition_id().cast("long"))


def distinct_timers(df: DataFrame, ts: str, delay) -> DataFrame:
    """one event-time timer per record at ``ts + delay``; timers with the
    same time collapse into one (partial distinct before the shuffle)."""
    return df.select((F.col(ts) + interval(delay)).alias("timer_ts")).distinct()


def periodic_counts(df: DataFrame, key: str, ts: str, period,
                    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """periodic PV per key.

    The first record of a key starts a period and sets a timer at ``ts +
    period``; when it fires it emits the key's *cumulative* record count
    (records with ``ts <= timer``) and clears only the timer, so the next
    record after the timer starts the next period.

    Keys of up to ``rows_per_chunk`` rows are scanned in order after one
    shuffle, holding a timer and a count from batch to batch. Keys beyond that
    (see :func:`ebbflow.operators.running.chunked`) would make one task walk
    them; their period starts are found by :func:`_chain`, which splits a key.

    Output: ``key``, ``timer_ts``, ``cnt``. Rows without a time are no records;
    a null key is a key.
    """
    rows = df.select(F.col(key), F.col(ts)).filter(F.col(ts).isNotNull())
    data, split = chunked(rows, [key], epoch_us(ts), rows_per_chunk, "_chunk")
    name = F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n"))
    data = data.drop("_chunk").withColumns({"_k": name, "_us": epoch_us(ts)})
    out = _scan(data.filter(~F.col(HOT)), key, duration_ms(period) * 1000)
    if split:
        out = out.unionByName(_chain(data.filter(HOT), key, duration_ms(period) * 1000))
    at = F.timestamp_micros("timer_us")
    return out.select(key, at.cast(df.schema[ts].dataType).alias("timer_ts"), "cnt")


def _scan(data: DataFrame, key: str, period_us: int) -> DataFrame:
    """Each key's timers and counts from its rows in order of time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, value, timer, seen = None, None, None, 0   # the key at work
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, us = batch.column("_k"), np.asarray(batch.column("_us"))
            names = np.asarray(keys.dictionary_encode().indices)
            edges = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(us)]]).tolist()
            values, timers, counts = [], [], []
            for a, b in zip(edges, edges[1:]):
                if keys[a].as_py() != name:
                    if timer is not None:
                        values.append(value), timers.append(timer), counts.append(seen)
                    name, value, timer, seen = keys[a].as_py(), batch.column(key)[a].as_py(), None, 0
                at = a
                while at < b:
                    if timer is None:
                        timer = int(us[at]) + period_us
                    at = a + int(np.searchsorted(us[a:b], timer, "right"))
                    if at < b:
                        values.append(value), timers.append(timer), counts.append(seen + at - a)
                        timer = None
                seen += b - a
            yield _timers(values, timers, counts)
        if timer is not None:
            yield _timers([value], [timer], [seen])

    kind = to_arrow_type(data.schema[key].dataType)

    def _timers(values, timers, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, kind), pa.array(timers, pa.int64()), pa.array(counts, pa.int64())],
                                          [key, "timer_us", "cnt"])

    return (data.select(key, "_k", "_us").repartition("_k").sortWithinPartitions("_k", "_us")
            .mapInArrow(run, f"{key} {data.schema[key].dataType.simpleString()}, timer_us long, cnt long"))


def _chain(data: DataFrame, key: str, period_us: int) -> DataFrame:
    """The same for keys that are too large for one task.

    Period starts form a chain ``s -> next(s) = first time > s + period``. Every
    distinct time gets its ``next`` and the count after its timer (one chunked
    descending scan); the chain from each key's first time is then found by
    pointer doubling, ``log2(span / period)`` equi-joins on the unique ``(key,
    time)``. Jump tables and marked sets are checkpointed.
    """
    nodes = data.groupBy("_k", "_us").agg(F.count(F.lit(1)).alias("_n"))
    # For a probe at t + period the scan has seen the nodes after it: next(t) is
    # the last of them, and their sum is what the timer does not count (probes
    # sort before nodes at a tie, so a node exactly there is not "after").
    none = F.lit(None).cast("long")
    probes = nodes.select("_k", (F.col("_us") + period_us).alias("_t"), F.lit(1).alias("_rank"), F.col("_us").alias("src"), none.alias("_n"))
    points = nodes.select("_k", F.col("_us").alias("_t"), F.lit(0).alias("_rank"), none.alias("src"), "_n")
    looked = running(probes.unionByName(points), ["_k"], ["_t", "_rank"],
                     {"dst": last(F.when(F.col("_rank") == 0, F.col("_t")), exclusive=True), "_after": rsum("_n")}, descending=True)
    first_jump = checkpointed(looked.filter(F.col("_rank") == 1).select(
        "_k", "src", "dst", F.coalesce(F.col("_after"), F.lit(0)).cast("long").alias("_after")))
    totals = data.groupBy("_k").agg(F.count(F.lit(1)).alias("_total"), F.first(key).alias(key))
    span = nodes.agg(F.min("_us").alias("lo"), F.max("_us").alias("hi")).first()
    levels = max(1, math.ceil(math.log2((span["hi"] - span["lo"]) // period_us + 2)))
    jumps = [first_jump.select("_k", "src", "dst")]
    for _ in range(1, levels):
        a, b = jumps[-1], jumps[-1].select(F.col("_k").alias("_k2"), F.col("src").alias("via"), F.col("dst").alias("far"))
        jumps.append(checkpointed(a.join(b, (F.col("_k") == F.col("_k2")) & (F.col("dst") == F.col("via")), "left")
                                  .select("_k", "src", F.col("far").alias("dst"))))
    marked = nodes.groupBy("_k").agg(F.min("_us").alias("src"))
    for j in reversed(jumps):
        reached = marked.join(j, ["_k", "src"]).filter(F.col("dst").isNotNull()).select("_k", F.col("dst").alias("src"))
        marked = checkpointed(marked.unionByName(reached))  # disjoint: odd and even multiples of the step
    return (marked.join(first_jump, ["_k", "src"]).join(totals, "_k")
            .select(key, (F.col("src") + period_us).alias("timer_us"), (F.col("_total") - F.col("_after")).alias("cnt")))
