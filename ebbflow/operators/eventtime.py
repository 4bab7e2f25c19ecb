"""Watermarks, allowed lateness and the late-row side output.

Batch form of a per-record watermark: rows are read in *arrival* order; the
watermark a row meets is ``max(event time of rows that arrived before it) -
bound``. A tumbling window ``[start, end)`` has fired once that watermark
reaches ``end`` (the ``wm >= end - 1`` rule with ``wm = max - bound - 1``);
it is purged once it reaches ``end + lateness``.

The running max over the global arrival order goes through the chunked
:func:`ebbflow.operators.running.running` (keyless, so a plain window would
run on one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.time import duration_ms, epoch_us, interval
from ebbflow.operators import running as R
from ebbflow.operators.windows import window_col

ON_TIME = "on_time"
LATE_UPDATE = "late_update"   # window already fired, still within lateness: re-fires
DROPPED = "late"              # past end + lateness: side output


def _interval_us(spec) -> F.Column:
    return F.lit(duration_ms(spec) * 1000)


def with_watermark_trace(df: DataFrame, ts: str, arrival: list[str], bound, **kw) -> DataFrame:
    """Add ``watermark`` = (max event time of earlier arrivals) - bound.

    Null for the first arrival (no watermark yet). Same type as ``ts``.
    """
    run = R.running(df, [], arrival, {"_max_before": R.rmax(ts, exclusive=True)}, **kw)
    wm = F.col("_max_before") - interval(bound)
    return run.withColumn("watermark", wm.cast(df.schema[ts].dataType)).drop("_max_before")


def tag_lateness(df: DataFrame, ts: str, arrival: list[str], size, bound, lateness,
                 **kw) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``status``.

    status is ``on_time`` (window still open), ``late_update`` (window fired,
    row within the allowed lateness: the window re-fires with it) or ``late``
    (window purged: side output).
    """
    traced = with_watermark_trace(df, ts, arrival, bound, **kw)
    w = window_col(ts, size)
    traced = traced.withColumn("_w", w)
    wm_us = epoch_us("watermark")
    end_us = epoch_us(F.col("_w.end"))
    status = (F.when(F.col("watermark").isNull() | (wm_us < end_us), F.lit(ON_TIME))
               .when(wm_us < end_us + _interval_us(lateness), F.lit(LATE_UPDATE))
               .otherwise(F.lit(DROPPED)))
    return (traced.withColumn("status", status)
                  .withColumn("window_start", F.col("_w.start"))
                  .withColumn("window_end", F.col("_w.end"))
                  .drop("_w"))


def late_main(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """The final count per (key, window) after every re-firing, i.e. over
    the rows that were not dropped; ``late_rows`` counts the re-firings."""
    kept = tagged.filter(F.col("status") != F.lit(DROPPED))
    return kept.groupBy(*keys, "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.when(F.col("status") == F.lit(LATE_UPDATE), 1).otherwise(0))
         .cast("long").alias("late_rows"))


def late_side(tagged: DataFrame) -> DataFrame:
    """The rows that reached a purged window."""
    return tagged.filter(F.col("status") == F.lit(DROPPED)).drop("status")
