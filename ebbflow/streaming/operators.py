"""Streaming forms of the window operators (W4/A12 UV, W6 top-N).

Spark has no exact ``count(DISTINCT)`` on a stream and no ``row_number``
outside time windows (SURVEY P3/P4), so both become chained aggregations,
which Structured Streaming runs in append mode with one watermark:

* UV: ``groupBy(window, user)`` then ``groupBy(window).count()``.
* top-N: count per (window, key); the n best of each (window, hash bucket of
  the key); the n best of these. A group holds counts of one bucket's keys, or
  n rows of every bucket, never raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators.windows import window_col


def stream_window_uv(events: DataFrame, ts: str, size, user: str) -> DataFrame:
    per_user = events.groupBy(window_col(ts, size).alias("window"), user).agg(
        F.count(F.lit(1)).alias("_n"))
    uv = per_user.groupBy("window").agg(F.count(user).alias("uv"))  # a null user is none, as in a distinct count
    return uv.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), "uv")


def stream_pv_per_uv(events: DataFrame, ts: str, size, slide, user: str) -> DataFrame:
    """Events per distinct user of each window (W2/A11): counts per (window,
    user), then their sum over their number."""
    per_user = events.groupBy(window_col(ts, size, slide).alias("window"), user).agg(F.count(F.lit(1)).alias("_n"))
    got = per_user.groupBy("window").agg(F.try_divide(F.sum("_n").cast("double"), F.count(user)).alias("pv_per_uv"))
    return got.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "pv_per_uv")


def stream_sliding_top_n(events: DataFrame, ts: str, size, slide, key: str, n: int,
                         buckets: int = 64) -> DataFrame:
    counts = events.groupBy(window_col(ts, size, slide).alias("window"), key).agg(
        F.count(F.lit(1)).alias("cnt"))
    entry = F.struct((-F.col("cnt")).alias("neg"), F.col(key).alias("k"))
    parts = counts.groupBy("window", F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("top"))
    ranked = parts.groupBy("window").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, n).alias("top"))
    out = ranked.select("window", F.posexplode("top").alias("pos", "e"))
    return out.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      F.col("e.k").alias(key), (-F.col("e.neg")).alias("cnt"),
                      (F.col("pos") + 1).cast("long").alias("rank"))
