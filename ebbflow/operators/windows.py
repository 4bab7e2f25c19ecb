"""Event-time windows (W1-W9), aligned to the epoch with no offset.

Incremental and full-window aggregates give the same values; in Spark both
are declarative ``groupBy(window(...))`` aggregates with partial aggregation
before the shuffle. Sliding windows multiply each row by ``size / slide``
before the partial aggregate, never after a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions.time import duration_ms, epoch_ms, from_epoch_ms
from ebbflow.operators import running as R


def _interval(spec) -> str:
    return f"{duration_ms(spec)} milliseconds"


def window_col(ts: str | Column, size, slide=None) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    if slide is None or duration_ms(slide) == duration_ms(size):
        return F.window(ts, _interval(size))
    return F.window(ts, _interval(size), _interval(slide))


def window_agg(df: DataFrame, ts: str, size, slide=None, keys: list[str] = (),
               aggs: list[Column] = ()) -> DataFrame:
    """Group by (window, keys) and aggregate; window start/end become columns."""
    g = df.groupBy(window_col(ts, size, slide).alias("_w"), *keys).agg(*aggs)
    return g.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("_w", *keys)])


def window_count(df: DataFrame, ts: str, size, slide=None, keys: list[str] = ()) -> DataFrame:
    """W1 (tumbling), W5 (sliding): records per window and key."""
    return window_agg(df, ts, size, slide, keys, [F.count(F.lit(1)).alias("cnt")])


def window_uv(df: DataFrame, ts: str, size, user: str, slide=None) -> DataFrame:
    """W3/W4 (A12): exact distinct users per window.

    Spark plans a single ``count(DISTINCT)`` as two aggregations: first on
    (window, user), then a count per window, so a window holding most users
    is still pre-aggregated before its final task.
    """
    return window_agg(df, ts, size, slide, [], [F.count_distinct(user).alias("uv")])


def window_pv_per_uv(df: DataFrame, ts: str, size, slide, user: str) -> DataFrame:
    """W2 (A11): events per distinct user per window, as a double."""
    return window_agg(df, ts, size, slide, [],
                      [(F.count(F.lit(1)) / F.count_distinct(user)).cast("double").alias("pv_per_uv")])


def top_n(counts: DataFrame, n: int, by: list[str], score: str, tie: list[str]) -> DataFrame:
    """W6 (A14, F8): top ``n`` rows of each group by ``score`` desc, ties by
    ``tie`` ascending; ``rank`` starts at 1. Groups shorter than ``n`` give
    fewer rows. Spark pushes ``rank <= n`` into a WindowGroupLimit before the
    window's sort, and the input is already one row per (window, key)."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tie])
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= n)
                  .withColumn("rank", F.col("rank").cast("long")))


def sliding_top_n(df: DataFrame, ts: str, size, slide, key: str, n: int) -> DataFrame:
    """Two-level top-N: count per (window, key), then rank per window."""
    counts = window_count(df, ts, size, slide, [key])
    return top_n(counts, n, ["window_start", "window_end"], "cnt", [key])


def window_sequence(df: DataFrame, ts: str, size, user: str, **kw) -> DataFrame:
    """W8 (re-aimed): per user, each tumbling window with its count and how
    many windows the user has had so far (1 for the first).

    The per-user numbering runs over the aggregated (user, window) rows with
    the chunked running count, so a user active in every window is still
    split across tasks.
    """
    counts = window_count(df, ts, size, None, [user])
    seq = R.running(counts, [user], ["window_start"], {"window_no": R.count()}, **kw)
    return seq.select(user, "window_start", "window_end", "cnt", "window_no")


def manual_window(df: DataFrame, ts: str, size, key: str) -> DataFrame:
    """The hand-built tumbling window: start = ms div size * size,
    end = start + size, count per (key, start). Equal to W1 by construction."""
    size_ms = duration_ms(size)
    ms = epoch_ms(ts)
    start = (F.floor(ms / F.lit(size_ms)) * F.lit(size_ms)).cast("long")
    g = df.groupBy(key, start.alias("_start")).agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(from_epoch_ms(F.col("_start")).alias("window_start"),
                    from_epoch_ms(F.col("_start") + F.lit(size_ms)).alias("window_end"),
                    key, "cnt")
