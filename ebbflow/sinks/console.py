"""Print sinks with a prefix.

:func:`print_sink` shows a stream on the driver's console or in a memory table,
each row with its ``tag``, as ``print("1")`` / ``print("2")`` do; for looking at
a few rows. :func:`printed` writes the printed lines themselves: several tagged
outputs of one query, each a set of text files written by the tasks, a batch at
a time with a commit marker, so a repeated batch prints nothing twice and
nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tagged(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(F.lit(prefix).alias("tag"), "*")


def print_sink(df: DataFrame, prefix: str, fmt: str = "console",
               query_name: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start a streaming print sink (``console``) or a ``memory`` table whose
    rows carry ``tag = prefix``. Batch DataFrames: use ``tagged(df).show()``."""
    w = tagged(df, prefix).writeStream.format(fmt).outputMode("append")
    if query_name:
        w = w.queryName(query_name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def lines(df: DataFrame, prefix: str) -> DataFrame:
    """One column ``value``: the prefix and the row's values, as they print.
    Nulls print as ``null``; line breaks inside a value are escaped."""
    shown = [F.coalesce(F.regexp_replace(F.regexp_replace(F.col(f"`{c}`").cast("string"), r"\\", r"\\\\"), "\n", r"\\n"), F.lit("null"))
             for c in df.columns]
    return df.select(F.concat(F.lit(f"{prefix}> ("), F.concat_ws(", ", *shown), F.lit(")")).alias("value"))


def printed(replays, stream: DataFrame, name: str, outputs: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Run a stream once and print several outputs of it, each under its prefix.
    Returns all printed lines as ``tag, line``."""
    from ebbflow.streaming.sinks import run_fan_out

    def line(tag, pick):
        return lambda df: lines(pick(df), tag)

    done = run_fan_out(replays, stream, name, {t: line(t, pick) for t, pick in outputs.items()}, fmt="text")
    parts = [df.select(F.lit(t).alias("tag"), F.col("value").alias("line")) for t, df in done.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
