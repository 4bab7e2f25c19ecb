"""Buffered sink (S12, G7): rows are held and written in full groups of
``n``; a short tail stays pending (never written in batch; carried to the next
micro-batch in streaming, see :mod:`ebbflow.streaming.sinks`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators import running as R


def full_groups(df: DataFrame, seq: str, n: int, **kw) -> DataFrame:
    """Number rows by ``seq`` (chunked global running count), group every
    ``n`` consecutive rows into ``batch_no`` and keep only complete groups."""
    total = df.count()
    pos = R.running(df, [], [seq], {"_pos": R.count()}, **kw)
    full = (total // n) * n
    return (pos.filter(F.col("_pos") <= F.lit(full))
               .select(*df.columns, ((F.col("_pos") - 1) / n).cast("long").alias("batch_no")))
