"""Keyed and global aggregations without windows.

The original jobs emit a running value per record; the last one per key is
the batch aggregate. Final forms are plain ``groupBy().agg()`` (partial +
final hash aggregate, so a hot key is pre-aggregated map-side). Running forms
go through :func:`ebbflow.operators.running.running`, which never hands a
whole key to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators import running as R


def keyed_max(df: DataFrame, key: str, value: str, seq: str, keep: list[str]) -> DataFrame:
    """A1 final: ``max(value)`` per key; the other fields stay those of the
    key's first record (only the aggregated field is replaced)."""
    return df.groupBy(key).agg(*[F.min_by(c, F.col(seq)).alias(c) for c in keep],
                               F.max(value).alias(value))


def running_keyed_max(df: DataFrame, key: str, value: str, seq: str, keep: list[str],
                      **kw) -> DataFrame:
    """A1 running: one output per record, first-record fields + running max."""
    aggs = {f"first_{c}": R.first(c) for c in keep}
    aggs[f"max_{value}"] = R.rmax(value)
    out = R.running(df.select(seq, key, value, *keep), [key], [seq], aggs, **kw)
    return out.select(seq, key, *[F.col(f"first_{c}").alias(c) for c in keep],
                      F.col(f"max_{value}").alias(value))


def reduce_count(df: DataFrame, key: str) -> DataFrame:
    """A2/A4 final: records per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def running_count(df: DataFrame, key: str, seq: str, **kw) -> DataFrame:
    """A2 running: the count after each record of the key."""
    return R.running(df.select(seq, key), [key], [seq], {"cnt": R.count()}, **kw)


def most_active(df: DataFrame, key: str, seq: str, **kw) -> DataFrame:
    """A3: running leader over A2's running counts.

    The reduce keeps the old leader only if its count is strictly larger, so
    ties go to the newer record: the leader is ``max(struct(cnt, seq))``.
    The global step has no key at all: beyond a chunk's rows it is cut.
    """
    counts = running_count(df, key, seq, **kw)
    lead = R.running(counts, [], [seq],
                     {"_lead": R.rmax(F.struct(F.col("cnt"), F.col(seq), F.col(key)))}, **kw)
    return lead.select(seq, F.col(f"_lead.{key}").alias(f"leader_{key}"),
                       F.col("_lead.cnt").alias("leader_cnt"))


def reducing_latest(df: DataFrame, key: str, seq: str, keep_first: list[str],
                    latest: str) -> DataFrame:
    """Reducing state that keeps the first record's fields and the
    timestamp of the latest *arriving* record (not the largest)."""
    return df.groupBy(key).agg(*[F.min_by(c, F.col(seq)).alias(c) for c in keep_first],
                               F.max_by(latest, F.col(seq)).alias(latest))


def subkey_counts(df: DataFrame, key: str, subkey: str) -> DataFrame:
    """Per-key counter map ``subkey -> n`` (as rows)."""
    return df.groupBy(key, subkey).agg(F.count(F.lit(1)).alias("cnt"))


def every_nth_mean(df: DataFrame, key: str, seq: str, value: str, n: int, **kw) -> DataFrame:
    """Every ``n``-th record of a key emits the mean of ``value`` over
    the key so far, with integer (long) division."""
    run = R.running(df.select(seq, key, value), [key], [seq],
                    {"rn": R.count(), "total": R.rsum(value)}, **kw)
    return (run.filter(F.col("rn") % n == 0)
               .select(key, seq, "rn",
                       F.expr("total div rn").cast("long").alias(f"avg_{value}")))


def labelled_count(df: DataFrame, key: str, seq: str, **kw) -> DataFrame:
    """Aggregating state rendered as text ``count：n`` after each record."""
    out = running_count(df, key, seq, **kw)
    return out.withColumn("label", F.concat(F.lit("count："), F.col("cnt").cast("string")))
