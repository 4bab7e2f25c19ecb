"""Physical redistribution modes (K1-K7).

Each mode is one Spark exchange; nothing is moved by hand:

=========  ==========================================================
shuffle    random: ``repartition(n, rand(seed))``
rebalance  round robin: ``repartition(n)``
rescale    local round robin: ``coalesce`` when narrowing
broadcast  every record to every task: replicate ``n`` times with
           ``explode(sequence)`` and place copy ``i`` in partition ``i``
global     all records in one partition: ``repartition(1)``
custom     ``repartitionById(n, expr)``: partition = expr (key % n)
=========  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return df.repartition(n, F.rand(seed))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def rescale(df: DataFrame, n: int, wider: bool = False) -> DataFrame:
    """To ``n`` partitions, by joining neighbours unless ``wider``."""
    return df.repartition(n) if wider else df.coalesce(n)


def broadcast_all(df: DataFrame, n: int) -> DataFrame:
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col("_copy")).drop("_copy")


def global_one(df: DataFrame) -> DataFrame:
    """All rows in one partition (one task). Only for inputs with a size
    bound, such as per-category totals; never for raw events."""
    return df.repartition(1)


def custom(df: DataFrame, n: int, expr: Column) -> DataFrame:
    return df.repartitionById(n, expr)


def partition_report(df: DataFrame, key: str, category: str, n: int | None = None) -> DataFrame:
    """Rows after each mode. ``n`` partitions, the session's number by default.

    ``global`` and ``broadcast`` give one task, or every task, all rows. Both
    are for small tables, so they move the per-``category`` totals; the other
    modes move the raw rows.
    """
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    totals = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    modes = {
        "shuffle": (shuffle(df, n), 1),
        "rebalance": (rebalance(df, n), 1),
        "rescale": (rescale(rebalance(df, n), max(1, n // 2)), 1),
        "broadcast": (broadcast_all(totals, n), n),
        "global": (global_one(totals), 1),
        "custom": (custom(df, n, (F.pmod(F.col(key), F.lit(n))).cast("int")), 1),
    }
    parts = None
    for mode, (d, copies) in modes.items():
        per = (d.select(F.spark_partition_id().alias("p"))
                .groupBy("p").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(mode).alias("mode"), F.lit(copies).alias("copies"), "n"))
        parts = per if parts is None else parts.unionByName(per)
    # every task of the broadcast has all totals
    return parts.groupBy("mode", "copies").agg(F.sum("n").alias("n")).select(
        "mode", (F.col("n") / F.col("copies")).cast("long").alias("rows"))
