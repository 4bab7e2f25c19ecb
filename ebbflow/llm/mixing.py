"""Operator 10: mix sources to target weights.

Every document gets a hash-random key. Within its source the documents stand
in key order; the running sum of their sizes is what the source's budget cuts.
Budgets above a source's size repeat it: whole epochs first, then the cut.

Keys are uniform, so their first 16 bits cut a source, however large, into
65,536 even ranges. One grouping sums the sizes by source and range, a window
over these sums (a bounded number per source) finds the range in which the
budget falls, and only the documents of those ranges are sorted. What a
document contributes then follows from its own key and its source's cut, so
documents are never shuffled, only joined with the table of sources.

Documents with equal keys (repeated rows) share what is cut from them in
proportion to size, rounded down. Null texts have size 0 and take 0. A null
source is a source of its own, the last one. Sources of size 0 have the
target 0. The order of ids plays no part, so null and repeated ids are fine.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import n_words
from ebbflow.session import checkpointed

#: Hex digits of a key that name its range: 16 bits.
RANGE_DIGITS = 4
#: Parts that a source's documents are dealt to when they meet the table of sources.
SALTS = 64


def targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Weights repeat over the sources by code point, null last. A target is
    ``min(level * weight, max_epochs * source_size)`` with the one level at
    which targets add up to all sizes; the level is found by sharing the excess
    of the capped sources again until none is capped anew, one aggregate a
    round."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = _ranked(sizes).withColumn("weight", weight.cast("double"))
    ranked = checkpointed(ranked.withColumn("cap", (max_epochs * F.col("source_size")).cast("double")))
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        capped = F.col("cap") < F.lit(level) * F.col("weight")
        s = ranked.agg(F.sum(F.when(capped, F.col("cap"))).alias("fixed"),
                       F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if not s["open"]:
            break
        higher = (total - (s["fixed"] or 0.0)) / s["open"]
        if higher <= level:
            break
        level = higher
    return ranked.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _ranked(sizes: DataFrame) -> DataFrame:
    """Adds ``rank``, the place of each source by code point, null last: ranges
    of sources are sorted apart, and the counts of the ranges before added."""
    spread = (sizes.repartitionByRange(F.col("source").asc_nulls_last())
              .withColumn("part", F.spark_partition_id()))
    spread = checkpointed(spread)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    count = spread.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = count.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return (spread.withColumn("inside", inside).join(before, "part")
            .select("source", "source_size", (F.col("before") + F.col("inside")).alias("rank")))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix",
        size: F.Column | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``size``, ``source_size``, ``target`` and ``taken``
    (the amount the mix takes of the document, repeats counted)."""
    content = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                          F.coalesce(F.col(text).cast("string"), F.lit("")))
    docs = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(source).alias("source"),
                     (n_words(F.col(text)) if size is None else size).alias("size"), F.md5(content).alias("key"))
    docs = checkpointed(docs) if not set(keep) & {text} else docs
    sums = checkpointed(docs.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("range"))
                        .agg(F.sum("size").alias("range_size")))
    goal = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    # whole epochs, and what is left for the cut
    goal = goal.withColumn("budget", F.round("target").cast("long")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    goal = checkpointed(goal)
    up_to = F.sum("range_size").over(Window.partitionBy("source").orderBy("range"))
    g = goal.select(F.col("source").alias("s"), "rest")
    crossing = (sums.withColumn("before", up_to - F.col("range_size"))
                .join(g, F.col("source").eqNullSafe(F.col("s")))
                .filter("before <= rest and rest < before + range_size")
                .select(F.col("s"), F.col("range").alias("r"), "before", "rest"))
    # only documents of the crossing ranges are sorted
    near = (docs.select("source", "key", "size", F.substring("key", 1, RANGE_DIGITS).alias("range"))
            .join(crossing, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
            .groupBy("source", "key", "before", "rest").agg(F.sum("size").alias("key_size")))
    key_up_to = F.col("before") + F.sum("key_size").over(Window.partitionBy("source").orderBy("key"))
    cut = (near.withColumn("key_before", key_up_to - F.col("key_size"))
           .filter("key_before <= rest and rest < key_before + key_size")
           .select(F.col("source").alias("s"), F.col("key").alias("cut_key"), "key_size",
                   (F.col("rest") - F.col("key_before")).alias("part")))
    goal = goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    # one source may hold most documents: they meet SALTS copies of its row
    goal = goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = docs.withColumn("part_no", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    out = salted.join(goal, F.col("source").eqNullSafe(F.col("s")) & (F.col("part_no") == F.col("salt")))
    # without a cut key the rest falls on the end of the source: everything or nothing is taken
    once = (F.when(F.col("cut_key").isNull(), 0).when(F.col("key") < F.col("cut_key"), F.col("size"))
            .when(F.col("key") == F.col("cut_key"), F.expr("part * size div key_size")).otherwise(0))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target",
                      (F.col("epochs") * F.col("size") + once).cast("long").alias("taken"))


def mixed(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, **names) -> DataFrame:
    """The mix as rows: each document of ``df`` as often as whole copies of it
    come nearest to what the mix takes (documents without words never)."""
    got = mix(df, weights=weights, max_epochs=max_epochs, keep=tuple(df.columns), **names)
    copies = F.when(F.col("_size") > 0, F.expr("(2 * _taken + _size) div (2 * _size)")).otherwise(F.lit(0))
    got = got.toDF(*df.columns, "_size", "_source_size", "_target", "_taken").withColumn("_copies", copies)
    return (got.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .select(*df.columns))
