"""Operator 7: shards of bounded size by extendible hashing.

A document's shard is the prefix of its key's hash that the directory names
for it. The directory starts with one bucket; only buckets over the byte limit
split, on the next bit, until all fit. A bucket is a shard if it fits and its
parent does not, which needs no splitting one by one: the bytes of every
prefix at every depth come from one grouping of cells, which are prefixes a few
bits longer than an even split would need. Only cells that are still too large
are looked at again, ``STEP`` bits deeper, with the rows that fall into them.

Equal keys have equal hashes, so 64 bits more are drawn for each row (fixed by
a checkpoint before use): a key that many rows share splits on these. After 128
bits, and for a single row above the limit, a shard stays ``oversize``.

The key is the id as text, a null id has the empty key; null and empty texts
have 0 bytes but a shard like others. An empty table has no shard. Extra
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.session import checkpointed

#: Bits below an even split at which cells are summed, and bits of a further look.
FINER, STEP = 4, 8
BITS = 128


def bits(hex16) -> F.Column:
    """The 64 bits of 16 hex digits."""
    return F.lpad(F.conv(hex16, 16, 2), 64, "0")


def path_of(doc_id: str) -> F.Column:
    """The 128 bits that a row is placed by; checkpoint before use."""
    own = bits(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 16))
    return F.concat(own, bits(F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0")))


def size_of(text: str) -> F.Column:
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")


def shards_between(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """Prefixes of ``low`` to ``high`` bits that fit ``limit`` while their
    parent (unless of fewer than ``low`` bits) does not, and all prefixes of
    ``high`` bits that do not fit: ``shard, depth, shard_bytes, shard_rows, fits``."""
    cells = rows.groupBy(F.substring("path", 1, high).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    every = cells.select(F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "cell", "b", "n")
    sums = (every.groupBy("depth", F.expr("substring(cell, 1, depth)").alias("shard"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")))
    # a parent's sum comes to its children: both halves carry the parent's name
    parent = sums.filter((F.col("shard_bytes") > limit) & (F.col("depth") < high)).select(
        (F.col("depth") + 1).alias("depth"), F.col("shard").alias("up"), F.lit(True).alias("split"))
    named = sums.withColumn("up", F.expr("substring(shard, 1, greatest(depth - 1, 0))")).join(parent, ["depth", "up"], "left")
    open_ = F.col("split").isNotNull() | (F.col("depth") == low)
    fits = F.col("shard_bytes") <= limit
    return (named.filter(open_ & (fits | (F.col("depth") == high)))
            .select("shard", "depth", "shard_bytes", "shard_rows", fits.alias("fits")))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """``shard, depth, shard_bytes, shard_rows, oversize``: the directory's
    buckets, named by their bits; together they hold every row once."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + FINER)
    done = None
    while True:
        found = checkpointed(shards_between(rows, limit, low, high))
        # a row alone cannot split
        stuck = ~F.col("fits") & ((F.col("shard_rows") == 1) | F.lit(high == BITS))
        part = found.filter(F.col("fits") | stuck).select("shard", "depth", "shard_bytes", "shard_rows", (~F.col("fits")).alias("oversize"))
        done = part if done is None else done.unionByName(part)
        rest = found.filter(~F.col("fits") & ~stuck).select(F.col("shard").alias("large"))
        if high == BITS or rest.isEmpty():
            return done
        rows = checkpointed(rows.withColumn("large", F.substring("path", 1, high)).join(rest, "large", "left_semi").drop("large"))
        low, high = high + 1, min(BITS, high + STEP)


def named(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` (with ``path``) and their bucket of the directory ``known``."""
    # a row meets the directory once for each depth that occurs
    depths = [r[0] for r in known.select("depth").distinct().orderBy("depth").collect()]  # BITS + 1 at most
    name = F.explode(F.array(*[F.substring("path", 1, d) for d in depths])) if depths else F.lit(None).cast("string")
    return rows.withColumn("_name", name).join(known, F.col("_name") == F.col("shard")).drop("_name")


def assign(df: DataFrame, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes, oversize`` of every row."""
    rows = checkpointed(df.select(F.col(doc_id).alias("id"), size_of(text).alias("n_bytes"), path_of(doc_id).alias("path")))
    return named(rows, checkpointed(directory(rows, limit))).select(
        F.col("id").alias(doc_id), "n_bytes", "shard", "depth", "shard_bytes", "oversize")


def write(df: DataFrame, limit: int, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write every row of ``df`` to a folder of its shard below ``path``; a
    shard's rows stand in one file, as a shard is bounded."""
    whole = checkpointed(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                                   size_of(text).alias("n_bytes"), path_of(doc_id).alias("path")))
    rows = whole.select("path", "n_bytes")
    shard = named(rows.select("path").distinct(), checkpointed(directory(rows, limit))).select(F.col("path").alias("_path"), "shard")
    (whole.join(shard, F.col("path") == F.col("_path")).select("shard", "row.*")
     .repartition("shard").write.partitionBy("shard").parquet(path))
