"""Connected components of an edge table by alternating large and small stars.

Each round replaces neighbours by the smallest one around, first among the
larger and then among the smaller neighbours, until every edge points at its
component's smallest node. A round is two groupings (with partial minima, so a
hub is no hot key) and two joins; its result goes to the checkpoint folder, and
only a count and a sum of hashes come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.session import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) to (v, m): m the least of u and its neighbours; for
    ``large`` neighbours above u are moved, else u and those below it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        moved = (both.filter("v > u").join(least, "u")
                 .select("v", F.least("u", "m").alias("m")))
    else:
        down = both.filter("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (down.join(least, "u").select("v", "m")
                 .unionByName(least.select(F.col("u").alias("v"), "m")))
    return moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v; longs) that is not its
    component's smallest node."""
    now = checkpointed(edges.filter("u <> v")
                       .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        got = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if got["n"] == 0 or (got["n"], got["h"]) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = got["n"], got["h"]
        now = checkpointed(_star(_star(now, True), False))
