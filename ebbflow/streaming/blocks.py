"""Rows of many keys in one list state.

Every call of a processor and every read or write of state is a trip between
Spark and its Python worker, and so is every key. Keys are therefore dealt to
*parts* (:func:`part_of`), whose number follows the rows (:func:`part_count`);
the part is the grouping key, and its list states hold the rows of all its keys
in blocks: lists of values that JSON can hold. Trips then grow with the parts
and the blocks, not with the keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbflow.streaming.runner import state_partition_count

#: Schema of a list state of blocks, the rows of a block, and blocks a trip.
SCHEMA = "block string"
ROWS_PER_BLOCK, BLOCKS_PER_TRIP = 2_000, 200

#: Rows of a part, about; at least so many parts for each state partition.
ROWS_PER_PART, LEAST_PARTS = 50_000, 4


def part_count(spark, rows: int = 0) -> int:
    """Parts for an input of so many rows."""
    return max(LEAST_PARTS * state_partition_count(spark), -(-rows // ROWS_PER_PART))


def part_of(parts: int, *cols: str) -> Column:
    """The part of a key; null is a key like others."""
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("long")


def stored(state) -> Iterator[list]:
    """The rows of a list state, a block at a time in memory."""
    if state.exists():
        for (block,) in state.get():
            yield from json.loads(block)


def append(state, rows: Iterable) -> None:
    """Add rows to a list state."""
    rows = list(rows)
    packed = [(json.dumps(rows[at:at + ROWS_PER_BLOCK], separators=(",", ":")),) for at in range(0, len(rows), ROWS_PER_BLOCK)]
    for at in range(0, len(packed), BLOCKS_PER_TRIP):
        state.appendList(packed[at:at + BLOCKS_PER_TRIP])


def replace(state, rows: Iterable) -> None:
    """Leave these rows in a list state, and no others."""
    state.clear()
    append(state, rows)
