"""Shared pieces: session set-up, table reading, ragged numpy helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import configure as _configure

#: Bytes of one Arrow batch handed to a Python worker, so that a run of very
#: long texts does not put thousands of them into one batch.
ARROW_BATCH_BYTES = 32 << 20

#: Words are maximal runs of anything but a blank, tab, line feed, vertical
#: tab, form feed or carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    _configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query of the driver contract."""
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text) -> F.Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- ragged arrays ----------------------------------------------------------

def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``concatenate([arange(s, s + n) ...])`` without a Python loop."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    base = np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
    return base + np.arange(total, dtype=np.int64)


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each i (0 if empty)."""
    c = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return c[offsets[1:]] - c[offsets[:-1]]


def text_buffer(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 bytes of a text column and the offset of each row (null: empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = data.slice(int(off[0]), int(off[-1] - off[0])).to_pybytes() if data is not None and n else b""  # this slice's bytes only
    return raw, off - off[0] if n else np.zeros(1, np.int64)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``max_bytes`` of ``column``
    each (a longer single row makes a run of its own)."""
    n = batch.num_rows
    if not n:
        return
    _, off = text_buffer(batch.column(column))
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def code_points(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a UTF-8 buffer; where each row starts, in code points;
    and the byte position of every code point (one more at the end)."""
    if raw.isascii():
        cp = np.frombuffer(raw, np.uint8).astype(np.uint32)
        return cp, offsets.astype(np.int64), np.arange(len(raw) + 1, dtype=np.int64)
    u8 = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((u8 & 0xC0) != 0x80)
    cp = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    byte_at = np.append(at, len(raw)).astype(np.int64)
    return cp, np.searchsorted(byte_at, offsets).astype(np.int64), byte_at


def sorted_groups(batches, key: str):
    """Groups of a partition sorted by ``key``: (value, {column: array}).
    A group may span batches; one group and one batch are held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and keys[a] != current:
                yield current, _columns(held)
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, _columns(held)


def _columns(held: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    t = pa.Table.from_batches(held)
    return {c: t.column(c).to_numpy() for c in t.column_names}


def row_key(df: DataFrame) -> F.Column:
    """A 64-bit digest of the whole row, the same in every run."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
