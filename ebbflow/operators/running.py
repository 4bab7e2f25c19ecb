"""Skew-safe running (prefix) aggregates: the batch form of keyed state.

A streaming job that keeps keyed state emits one running value per record
(running count, running max, previous record, ...). In batch the textbook
form is ``agg(...).over(Window.partitionBy(key).orderBy(seq))``. That is what
:func:`running` plans as long as no key has more than ``rows_per_chunk`` rows.
A key beyond that - or a keyless running value (global watermark, most active
user) over a large table - would be sorted by one task, so its rows are cut:

1. One count per key finds the hot keys. Only their rows get a *chunk*: the
   order column is cut at approximate quantiles of the hot rows; a value of it
   (or null) that alone has more rows than a chunk is cut by the next order
   column. Rows of all other keys stay in chunk 0 and are never looked at again.
   The driver holds at most :data:`MAX_CUTS` cuts of a column and the executors
   a broadcast of at most :data:`MAX_HOT` keys, whatever the input: beyond that
   chunks grow instead.
2. Running values inside each ``(key, chunk)`` with a window partitioned on
   both, and per ``(key, chunk)`` totals, both from one exchange of the rows:
   the key is held in one never-null struct, so window, totals and the join
   below agree on the partitioning.
3. An exclusive prefix over the chunk totals of each key (one row per
   non-empty chunk), joined back on ``(key, chunk)`` and combined.

Every aggregate offered is associative, which makes the combination exact:
both plans give the same rows, for every chunk size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.session import checkpointed

DEFAULT_ROWS_PER_CHUNK = 2_000_000
# Session setting that overrides the default chunk size for a whole job.
ROWS_PER_CHUNK_CONF = "ebbflow.running.rowsPerChunk"
#: Keys that are broadcast as hot, and cuts of the order column, at most.
MAX_HOT, MAX_CUTS = 100_000, 4096

_CHUNK = "_rc_chunk"
_KEY = "_rc_key"
HOT = "_rc_hot"


@dataclass(frozen=True)
class Run:
    """One running aggregate.

    kind: ``count`` | ``sum`` | ``max`` | ``min`` | ``first`` | ``last`` | ``lag``.
    ``first`` is the value of the key's first row, null or not; ``lag`` that of
    the row before, null or not (null for the first row); ``last`` the most
    recent value that is not null (on a column that is only set on some rows,
    an as-of lookup). Sums of integers are ``decimal(38,0)``, so they do not
    overflow. exclusive: the frame ends at the row before the current one.
    """

    kind: str
    col: str | Column | None = None
    exclusive: bool = False


def count(exclusive: bool = False) -> Run:
    return Run("count", None, exclusive)


def rsum(col, exclusive: bool = False) -> Run:
    return Run("sum", col, exclusive)


def rmax(col, exclusive: bool = False) -> Run:
    return Run("max", col, exclusive)


def rmin(col, exclusive: bool = False) -> Run:
    return Run("min", col, exclusive)


def first(col) -> Run:
    return Run("first", col, False)


def last(col, exclusive: bool = False) -> Run:
    return Run("last", col, exclusive)


def lag(col) -> Run:
    return Run("lag", col, True)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numeric(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("long")


def _chunk_size(df: DataFrame, rows_per_chunk: int) -> int:
    conf = df.sparkSession.conf.get(ROWS_PER_CHUNK_CONF, None)
    return int(conf) if conf and rows_per_chunk == DEFAULT_ROWS_PER_CHUNK else max(1, rows_per_chunk)


def _cut(num: Column, cuts: list[float]) -> Column:
    """Number of cuts at or below ``num``, -1 for null (nulls sort first)."""
    if not cuts:
        return F.when(num.isNull(), -1).otherwise(0)
    # a balanced tree of comparisons: as many as a binary search makes
    def branch(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(num < F.lit(cuts[mid]), branch(lo, mid)).otherwise(branch(mid + 1, hi))
    if len(cuts) <= 64:
        return F.when(num.isNull(), -1).otherwise(branch(0, len(cuts)))
    # more cuts: find the group of 64 first, then the place in it
    table = F.array(*[F.array(*map(F.lit, cuts[i:i + 64])) for i in range(0, len(cuts), 64)])
    group = F.size(F.filter(F.array(*map(F.lit, cuts[::64])), lambda c: c <= num)) - 1
    place = F.size(F.filter(F.get(table, F.greatest(group, F.lit(0))), lambda c: c <= num))
    return F.when(num.isNull(), -1).when(group < 0, 0).otherwise(group * 64 + place)


def _tied(hot: DataFrame, num: Column, tie: Column, cuts: list, size: int) -> tuple[list, DataFrame | None]:
    """Cuts that set apart each value of ``num`` that alone has more than
    ``size`` hot rows, and for each such value (null too) its cuts of ``tie``."""
    filled = hot.groupBy(_cut(num, cuts).alias("c")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * size)
    large = [r["c"] for r in filled.select("c").collect()]  # no more than there are cuts
    if not large:
        return cuts, None
    rows = hot.filter(_cut(num, cuts).isin(large)).select(num.alias("v"), tie.alias("t"))
    heavy = {r["v"]: r["n"] for r in rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size).collect()}
    if not heavy:
        return cuts, None
    most = max(heavy.values())
    probs = [i / math.ceil(most / size) for i in range(1, math.ceil(most / size))][:MAX_CUTS]
    kept = [v for v in heavy if v is not None]
    here = F.col("v").isin(kept) | (F.col("v").isNull() if None in heavy else F.lit(False))
    found = rows.filter(here).groupBy("v").agg(F.percentile_approx("t", probs, 10 * MAX_CUTS).alias("q"))
    table = checkpointed(found.select(F.col("v").alias("_rc_v"), F.array_distinct("q").alias("_rc_q")))
    return sorted({*cuts, *kept, *(v + 1 for v in kept)}), table


def chunked(df: DataFrame, by: list[str], num: Column, rows_per_chunk: int,
            out: str = _CHUNK, tie: Column | None = None) -> tuple[DataFrame, bool]:
    """``df`` with the chunk of each row (0 unless its key is hot) and a flag
    for rows of hot keys, and whether any key is hot. ``num`` orders the rows
    of a key, as a number, and ``tie`` those of equal ``num``."""
    size = _chunk_size(df, rows_per_chunk)
    if by:
        counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rc_n"))
        got = counts.agg(F.sum("_rc_n").alias("total"), F.max("_rc_n").alias("most")).first()
        if not got["total"] or got["most"] <= size:
            return df.withColumns({out: F.lit(0), HOT: F.lit(False)}), False
        size = max(size, math.ceil(got["total"] / MAX_HOT))
        keys = counts.filter(F.col("_rc_n") > size).select(*[F.col(k).alias(f"_rc_h{i}") for i, k in enumerate(by)])
        keys = F.broadcast(checkpointed(keys).withColumn(HOT, F.lit(True)))  # MAX_HOT rows at most
        same = [df[k].eqNullSafe(keys[f"_rc_h{i}"]) for i, k in enumerate(by)]
        marked = df.join(keys, on=same, how="left").drop(*[f"_rc_h{i}" for i in range(len(by))])
    else:
        marked = df.withColumn(HOT, F.lit(True))
    hot = marked.filter(F.col(HOT))
    n_hot = hot.count()
    n_chunks = min(MAX_CUTS, math.ceil(n_hot / size))
    if n_chunks <= 1:
        return df.withColumns({out: F.lit(0), HOT: F.lit(False)}), False
    probs = [i / n_chunks for i in range(1, n_chunks)]
    qs = hot.agg(F.percentile_approx(num, probs, 10 * MAX_CUTS).alias("q")).first()["q"] or []
    cuts = sorted({q for q in qs if q is not None})
    heavy = None
    if tie is not None:
        cuts, heavy = _tied(hot, num, tie, cuts, size)
    chunk = _cut(num, cuts).cast("long")
    if heavy is not None:  # a few rows: no more values than chunks
        marked = marked.withColumn("_rc_num", num)
        marked = marked.join(F.broadcast(heavy), F.col("_rc_num").eqNullSafe(F.col("_rc_v")), "left")
        below = F.size(F.filter("_rc_q", lambda c: c <= tie))
        chunk = chunk * F.lit(2 * MAX_CUTS) + F.when(F.col("_rc_q").isNull() | tie.isNull(), 0).otherwise(below)
    chunk = F.when(F.col(HOT), chunk).otherwise(F.lit(0).cast("long"))
    return marked.withColumns({out: chunk, HOT: F.coalesce(HOT, F.lit(False))}).drop("_rc_num", "_rc_v", "_rc_q"), True


def _over(r: Run, c: Column | None, is_long: bool, window) -> Column:
    """The running aggregate over one window, as the plain plan has it."""
    incl = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = window.rowsBetween(Window.unboundedPreceding, -1) if r.exclusive else incl
    if r.kind == "count":
        return F.count(F.lit(1)).over(frame)
    if r.kind == "sum":
        return F.sum(c.cast("decimal(38,0)") if is_long else c).over(frame)
    if r.kind in ("max", "min"):
        return (F.max if r.kind == "max" else F.min)(c).over(frame)
    if r.kind == "first":
        return F.first(F.struct(c.alias("v"))).over(incl)
    if r.kind == "lag":
        return F.lag(F.struct(c.alias("v")), 1).over(window)
    if r.kind == "last":
        return F.last(c, ignorenulls=True).over(frame)
    raise ValueError(f"unknown running aggregate {r.kind!r}")


def _total(r: Run, c: Column | None, is_long: bool, order_key: Column, descending: bool) -> Column:
    """What a chunk leaves to the chunks after it."""
    earliest, latest = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    if r.kind == "count":
        return F.count(F.lit(1))
    if r.kind == "sum":
        return F.sum(c.cast("decimal(38,0)") if is_long else c)
    if r.kind in ("max", "min"):
        return (F.max if r.kind == "max" else F.min)(c)
    if r.kind == "first":
        return earliest(F.struct(c.alias("v")), order_key)
    if r.kind == "lag":
        return latest(F.struct(c.alias("v")), order_key)
    return latest(c, F.when(c.isNotNull(), order_key))


def _prefix(r: Run, s: Column, before) -> Column:
    """The totals of all chunks before."""
    if r.kind in ("count", "sum"):
        return F.sum(s).over(before)
    if r.kind in ("max", "min"):
        return (F.max if r.kind == "max" else F.min)(s).over(before)
    if r.kind == "first":
        return F.first(s).over(before)
    return F.last(s, ignorenulls=True).over(before)


def _combined(r: Run, inner: Column, prefix: Column) -> Column:
    if r.kind == "count":
        return F.coalesce(prefix, F.lit(0)) + inner
    if r.kind == "sum":
        return F.when(prefix.isNull(), inner).when(inner.isNull(), prefix).otherwise(prefix + inner)
    if r.kind == "max":
        return F.greatest(prefix, inner)
    if r.kind == "min":
        return F.least(prefix, inner)
    if r.kind == "first":  # an earlier chunk's first row comes before this chunk's
        return F.coalesce(prefix, inner)["v"]
    if r.kind == "lag":    # null in here only on a chunk's first row
        return F.coalesce(inner, prefix)["v"]
    return F.coalesce(inner, prefix)


_LONGS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def tie_of(df: DataFrame, order: list[str]) -> Column | None:
    """The first of ``order`` as a number, if it is a whole number, time or date."""
    if not order:
        return None
    dtype = df.schema[order[0]].dataType
    whole = (*_LONGS, T.TimestampType, T.TimestampNTZType, T.DateType)
    return _numeric(F.col(order[0]), dtype) if isinstance(dtype, whole) else None


def running(df: DataFrame, by: list[str], order: list[str], aggs: dict[str, Run], *,
            descending: bool = False, chunk_on: str | Column | None = None,
            rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Append running aggregates ``aggs`` (name -> :class:`Run`) to ``df``.

    by: key columns (empty = one global sequence).
    order: columns giving a total order inside a key; ``descending`` runs
        from the last row to the first (suffix values, "next" lookups).
    chunk_on: numeric or timestamp expression, non-decreasing in ``order``;
        defaults to the first order column. Rows equal in it are cut by the
        next order column if that is a whole number, time or date.
    """
    if not order:
        raise ValueError("running() needs an order")
    chunk_src = _col(chunk_on if chunk_on is not None else order[0])
    num = _numeric(chunk_src, df.select(chunk_src.alias("_c")).schema[0].dataType)
    tie = tie_of(df, order if chunk_on is not None else order[1:])
    data, split = chunked(df, by, num, rows_per_chunk, tie=tie)
    direction = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    cols = {n: _col(r.col) if r.col is not None else None for n, r in aggs.items()}
    longs = {n: r.kind == "sum" and isinstance(df.select(cols[n].alias("_c")).schema[0].dataType, _LONGS)
             for n, r in aggs.items()}
    if not split:
        w = Window.partitionBy(*by).orderBy(*direction)
        plain = [(_over(r, cols[n], longs[n], w)["v"] if r.kind in ("first", "lag") else _over(r, cols[n], longs[n], w)).alias(n)
                 for n, r in aggs.items()]
        return df.select("*", *plain)

    # one never-null key, so that windows, totals and the join share a partitioning
    data = data.withColumn(_KEY, F.struct(*[F.col(k) for k in by]) if by else F.struct(F.lit(0)))
    w = Window.partitionBy(_KEY, _CHUNK).orderBy(*direction)
    inner = data.select("*", *[_over(r, cols[n], longs[n], w).alias(f"_in_{n}") for n, r in aggs.items()])
    order_key = F.struct(*[F.col(c) for c in order])
    totals = data.filter(HOT).groupBy(_KEY, _CHUNK).agg(*[_total(r, cols[n], longs[n], order_key, descending).alias(f"_s_{n}")
                                              for n, r in aggs.items()])
    wc = Window.partitionBy(_KEY).orderBy(F.col(_CHUNK).desc() if descending else F.col(_CHUNK).asc())
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        F.col(_KEY).alias("_pk"), F.col(_CHUNK).alias("_pc"), *[_prefix(r, F.col(f"_s_{n}"), before).alias(f"_p_{n}") for n, r in aggs.items()])
    joined = inner.join(prefix, (F.col(_KEY) == F.col("_pk")) & (F.col(_CHUNK) == F.col("_pc")), "left")
    return joined.select(*df.columns, *[_combined(r, F.col(f"_in_{n}"), F.col(f"_p_{n}")).alias(n) for n, r in aggs.items()])
