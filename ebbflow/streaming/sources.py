"""Streaming inputs: a table replayed as a directory of files.

A continuous line or socket source becomes ``readStream`` over a folder in
the shared scratch location. :class:`Replay` feeds a table in arrival ranges:
the table is staged once, partitioned by range, and each range is then written
to a sub-folder of the input by a normal parallel write. Every range has the
same number of files (a marker row in each file, dropped as the stream reads
it, makes that so whatever the range holds), and the stream takes so many files
a trigger: one running query meets one range in each micro-batch, in order,
with its watermark and state carried inside. A restart on the checkpoint goes
on with the next range. No range is ever funnelled into one file or one task.

Files are taken in the order of their times of change; the names of the
sub-folders decide where a store's clock is too coarse to tell ranges apart.

Bounded inputs end with a *flush* in the original jobs. Here the last file
can be a sentinel: one row far in the future whose watermark closes every
real window; its own window never closes, so append outputs never show it
(SURVEY P2). Non-window outputs must filter it by its time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.session import work_dir

SENTINEL_TS = datetime(2100, 1, 1)


def file_number(col: str, dtype, lo: int, hi: int, n_files: int) -> F.Column:
    """File of a row: ``(v - lo) * n // (hi - lo + 1)`` on the integer form of
    the order column (epoch microseconds for timestamps). The same formula in
    SQL reproduces the file boundaries exactly."""
    v = _as_int(F.col(col), dtype)
    return _div((v - F.lit(lo)) * F.lit(n_files), hi - lo + 1)


def _div(num: F.Column, den: int) -> F.Column:
    """Exact integer floor division of a non-negative long column."""
    q = (num / F.lit(den)).cast("long")          # close, may be off by one
    q = F.when(q * F.lit(den) > num, q - 1).otherwise(q)
    return F.when((q + 1) * F.lit(den) <= num, q + 1).otherwise(q)


def _as_int(c: F.Column, dtype) -> F.Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("long")


_RANGE = "_arrival_range"


#: Where results do not depend on the ranges: rows of a range at most, and
#: ranges at least. Rows and bytes of a file at most, about.
ROWS_PER_RANGE, LEAST_RANGES, ROWS_PER_FILE, BYTES_PER_FILE = 50_000_000, 3, 250_000, 32 << 20


def range_count(rows: int, at_least: int = LEAST_RANGES) -> int:
    return max(at_least, -(-rows // ROWS_PER_RANGE))


class Ranges(list):
    """The ranges of an input, the files each of them is written to, and the
    rows and bytes of all ranges (where they were counted)."""

    files, rows, bytes = 2, 0, 0

    def sized(self, rows: int, size: int) -> Ranges:
        """These ranges, with files for so many rows and bytes."""
        n = max(1, len(self))
        self.rows, self.bytes = rows, size
        self.files = max(2, -(-rows // n // ROWS_PER_FILE), -(-size // n // BYTES_PER_FILE))
        return self


def _size(df: DataFrame) -> list[F.Column]:
    """Rows of a table as ``n`` and, about, bytes as ``size``: of texts what they
    hold, of other columns eight."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in wide), F.lit(0).cast("long"))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(texts + F.lit(8 * (len(df.columns) - len(wide)))), F.lit(0)).alias("size")]


def arrival_ranges(df: DataFrame, order_col: str, ranges: int | None = None, even_rows: bool = True) -> Ranges:
    """Consecutive ranges of ``order_col``: ``ranges`` of them, or as many as the
    rows need (for queries whose results do not depend on the cuts).

    ``even_rows``: cut at approximate quantiles, so a burst is spread over
    ranges; else at even distances (:func:`file_number`), which SQL can repeat.
    Rows without an order value come first. The table is read twice, whatever
    the number of ranges: one job for statistics, one parallel write that stages
    it partitioned by range. Each range is then a partition-pruned read."""
    dtype = df.schema[order_col].dataType
    v = _as_int(F.col(order_col), dtype)
    got = df.agg(*_size(df), F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    if got["lo"] is None:
        return Ranges([df])
    n = ranges or range_count(got["n"])
    if even_rows:
        cuts = df.agg(F.percentile_approx(v, [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"] or [] if n > 1 else []
        number = sum((F.when(v > F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    else:
        number = file_number(order_col, dtype, got["lo"], got["hi"], n)
    return staged_ranges(df, F.coalesce(number, F.lit(0)), n, got)


def staged_ranges(df: DataFrame, number, n: int, size=None) -> Ranges:
    """``df`` staged once by the range numbers 0 to ``n`` - 1. ``size``: its rows
    ``n`` and bytes ``size``, where they are known."""
    spark = df.sparkSession
    size = size or df.agg(*_size(df)).first()
    stage = work_dir(spark, "stream-stage")
    (df.withColumn(_RANGE, number.cast("long"))
       .write.mode("overwrite").partitionBy(_RANGE).parquet(stage))
    schema = T.StructType([*df.schema.fields, T.StructField(_RANGE, T.LongType())])
    staged = spark.read.schema(schema).option("basePath", stage).parquet(stage)
    return Ranges(staged.filter(F.col(_RANGE) == F.lit(i)).select(*df.columns) for i in range(n)).sized(size["n"], size["size"])


def event_span_us(df: DataFrame, ts: str) -> int:
    """Microseconds from the first to the last event time (one job)."""
    us = _as_int(F.col(ts), df.schema[ts].dataType)
    got = df.agg((F.max(us) - F.min(us)).alias("span")).first()["span"]
    return got or 0


_MARK, _FILE = "_marker", "_file"


class Replay:
    """A table fed to a stream one arrival range a micro-batch (see module doc)."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, frames: list[DataFrame], fmt: str = "parquet"):
        self.spark, self.schema, self.frames, self.fmt = spark, schema, list(frames), fmt
        self.files, self.rows = getattr(frames, "files", Ranges.files), getattr(frames, "rows", 0)
        self.path = work_dir(spark, "stream-in", name)

    def stream(self) -> DataFrame:
        marked = T.StructType([*self.schema.fields, T.StructField(_MARK, T.BooleanType())])
        rows = read_stream(self.spark, f"{self.path}/*", marked, self.fmt, files_per_trigger=self.files)
        return rows.filter(~F.col(_MARK)).select(*self.schema.fieldNames())

    def feed(self, i: int) -> bool:
        """Write range ``i`` as exactly ``files`` files. Repeating it changes nothing."""
        if i >= len(self.frames):
            return False
        frame, n = self.frames[i], self.files
        deal = F.pmod(F.xxhash64(*frame.columns), F.lit(n)).cast("int")
        rows = frame.withColumns({_MARK: F.lit(False), _FILE: deal})
        marks = self.spark.range(n).select(F.lit(True).alias(_MARK), F.col("id").cast("int").alias(_FILE))
        (rows.unionByName(marks, allowMissingColumns=True).repartitionById(n, F.col(_FILE)).drop(_FILE)
             .write.mode("overwrite").format(self.fmt).save(f"{self.path}/r{i:06d}"))
        return True


def sentinel_frame(spark: SparkSession, row: dict, schema) -> DataFrame:
    """The flush input: one row whose event time is far in the future."""
    return spark.createDataFrame([row], schema)


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)
