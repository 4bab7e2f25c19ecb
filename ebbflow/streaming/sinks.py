"""Streaming sinks: the buffered sink (S12) with operator-style list state kept
in the shared folder (G7), and several tables from one run (S13).

The buffered sink:

``foreachBatch`` receives micro-batch ``b``. The rows still pending after
batch ``b-1`` (a small table, fewer than ``n`` rows) are read back, the new
rows are numbered after them, every complete group of ``n`` is written to
``out/batch=b``, and the remainder becomes ``pending/batch=b``. Both writes
overwrite their folder, so a batch replayed after a failure produces the
same files: exactly once through the sink, like the snapshot/restore hooks
of the original. The tail shorter than ``n`` is never written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.operators import running as R
from ebbflow.session import work_dir
from ebbflow.streaming.runner import feed_all, run_batches


def buffered_writer(out: str, pending: str, seq: str, n: int, schema: T.StructType):
    state_schema = T.StructType(list(schema.fields) + [T.StructField("_pos", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id > 0:
            prev = spark.read.schema(state_schema).parquet(f"{pending}/batch={batch_id - 1}")
            base = spark.read.parquet(f"{pending}/meta={batch_id - 1}").first()["written"]
        else:
            prev = spark.createDataFrame([], state_schema)
            base = 0
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # counted, numbered and written
        try:
            carried, fresh = prev.count(), batch.count()
            numbered = R.running(batch.select(*schema.fieldNames()), [], [seq], {"_n": R.count()})
            numbered = numbered.select(*schema.fieldNames(),
                                       (F.col("_n") + F.lit(base + carried)).alias("_pos"))
            full = ((base + carried + fresh) // n) * n
            rows = prev.unionByName(numbered)
            (rows.filter(F.col("_pos") <= full)
                 .select(*schema.fieldNames(), ((F.col("_pos") - 1) / n).cast("long").alias("batch_no"))
                 .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))
            rows.filter(F.col("_pos") > full).write.mode("overwrite").parquet(f"{pending}/batch={batch_id}")
            spark.createDataFrame([(full,)], "written long").write.mode("overwrite").parquet(f"{pending}/meta={batch_id}")
        finally:
            batch.unpersist()

    return write


def run_buffered(replay, seq: str, n: int, name: str, with_pending: bool = False) -> DataFrame:
    """Buffered sink over a :class:`~ebbflow.streaming.sources.Replay` input, one
    range a micro-batch (pending rows carry over through the pending folder).
    ``with_pending`` also returns the rows that wait for a full group, without a
    ``batch_no``."""
    stream = replay.stream()
    spark = stream.sparkSession
    out = work_dir(spark, "stream-out", name)
    pending = work_dir(spark, "stream-state", name)
    batches: list[int] = []
    write = buffered_writer(out, pending, seq, n, stream.schema)

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        batches.append(batch_id)

    feed_all([replay])
    run_batches(stream, name, each)
    schema = T.StructType(list(stream.schema.fields) + [T.StructField("batch_no", T.LongType())])
    done = spark.read.schema(schema).parquet(out).select(*schema.fieldNames())
    if not with_pending or not batches:
        return done
    rest = spark.read.schema(stream.schema).parquet(f"{pending}/batch={max(batches)}")
    return done.unionByName(rest.withColumn("batch_no", F.lit(None).cast("long")))


class FanOut:
    """One run of a stream into several tables, each a batch at a time.

    ``outputs`` maps a table's name to what is taken of a micro-batch for it.
    Batch ``b`` overwrites ``<path>/<table>/batch=b`` in every table, then a
    marker ``<path>/_commits/b`` says that all of them are whole. A batch that
    failed between two tables is repeated by Spark under the same number and
    overwrites what it left; :meth:`read` sees marked batches only, so no table
    runs ahead of another."""

    def __init__(self, spark: SparkSession, path: str, outputs: dict[str, Callable[[DataFrame], DataFrame]], fmt: str = "parquet"):
        self.spark, self.path, self.outputs, self.fmt = spark, path, outputs, fmt

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read once, written to every table
        try:
            for name, pick in self.outputs.items():
                pick(batch).write.mode("overwrite").format(self.fmt).save(f"{self.path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()
        fs, marker = self._fs(f"{self.path}/_commits/{batch_id}")
        fs.create(marker, True).close()

    def committed(self) -> list[int]:
        fs, folder = self._fs(f"{self.path}/_commits")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The rows of all whole batches of a table."""
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(full).format(self.fmt).load(f"{self.path}/{name}").filter(F.col("batch").isin(batches)).drop("batch")


def run_fan_out(replays, stream: DataFrame, name: str, outputs: dict[str, Callable[[DataFrame], DataFrame]],
                fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables of one run over inputs of one range a micro-batch."""
    spark = stream.sparkSession
    sink = FanOut(spark, work_dir(spark, "stream-out", name), outputs, fmt)
    feed_all(replays)
    run_batches(stream, name, sink)
    empty = spark.createDataFrame([], stream.schema)
    return {t: sink.read(t, pick(empty).schema) for t, pick in outputs.items()}
