"""Running streaming queries to completion and reading their results.

* :func:`run_append` — file sink in append mode (exactly-once through the
  sink's commit log): every staged range is read, one per micro-batch, then the
  query stops.
* :func:`run_batches` — ``foreachBatch``; :func:`run_update` writes batch ``b``
  to ``<path>/batch=b`` with overwrite, so a batch replayed after a
  failure rewrites the same folder (idempotent). The final table is the
  latest row per key.
* Restart: pass the same ``checkpoint`` folder again; Spark resumes from the
  committed offsets and state (RocksDB state store, set in the session).
* :func:`replay_append` / :func:`replay_update` run :class:`Replay` inputs in
  one query; with ``restarts`` the query is stopped after every range and
  started again on its checkpoint.

The trigger is ``availableNow``, or the interval that the session setting
:data:`TRIGGER_CONF` names (T6): the watermark then moves at most that often.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.session import work_dir


#: Session setting: state partitions of a stream at its first start (they are
#: fixed in the checkpoint). Unset: the session's shuffle partitions, but no more
#: than four for each core there is, as each costs a task in every micro-batch.
STATE_PARTITIONS_CONF = "ebbflow.streaming.statePartitions"


def state_partition_count(spark) -> int:
    """State partitions of a stream that starts now."""
    told = spark.conf.get(STATE_PARTITIONS_CONF, None)
    return int(told) if told else min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


@contextlib.contextmanager
def state_partitions(spark, partitions: int | None = None):
    """Start a stateful query with ``partitions`` state partitions."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or state_partition_count(spark)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Session setting: time between micro-batches, as "200 milliseconds" (T6).
TRIGGER_CONF = "ebbflow.streaming.triggerInterval"


def finish(writer, until_caught_up: bool = False, partitions: int | None = None):
    """Start a query, let it take everything that is there, return it stopped.
    ``until_caught_up`` is for state in processing time (TTL), which otherwise
    keeps running cleanup-only batches."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    interval = spark.conf.get(TRIGGER_CONF, None)
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key, "true")
    with state_partitions(spark, partitions):
        if until_caught_up:
            spark.conf.set(key, "false")
        try:
            q = writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()
        finally:
            spark.conf.set(key, before)
    if interval:
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    else:
        q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def run_append(stream: DataFrame, name: str, checkpoint: str | None = None,
               out: str | None = None, fmt: str = "parquet",
               until_caught_up: bool = False) -> DataFrame:
    """Append-mode file sink over everything that is staged."""
    spark = stream.sparkSession
    out = out or work_dir(spark, "stream-out", name)
    checkpoint = checkpoint or work_dir(spark, "stream-ckpt", name)
    finish(stream.writeStream.outputMode("append").format(fmt)
           .option("path", out).option("checkpointLocation", checkpoint), until_caught_up)
    return spark.read.schema(stream.schema).format(fmt).load(out)


def run_batches(stream: DataFrame, name: str, each, checkpoint: str | None = None, mode: str = "append", partitions: int | None = None):
    """``foreachBatch`` over everything that is staged; ``each`` must give the
    same result when a batch is repeated."""
    checkpoint = checkpoint or work_dir(stream.sparkSession, "stream-ckpt", name)
    return finish(stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint),
                  partitions=partitions)


def feed_all(replays) -> int:
    """Stage every range of every input, range by range. Returns their number."""
    i = 0
    while any([r.feed(i) for r in replays]):
        i += 1
    return i


def _replayed(replays, restarts: bool, run_once) -> None:
    if not restarts:
        feed_all(replays)
        run_once()
        return
    i = 0
    while any([r.feed(i) for r in replays]):
        run_once()
        i += 1


def replay_append(replays, stream: DataFrame, name: str, out: str | None = None,
                  until_caught_up: bool = False, restarts: bool = False) -> DataFrame:
    """Append-mode run over inputs of one range a micro-batch."""
    spark = stream.sparkSession
    out = out or work_dir(spark, "stream-out", name)
    ckpt = work_dir(spark, "stream-ckpt", name)
    _replayed(replays, restarts, lambda: run_append(stream, name, checkpoint=ckpt, out=out, until_caught_up=until_caught_up))
    return spark.read.schema(stream.schema).parquet(out)


def replay_update(replays, stream: DataFrame, name: str, out: str | None = None, restarts: bool = False) -> str:
    """Update-mode run (``foreachBatch`` changelog) over inputs of one range a
    micro-batch; returns the changelog folder."""
    spark = stream.sparkSession
    out = out or work_dir(spark, "stream-out", name)
    ckpt = work_dir(spark, "stream-ckpt", name)
    _replayed(replays, restarts, lambda: run_update(stream, name, checkpoint=ckpt, out=out))
    return out


def batch_writer(path: str, fmt: str = "parquet"):
    """``foreachBatch`` function: one overwritten folder per ``batch_id``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")
    return write


def run_update(stream: DataFrame, name: str, checkpoint: str | None = None,
               out: str | None = None, mode: str = "update") -> str:
    """Run to completion in update (or complete) mode; return the batch folder."""
    out = out or work_dir(stream.sparkSession, "stream-out", name)
    run_batches(stream, name, batch_writer(out), checkpoint, mode)
    return out


def latest_per_key(spark, out: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """Final table of an update-mode changelog: per key, the row of the
    highest batch (partial + final aggregate, no sort per key)."""
    full = T.StructType(list(schema.fields) + [T.StructField("batch", T.LongType())])
    rows = spark.read.schema(full).parquet(out)
    vals = [c for c in schema.fieldNames() if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch")).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])
