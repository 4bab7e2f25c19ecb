"""Starting a query from a retained checkpoint.

A checkpoint keeps the state of its latest batches. :func:`retained` lists them,
:func:`state_at` reads an operator's state as of one of them with Spark's state
reader, whether or not the query went on since, and :func:`resume_counts` starts
another query from it: the plan, its keys' processor and the number of state
partitions may all differ from those of the query that left the checkpoint, as
the state travels as rows. The checkpoint itself is only read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.streaming import blocks as B


def retained(spark: SparkSession, checkpoint: str) -> list[int]:
    """Batches that are committed in a checkpoint."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def state_at(spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0, variable: str | None = None) -> DataFrame:
    """``key, value`` structs of a stateful operator after ``batch`` (None: the
    last); ``variable`` names a state variable of a processor: a value, or a list
    of blocks, arrays of the fields of ``key`` and ``value``."""
    r = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        if batch not in retained(spark, checkpoint):
            raise ValueError(f"batch {batch} is not among those the checkpoint retains")
        r = r.option("batchId", batch)
    if variable:
        r = r.option("stateVarName", variable)
    got = r.load(checkpoint)
    if "list_element" in got.columns:  # keys and values of a part, in blocks
        fields = {side: got.select(f"list_element.{side}.*").columns for side in ("key", "value")}
        got = got.select(F.explode(F.arrays_zip(*[F.col(f"list_element.{side}.{c}").alias(f"{side}_{c}") for side, names in fields.items() for c in names])).alias("at"))
        got = got.select(*[F.struct(*[F.col(f"at.{side}_{c}").alias(c) for c in names]).alias(side) for side, names in fields.items()])
    return got.select("key", "value")


#: Distinct words of a task that are counted at once.
WORDS_AT_ONCE = 200_000


def _partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each word in a task; a word comes out again after so many others."""
    def added(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("times", "sum")]).select(["word", "times_sum"]).rename_columns(["word", "times"])

    held, fresh, waiting = None, [], 0
    for batch in batches:
        found = batch.column(0).value_counts()
        fresh.append(pa.table({"word": found.field("values").cast(pa.string()), "times": found.field("counts")}))
        waiting += len(found)
        if waiting >= WORDS_AT_ONCE:
            held, fresh, waiting = added([held, *fresh] if held is not None else fresh), [], 0
            if held.num_rows >= WORDS_AT_ONCE:
                yield from held.to_batches()
                held = None
    if held is not None or fresh:
        yield from added([held, *fresh] if held is not None else fresh).to_batches()


#: Words of a block of state.
WORDS_PER_BLOCK = 2_000


class CountFrom(StatefulProcessor):
    """Adds up the partial counts of a part's words, beginning with the counts
    that it starts from. The list state holds words and counts in blocks, which
    :func:`state_at` reads as rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getListState("count", "key struct<word: array<string>>, value struct<cnt: array<bigint>>")

    def _put(self, counts: dict) -> None:
        words, ns = list(counts), list(counts.values())
        self.count.put([((words[at:at + WORDS_PER_BLOCK],), (ns[at:at + WORDS_PER_BLOCK],)) for at in range(0, len(words), WORDS_PER_BLOCK)])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._put({w["word"]: w["cnt"] for w in initialState["words"]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, fresh = {}, {}
        if self.count.exists():
            for (words,), (counts,) in self.count.get():
                held.update(zip(words, counts))
        for r in rows:
            fresh[r["word"]] = fresh.get(r["word"], 0) + r["times"]
        for word, times in fresh.items():
            held[word] = n = held.get(word, 0) + times
            yield Row(word=word, cnt=n)
        self._put(held)

    def close(self) -> None:
        pass


def resume_counts(words: DataFrame, start: DataFrame, parts: int | None = None) -> DataFrame:
    """Running counts of the stream ``word`` that begin with the counts ``word,
    cnt`` of ``start``. Words are counted within each task first, so a frequent
    word sends a few rows a batch; words are dealt to ``parts`` (None: those of a
    small input)."""
    part = B.part_of(parts or B.part_count(words.sparkSession), "word").alias("part")
    begin = start.groupBy(part).agg(F.collect_list(F.struct("word", F.col("cnt").cast("long").alias("cnt"))).alias("words"))
    return words.select("word").mapInArrow(_partial, "word string, times long").withColumn("part", part).groupBy("part").transformWithState(
        CountFrom(), "word string, cnt long", "Update", "None", begin.groupBy("part"))
