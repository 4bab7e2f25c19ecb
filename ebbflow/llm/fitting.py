"""Fitting a model in one task.

The classifiers learn from a bounded sample. Its feature rows go to one Spark
task, in a fixed order; the driver gets the fitted model alone. What the task
holds is bounded in rows and in bytes: it takes rows in their order until
``max_bytes`` of features are held, so that very long texts cannot fill it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of features that are learned from at most.
FIT_BYTES = 192 << 20


def sample_of(docs: DataFrame, labels: DataFrame, target: str, held_out: F.Column, sample: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``sample`` labelled documents that are
    not held out, those of the smallest hashes of their ids. Labels other than 0
    and 1 are not used; an id with both counts as 0, of several texts of an id
    the smallest is taken."""
    known = (labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out)
             .groupBy("doc_id").agg(F.min(target).cast("int").alias("label")))
    # chosen among the labels of documents that are there
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
             .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers
             .select("doc_id", "label", "text"))
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit_in_task(rows: DataFrame, fit: Callable, max_bytes: int = FIT_BYTES):
    """``fit(idx, val, label)`` over the rows ``doc_id, label, idx, val`` (packed
    int32 and float32), called in one task. Returns its (picklable) result."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for label, idx, val in zip(*(batch.column(c).to_pylist() for c in ("label", "idx", "val"))):
                size += len(idx) + len(val)
                if size <= max_bytes:
                    held.append((label, idx, val))
        held.sort()  # equal rows of different ids stand in no fixed order
        model = fit([np.frombuffer(r[1], np.int32) for r in held], [np.frombuffer(r[2], np.float32) for r in held],
                    np.array([r[0] for r in held], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label").select("label", "idx", "val")
    got = one.mapInArrow(run, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([], [], np.empty(0, np.int64))  # no rows, no task
