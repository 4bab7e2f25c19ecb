"""Operator 9: a quality classifier on supervised subword embeddings.

Words (runs without white space) and their character n-grams are hashed to
rows of an embedding table; of word pairs, those of a word and itself share one
row, which counts :data:`REPEAT_WEIGHT` times (stuttering texts show only
there). A document is the average of the rows of all its
features, and a softmax layer over that average gives the class. Table and
layer are learned together by stochastic gradient descent in numpy.

Learning uses at most ``SAMPLE`` labelled documents, chosen by the hash of
their id, and at most ``fitting.FIT_BYTES`` of their features (documented
bounds); features are extracted by Spark tasks and learned from in one, the
driver gets the model. Scoring is a map over all documents: as the
layer is linear, each feature has one number, and a document's score follows
from the mean of its features' numbers.

Empty, blank and null texts have no feature and get the score of the bias
alone. Rows are scored one by one; repeated rows get equal scores. A null id
is never held out nor learned from. Labels other than 0 and 1 are not used;
an id with both labels counts as 0. Without two classes to learn from, every
score is the smoothed share of label 1. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import operator
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import ranges, slices, text_buffer
from ebbflow.llm.fitting import fit_in_task, sample_of

#: Most labelled documents that are learned from.
SAMPLE = 6000
FOLDS = 5
BLOCK_BYTES = 1 << 20
MEMORY_BYTES = 24 << 20
#: The feature of a word that repeats the one before, and how often it counts.
REPEAT, REPEAT_WEIGHT = 0, 8


@dataclass(frozen=True)
class Settings:
    bits: int = 16        # log2 of the rows of the table
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 8
    rate: float = 4.0
    batch: int = 16
    seed: int = 7


@dataclass(frozen=True)
class Model:
    settings: Settings
    table: np.ndarray     # rows x dim
    layer: np.ndarray     # dim x 2
    bias: np.ndarray      # 2

    def weights(self) -> tuple[np.ndarray, float, str]:
        """Each feature's number, the bias, and a name for this model."""
        w = (self.table @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)
        return w, float(self.bias[1] - self.bias[0]), hashlib.sha256(w.tobytes()).hexdigest()


def held_out(doc_id) -> F.Column:
    """Whether a document's labels are kept apart: crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def word_features(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words end to end, and how many each has."""
    n = len(words)
    flat = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, n) + 2
    start = np.cumsum(size) - size
    top = np.uint64(64 - s.bits)
    own = np.fromiter(map(zlib.crc32, words), np.uint64, n)
    parts = [(own * np.uint64(0x9E3779B97F4A7C15)) >> top]
    owners = [np.arange(n)]
    for g in s.ngrams:
        many = np.maximum(0, size - g + 1)
        at = ranges(start, many)
        h = np.full(len(at), g, np.uint64)
        for k in range(g):
            h = (h + flat[at + k] + np.uint64(1)) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        parts.append((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> top)
        owners.append(np.repeat(np.arange(n), many))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order].astype(np.int64), np.bincount(owner, minlength=n)


def _block_words(raw: bytes, offsets: np.ndarray) -> Iterator[list[bytes]]:
    at = offsets.tolist()
    return (raw[a:b].split() for a, b in zip(at, at[1:]))


def features(df: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, label`` and each distinct feature of ``text`` with its share, packed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            idx, val = [], []
            for words in _block_words(raw, offsets):
                f = np.empty(0, np.int64)
                c = np.empty(0)
                if words:
                    distinct, times = np.unique(np.array(words, object), return_counts=True)
                    f, many = word_features(distinct.tolist(), s)
                    c = np.bincount(f, np.repeat(times, many), minlength=1 << s.bits)
                    c[REPEAT] += REPEAT_WEIGHT * sum(map(operator.eq, words, words[1:]))
                    f = np.flatnonzero(c)
                    c = c[f] / c.sum()
                idx.append(f.astype(np.int32).tobytes())
                val.append(c.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())],
                ["doc_id", "label", "idx", "val"])

    return df.select("doc_id", "label", "text").mapInArrow(
        run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, label int, idx binary, val binary")


def learn(idx: list[np.ndarray], val: list[np.ndarray], label: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent on the softmax loss over small batches."""
    rng = np.random.default_rng(s.seed)
    table = rng.uniform(-1 / s.dim, 1 / s.dim, (1 << s.bits, s.dim)).astype(np.float32)
    layer = np.zeros((s.dim, 2), np.float32)
    n, ones = len(label), int(label.sum())
    share = (ones + 1) / (n + 2)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    if ones in (0, n):
        return Model(s, table * 0, layer, bias)
    steps, total = 0, s.epochs * -(-n // s.batch)
    for _ in range(s.epochs):
        order = rng.permutation(n)
        for lo in range(0, n, s.batch):
            rate = np.float32(s.rate * (1 - steps / total))
            steps += 1
            rows = order[lo:lo + s.batch]
            f = np.concatenate([idx[r] for r in rows])
            v = np.concatenate([val[r] for r in rows])
            of = np.repeat(np.arange(len(rows)), [len(idx[r]) for r in rows])
            hidden = np.stack([np.bincount(of, table[f, j] * v, len(rows)) for j in range(s.dim)], 1).astype(np.float32)
            logit = hidden @ layer + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1  # the loss's gradient in the logits
            back = p @ layer.T
            layer -= rate * hidden.T @ p
            bias -= rate * p.sum(0) * np.float32(0.1)
            seen, where = np.unique(f, return_inverse=True)
            for j in range(s.dim):
                table[seen, j] -= rate * np.bincount(where, back[of, j] * v, len(seen)).astype(np.float32)
    return Model(s, table, layer, bias)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), sample: int = SAMPLE) -> Model:
    """Learn ``labels.quality`` (doc_id, quality) from the texts of ``docs``."""
    rows = features(sample_of(docs, labels, "quality", held_out("doc_id"), sample), settings)
    return fit_in_task(rows, lambda idx, val, label: learn(idx, val, label, settings))


class Scorer:
    """Scores blocks of texts, remembering the words it has met."""

    def __init__(self, weights: np.ndarray, bias: float, settings: Settings):
        self.w, self.bias, self.s = weights, bias, settings
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.value, self.count, self.held = np.empty(0), np.empty(0), 0

    def scores(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        if self.held > MEMORY_BYTES:
            self.forget()
        words = list(_block_words(raw, offsets))
        n = np.fromiter(map(len, words), np.int64, len(words))
        index, known = self.index, len(self.index)
        flat = [w for ws in words for w in ws]
        fresh = [w for w in set(flat) if w not in index]
        if fresh:
            index.update(zip(fresh, range(known, known + len(fresh))))
            f, many = word_features(fresh, self.s)
            ends = np.concatenate([[0], np.cumsum(many)])
            sums = np.concatenate([[0.0], np.cumsum(self.w[f])])
            self.value = np.concatenate([self.value, sums[ends[1:]] - sums[ends[:-1]]])
            self.count = np.concatenate([self.count, many])
            self.held += sum(map(len, fresh)) + 150 * len(fresh)
        at = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
        of = np.repeat(np.arange(len(n)), n)
        same = np.flatnonzero((at[1:] == at[:-1]) & (of[1:] == of[:-1])) + 1
        repeats = REPEAT_WEIGHT * np.bincount(of[same], minlength=len(n))
        total = np.bincount(of, self.value[at], len(n)) + repeats * self.w[REPEAT]
        count = np.bincount(of, self.count[at], len(n)) + repeats
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -500, 500)))


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``score``, the probability of label 1."""
    narrow = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{text}`").cast("string").alias("t"))
    schema = ", ".join([*(f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "score double"])
    weights, bias, _ = model.weights()
    shared = df.sparkSession.sparkContext.broadcast(weights)  # 2^bits numbers
    settings = model.settings

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, bias, settings)  # its words are forgotten with the task
        for whole in batches:
            for batch in slices(whole, "t", BLOCK_BYTES):
                got = scorer.scores(*text_buffer(batch.column("t")))
                yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))), pa.array(got)],
                                                 [*(f"k{i}" for i in range(len(keep))), "score"])

    return narrow.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})
