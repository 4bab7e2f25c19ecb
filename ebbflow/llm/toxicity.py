"""Operator 13: toxicity by subword bags averaged into a linear softmax.

A word is a run without white space, lower-cased, without punctuation at its
ends. Its bag holds the word itself and the character n-grams of ``<word>``,
each hashed to a row of an embedding table; the word's vector is the average of
its bag, the document's the average of its distinct words, a word that occurs c
times weighing 1 + ln c, so that stuttering cannot outweigh all else;
``NEUTRAL`` zero vectors enter every average, so that a single word does not
decide over a text of a few. A softmax layer over the average gives the class. Table and layer are learned jointly in numpy, with steps
scaled by each row's past gradients, as the telling words are few. A misspelt
word never seen shares most n-gram rows with the word it stands for.

Learning uses at most ``SAMPLE`` labelled documents, chosen by the hash of
their id, and at most ``fitting.FIT_BYTES`` of features (documented bounds); it
runs in one task. Scoring is a map over all whole texts: as the layer is linear,
a word has one number, and a score follows from the average of the words' numbers.

Null, empty and blank texts, and those of punctuation alone, have no word and
get the score of the bias. Rows are scored one by one, so repeated rows get
equal scores. A null id is neither held out nor learned from. Labels other than
0 and 1 are not used; an id with both counts as 0. Without two classes to learn
from every score is the smoothed share of label 1. Very long texts are split in
pieces and scored whole, by the counts of their words. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import ranges, slices
from ebbflow.llm.fitting import fit_in_task, sample_of

#: Most labelled documents that are learned from; one row in ``FOLDS`` is held out.
SAMPLE, FOLDS = 6000, 5
#: Bytes of texts scored at once; characters split at once; words remembered.
BLOCK_BYTES, PIECE_CHARS, WORDS_HELD = 4 << 20, 1 << 20, 400_000
#: Zero vectors in every average.
NEUTRAL = 8
_WORD = re.compile(r"\S+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass(frozen=True)
class Settings:
    bits: int = 17        # log2 of the rows of the table
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 6
    rate: float = 1.0
    batch: int = 32
    seed: int = 13


@dataclass(frozen=True)
class Model:
    settings: Settings
    table: np.ndarray     # rows x dim
    layer: np.ndarray     # dim x 2
    bias: np.ndarray      # 2

    def weights(self) -> tuple[np.ndarray, float, str]:
        """The number of each row of the table, the bias, and the model's name."""
        w = (self.table @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)
        return w, float(self.bias[1] - self.bias[0]), hashlib.sha256(w.tobytes()).hexdigest()


def held_out(doc_id) -> F.Column:
    """Whether a document's label is kept apart: crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def words_of(text: str | None) -> Iterator[list[str]]:
    """The words of a text, by pieces that end between words. A single run of
    more than a piece is one word."""
    text = text or ""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE_CHARS)
        while end < len(text) and not text[end].isspace():
            end += 1
        found = (_EDGE.sub("", w) for w in _WORD.findall(text[at:end].lower()))
        yield [w for w in found if w]
        at = end


def weights_of(text: str | None) -> dict[str, float]:
    """The distinct words of a text with their weights."""
    counts: Counter[str] = Counter()
    for piece in words_of(text):
        counts.update(piece)
    return {w: 1.0 if c == 1 else 1 + math.log(c) for w, c in counts.items()}


def bags(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words' bags end to end, and the size of each bag."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(size) - size
    shift = np.uint64(64 - s.bits)
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    rows, owner = [((whole + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> shift], [np.arange(len(words))]
    for g in s.ngrams:
        many = np.maximum(size - g + 1, 0)
        at = ranges(start, many)
        h = np.full(len(at), g * 7919, np.uint64)
        for k in range(g):
            h = (h ^ chars[at + k]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        rows.append((h * np.uint64(0xC4CEB9FE1A85EC53)) >> shift)
        owner.append(np.repeat(np.arange(len(words)), many))
    owner = np.concatenate(owner)
    return np.concatenate(rows)[np.argsort(owner, kind="stable")].astype(np.int64), np.bincount(owner, minlength=len(words))


def shares(text: str | None, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct table row of a text with its share of the average."""
    weight = weights_of(text)
    total = np.zeros(1 << s.bits)
    known = sorted(weight)
    for lo in range(0, len(known), 1 << 16):
        part = known[lo:lo + (1 << 16)]
        rows, size = bags(part, s)
        np.add.at(total, rows, np.repeat(np.fromiter(map(weight.__getitem__, part), np.float64, len(part)) / size, size))
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / (NEUTRAL + sum(weight.values()))).astype(np.float32)


def features(df: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, label`` and the packed :func:`shares` of ``text``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shares(t.as_py(), s) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *(pa.array([g[i].tobytes() for g in got], pa.binary()) for i in (0, 1))],
                ["doc_id", "label", "idx", "val"])

    return df.select("doc_id", "label", "text").mapInArrow(
        run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, label int, idx binary, val binary")


def learn(idx: list[np.ndarray], val: list[np.ndarray], label: np.ndarray, s: Settings) -> Model:
    """Table and layer together, by stochastic gradient descent on the softmax
    loss; a row's steps shrink with the root of its summed squared gradients."""
    rng = np.random.default_rng(s.seed)
    table = rng.normal(0, 0.1, (1 << s.bits, s.dim)).astype(np.float32)
    layer = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32)
    n, ones = len(label), int(label.sum())
    share = (ones + 1) / (n + 2)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    if ones in (0, n):
        return Model(s, table * 0, layer, bias)
    seen_rows, seen_layer, seen_bias = np.full(1 << s.bits, 1e-8, np.float32), 1e-10, 1e-10
    for _ in range(s.epochs):
        order = rng.permutation(n)
        for lo in range(0, n, s.batch):
            docs = order[lo:lo + s.batch]
            f, v = np.concatenate([idx[d] for d in docs]), np.concatenate([val[d] for d in docs])
            of = np.repeat(np.arange(len(docs)), [len(idx[d]) for d in docs])
            hidden = np.stack([np.bincount(of, table[f, j] * v, len(docs)) for j in range(s.dim)], 1).astype(np.float32)
            logit = hidden @ layer + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), label[docs]] -= 1
            p /= len(docs)  # gradient in the logits
            back = p @ layer.T
            g_layer, g_bias = hidden.T @ p, p.sum(0)
            rows, where = np.unique(f, return_inverse=True)
            g = np.stack([np.bincount(where, back[of, j] * v, len(rows)) for j in range(s.dim)], 1).astype(np.float32)
            seen_rows[rows] += (g * g).mean(1)
            table[rows] -= s.rate * g / np.sqrt(seen_rows[rows])[:, None]
            seen_layer += float((g_layer * g_layer).mean())
            layer = layer - np.float32(s.rate / np.sqrt(seen_layer)) * g_layer
            seen_bias += float((g_bias * g_bias).mean())
            bias = bias - np.float32(0.2 * s.rate / np.sqrt(seen_bias)) * g_bias
    return Model(s, table, layer, bias)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), sample: int = SAMPLE) -> Model:
    """Learn ``labels.toxic`` (doc_id, toxic) from the texts of ``docs``."""
    rows = features(sample_of(docs, labels, "toxic", held_out("doc_id"), sample), settings)
    return fit_in_task(rows, lambda idx, val, label: learn(idx, val, label, settings))


class Scorer:
    """Scores texts, remembering the numbers of the words it has met."""

    def __init__(self, weights: np.ndarray, bias: float, settings: Settings):
        self.w, self.bias, self.s = weights, bias, settings
        self.known: dict[str, float] = {}

    def numbers(self, words: list[str]) -> list[float]:
        """The numbers of distinct words."""
        known = self.known
        fresh = [w for w in words if w not in known]
        if fresh:
            if len(known) > WORDS_HELD:
                known.clear()
                fresh = words
            for lo in range(0, len(fresh), 1 << 16):
                part = fresh[lo:lo + (1 << 16)]
                rows, size = bags(part, self.s)
                sums = np.bincount(np.repeat(np.arange(len(part)), size), self.w[rows], len(part))
                known.update(zip(part, (sums / size).tolist()))
        return [known[w] for w in words]

    def score(self, text: str | None) -> float:
        weight = weights_of(text)
        total = math.fsum(map(operator.mul, self.numbers(list(weight)), weight.values()))
        logit = total / (NEUTRAL + math.fsum(weight.values())) + self.bias
        return 1 / (1 + math.exp(-min(max(logit, -500.0), 500.0)))


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``score``, the probability of label 1."""
    narrow = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("t"))
    names = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join([*(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in names), "score double"])
    weights, bias, _ = model.weights()
    shared = df.sparkSession.sparkContext.broadcast(weights)  # 2^bits numbers
    settings = model.settings

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, bias, settings)  # its words are forgotten with the task
        for whole in batches:
            for batch in slices(whole, "t", BLOCK_BYTES):
                got = pa.array([scorer.score(t.as_py()) for t in batch.column("t")], pa.float64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), got], [*names, "score"])

    return narrow.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))
