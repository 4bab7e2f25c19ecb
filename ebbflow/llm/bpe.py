"""Operator 3: byte-pair encoding and decoding in batched numpy merge rounds.

A task encodes many texts at once. Their pieces (see :mod:`pretoken`) are
looked up in a table of pieces met before; the new ones lie end to end in one
flat array of symbols. Each round finds every neighbouring pair's rank by
binary search over the sorted pair keys, takes each piece's lowest rank, and
merges all its occurrences from the left; pieces without a known pair leave
the array. Decoding gathers the bytes of all ids from one flat byte table.

Empty and null texts have no ids and decode to the empty text. Special
strings in a text become their special id, as the library does by default.
Rows are handled one by one, so equal rows, ties and null ids need no rule;
columns that the operator does not name are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import pretoken
from ebbflow.llm.common import code_points, ranges, slices, text_buffer

#: Bytes of text worked on at once inside a task.
BLOCK_BYTES = 1 << 20
#: Bytes of the pieces a task remembers; beyond that it starts afresh.
MEMORY_BYTES = 32 << 20
#: A piece longer than this is merged with a heap, as rounds would pass over
#: all its symbols once for each distinct pair.
LONG_PIECE = 4096

NO_RANK = np.int64(1) << 40


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the rest for code points from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge tables and byte strings of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, back = spec["model"], byte_symbols()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        tokens = [b""] * self.size
        for t, i in ids.items():
            tokens[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            tokens[i] = t.encode()
        self.token_bytes = tokens
        self.byte_id = np.zeros(256, np.int64)
        for c, b in back.items():
            self.byte_id[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        self.classes = pretoken.class_table(path)
        self.key = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (:data:`NO_RANK` if it is none) and its place."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK), at

    def _pair_ranks(self, sym: np.ndarray, of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place of the pairs that start at ``at``."""
        rank, place = np.full(len(at), NO_RANK), np.zeros(len(at), np.int64)
        ok = at + 1 < len(sym)
        ok[ok] = of[at[ok]] == of[at[ok] + 1]
        pair = at[ok]
        rank[ok], place[ok] = self.find(sym[pair], sym[pair + 1])
        return rank, place

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and how many each has."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        counts = np.ones(n, np.int64)
        done_ids: list[np.ndarray] = []
        done_of: list[np.ndarray] = []
        for i in np.flatnonzero(lengths > LONG_PIECE):
            got = self._heap_merge(pieces[i])
            done_ids.append(got)
            done_of.append(np.full(len(got), i))
        short = np.flatnonzero((lengths <= LONG_PIECE) & (lengths > 0))
        sym = self.byte_id[np.frombuffer(b"".join(pieces[i] for i in short), np.uint8)]
        of = np.repeat(short, lengths[short])
        rank, place = self._pair_ranks(sym, of, np.arange(len(sym)))
        while len(sym):
            heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sizes = np.diff(np.append(heads, len(sym)))
            best = np.minimum.reduceat(rank, heads)
            live = np.repeat(best < NO_RANK, sizes)
            if not live.all():
                done_ids.append(sym[~live])
                done_of.append(of[~live])
            # of overlapping hits (a a a) every other one merges, from the left
            at = np.flatnonzero(live & (rank == np.repeat(best, sizes)))
            if len(at):
                new_run = np.concatenate([[True], np.diff(at) != 1])
                in_run = np.arange(len(at)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
                at = at[in_run % 2 == 0]
                sym[at] = self.merged[place[at]]
                live[at + 1] = False
            moved = (np.cumsum(live) - 1)[at]
            sym, of, rank, place = sym[live], of[live], rank[live], place[live]
            # only pairs that a merged symbol is part of have changed
            stale = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            rank[stale], place[stale] = self._pair_ranks(sym, of, stale)
        if not done_ids:
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_of)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=n).astype(np.int64)
        return ids[order], counts

    def _heap_merge(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, position)."""
        sym = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, place = self.find(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(rank[i]), i, sym[i], sym[i + 1]) for i in np.flatnonzero(rank < NO_RANK).tolist()]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def look(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in known:
                r, p = self.find(np.array([a]), np.array([b]))
                known[a, b] = int(r[0]), int(p[0])
            return known[a, b]

        while heap:
            _, i, a, b = heapq.heappop(heap)
            if sym[i] != a or nxt[i] >= n or sym[nxt[i]] != b:
                continue
            j = nxt[i]
            sym[i], sym[j] = int(self.merged[look(a, b)[1]]), -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
                if (r := look(sym[i], sym[nxt[i]])[0]) < NO_RANK:
                    heapq.heappush(heap, (r, i, sym[i], sym[nxt[i]]))
            if prev[i] >= 0 and (r := look(sym[prev[i]], sym[i])[0]) < NO_RANK:
                heapq.heappush(heap, (r, prev[i], sym[prev[i]], sym[i]))
        return np.array([s for s in sym if s >= 0], np.int64)


class Ragged:
    """Rows of different lengths in one flat array that grows by doubling."""

    def __init__(self, dtype):
        self.flat, self.used = np.empty(1024, dtype), 0
        self.starts, self.lengths = np.empty(1024, np.int64), np.empty(1024, np.int64)
        self.n = 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        need, rows = self.used + len(values), self.n + len(lengths)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, 2 * need)
        if rows > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * rows), np.resize(self.lengths, 2 * rows)
        self.flat[self.used:need] = values
        self.starts[self.n:rows] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n:rows] = lengths
        self.used, self.n = need, rows

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[rows]
        return self.flat[ranges(self.starts[rows], lengths)], lengths


class PieceIndex(dict):
    """Gives each new piece the next number."""

    def __missing__(self, piece: bytes) -> int:
        self[piece] = n = len(self)
        return n


def split_special(raw: bytes, offsets: np.ndarray, special: Iterable[str]) -> tuple[np.ndarray, list[tuple[int, int, str]]]:
    """Segments between special strings: where segments start (bytes), and the
    special strings found as (start, end, string). A special string cannot
    span two texts."""
    found: list[tuple[int, int, str]] = []
    for s in special:
        b, at = s.encode(), raw.find(s.encode())
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(b) <= offsets[text + 1]:
                found.append((at, at + len(b), s))
                at = raw.find(b, at + len(b))
            else:
                at = raw.find(b, at + 1)
    edges = [x for a, b, _ in found for x in (a, b)]
    return np.unique(np.concatenate([offsets[:-1], np.array(edges, np.int64)])), sorted(found)


def piece_bounds(raw: bytes, offsets: np.ndarray, special: Iterable[str], classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, str]]]:
    """Byte positions at which pieces start, the end of the buffer last."""
    segments, found = split_special(raw, offsets, special)
    cp, starts, byte_at = code_points(raw, segments)
    starts = starts[starts < len(cp)]
    cut = pretoken.cuts(cp, starts, classes)
    bounds = np.append(byte_at[:-1][cut], len(raw))
    if found:  # a special string is one piece
        inside = np.zeros(len(bounds), bool)
        for a, b, _ in found:
            inside |= (bounds > a) & (bounds < b)
        bounds = bounds[~inside]
    return bounds, found


def pieces_of(raw: bytes, bounds: np.ndarray) -> Iterator[bytes]:
    cutters = bounds.tolist()
    return map(raw.__getitem__, map(slice, cutters, cutters[1:]))


class Encoder:
    """Encodes blocks of texts, remembering the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        lengths = np.fromiter(map(len, vocabulary.token_bytes), np.int64, vocabulary.size)
        self.bytes = Ragged(np.uint8)
        self.bytes.extend(np.frombuffer(b"".join(vocabulary.token_bytes), np.uint8), lengths)
        names = [f"{i},".encode() for i in range(vocabulary.size)]
        self.names = Ragged(np.uint8)
        self.names.extend(np.frombuffer(b"".join(names), np.uint8),
                          np.fromiter(map(len, names), np.int64, len(names)))
        self.forget()

    def forget(self) -> None:
        self.index, self.ids, self.held = PieceIndex(), Ragged(np.int32), 0

    def encode(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offset of each text's ids."""
        if self.held > MEMORY_BYTES:
            self.forget()
        bounds, found = piece_bounds(raw, offsets, self.v.special, self.v.classes)
        known, at = len(self.index), self.index
        rows = np.fromiter(map(at.__getitem__, pieces_of(raw, bounds)), np.int64, max(0, len(bounds) - 1))
        if len(at) > known:
            fresh = list(itertools.islice(at, known, None)) if known < 1000 else list(_tail(at, known))
            ids, counts = self.v.encode_pieces(fresh)
            self.ids.extend(ids, counts)
            self.held += sum(map(len, fresh)) + 120 * len(fresh)
        ids, counts = self.ids.gather(rows)
        if found:
            where = np.searchsorted(bounds, [a for a, _, _ in found])
            ids, counts = _put(ids, counts, where, np.array([self.v.special[s] for *_, s in found]))
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[np.searchsorted(bounds, offsets)] if len(rows) else np.zeros(len(offsets), np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all texts end to end, and the offset of each text."""
        flat, lengths = self.bytes.gather(ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return flat.tobytes(), ends[offsets]

    def listed(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Decimal ids, each with a comma after it, and each text's offset."""
        flat, lengths = self.names.gather(ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return flat.tobytes(), ends[offsets]


def _tail(index: dict, known: int) -> Iterator[bytes]:
    """Keys after the first ``known``, in order."""
    it = reversed(index)
    return reversed([next(it) for _ in range(len(index) - known)])


def _put(ids, counts, where, values):
    """Replace the ids of the pieces ``where`` by one value each."""
    starts = np.cumsum(counts) - counts
    keep = np.ones(len(ids), bool)
    keep[ranges(starts[where], counts[where])] = False
    keep[starts[where]] = True
    ids = ids.copy()
    ids[starts[where]] = values
    counts = counts.copy()
    counts[where] = 1
    return ids[keep], counts


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """This worker's encoder, kept from task to task (without its pieces)."""
    if vocabulary.key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.key] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.key]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Encode (and decode) every text: columns ``keep``, ``n_tokens``, and of
    ``outputs`` any of

    ``ids``             the token ids, array<int>
    ``decoded``         the decoded text
    ``ids_sha256``      hex digest of the decimal ids joined by commas
    ``decoded_sha256``  hex digest of the decoded text
    """
    kinds = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    columns = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    narrow = df.select(*columns, F.col(text).cast("string").alias("t"))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file, of fixed size
    schema = ", ".join([*(f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))),
                        "n_tokens bigint", *(f"{o} {kinds[o]}" for o in outputs)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        try:
            for whole in batches:
                for batch in slices(whole, "t", BLOCK_BYTES):
                    raw, offsets = text_buffer(batch.column("t"))
                    ids, at = enc.encode(raw, offsets)
                    n = batch.num_rows
                    out = [batch.column(f"k{i}") for i in range(len(keep))] + [pa.array(np.diff(at))]
                    names = [*(f"k{i}" for i in range(len(keep))), "n_tokens", *outputs]
                    if any(o.startswith("decoded") for o in outputs):
                        plain, ends = enc.decode(ids, at)
                    if "ids_sha256" in outputs:
                        listed, stops = enc.listed(ids, at)
                    for o in outputs:
                        if o == "ids":
                            out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)))
                        elif o == "decoded":
                            out.append(pa.array([plain[ends[i]:ends[i + 1]].decode("utf-8", "replace") for i in range(n)], pa.string()))
                        elif o == "ids_sha256":
                            out.append(pa.array([hashlib.sha256(listed[stops[i]:max(stops[i], stops[i + 1] - 1)]).hexdigest() for i in range(n)]))
                        else:
                            out.append(pa.array([_text_sha256(plain[ends[i]:ends[i + 1]]) for i in range(n)]))
                    yield pa.RecordBatch.from_arrays(out, names)
        finally:
            enc.forget()  # Spark keeps the worker, and its memory, for other operators' tasks

    done = narrow.mapInArrow(run, schema)
    return done.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def _text_sha256(raw: bytes) -> str:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "replace").encode()
    return hashlib.sha256(raw).hexdigest()
