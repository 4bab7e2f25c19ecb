"""Keyed finite-state machines over event sequences.

The transition table is data. Per key the machine is a left fold over the
key's rows in event-time order, and a fold over a *finite* state set
composes: a run of rows is a function ``state -> state``. That gives a
three-pass plan in which no task ever holds more than one chunk of one key:

1. Per ``(key, chunk)``: for each possible entry state, the state at the end
   of the chunk (a tiny int array per chunk).
2. Per key, over those summaries only (one row per non-empty chunk of the
   key): compose them in chunk order to get each chunk's true entry state.
3. Per ``(key, chunk)`` again: run the chunk from its entry state and emit
   the alert rows.

Each pass is ``repartition`` on the group columns, ``sortWithinPartitions``
and one ``mapInPandas`` over the sorted partition: Arrow batches, no
per-group Python call. Inside a batch the fold is a vectorised segmented
scan (Hillis-Steele doubling over the rows' transition arrays), and a group
that spans batches carries its composed function (or its state) into the
next batch, so memory per task is one batch, never one group.

Chunks are ranges of the order column sized from the row count (see
:mod:`ebbflow.operators.running`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators.running import DEFAULT_ROWS_PER_CHUNK, HOT, _numeric, chunked, tie_of


@dataclass(frozen=True)
class StateMachine:
    """initial: start state. transitions: ``{(state, event): next}``; an
    event with no entry sends the machine to ``initial``. A next state in
    ``emit`` outputs an alert and leaves the state unchanged; one in ``reset``
    sends the machine back to ``initial``."""

    initial: str
    transitions: dict
    emit: frozenset = frozenset()
    reset: frozenset = frozenset()

    def states(self) -> list[str]:
        held = {self.initial}
        for (s, _e), nxt in self.transitions.items():
            held.add(s)
            if nxt not in self.emit and nxt not in self.reset:
                held.add(nxt)
        return sorted(held, key=lambda x: (x != self.initial, x))

    def step(self, state: str, event: str) -> tuple[str, bool]:
        nxt = self.transitions.get((state, event), self.initial)
        if nxt in self.emit:
            return state, True
        if nxt in self.reset:
            return self.initial, False
        return nxt, False


# The login-failure machine of the original job.
# Initial --fail--> S1 --fail--> S2 --fail--> Matched (alert, stay in S2);
# success from any of them --> Terminal (back to Initial); any other event --> Initial.
LOGIN_FAILURE_MACHINE = StateMachine(
    initial="Initial",
    transitions={
        ("Initial", "fail"): "S1", ("Initial", "success"): "Terminal",
        ("S1", "fail"): "S2", ("S1", "success"): "Terminal",
        ("S2", "fail"): "Matched", ("S2", "success"): "Terminal",
    },
    emit=frozenset({"Matched"}),
    reset=frozenset({"Terminal"}),
)


def _tables(sm: StateMachine, events: list[str]):
    states = sm.states()
    sidx = {s: i for i, s in enumerate(states)}
    # next-state and emit tables over (event code, state code); last code = other event
    nxt = np.zeros((len(events) + 1, len(states)), dtype=np.int32)
    emit = np.zeros((len(events) + 1, len(states)), dtype=bool)
    for ei, e in enumerate(events + [None]):
        for s in states:
            n, out = sm.step(s, e) if e is not None else (sm.initial, False)
            nxt[ei, sidx[s]] = sidx[n]
            emit[ei, sidx[s]] = out
    return states, nxt, emit


def _segments(keys: list[np.ndarray]) -> np.ndarray:
    """Segment id per row for rows sorted by ``keys`` (a new id at each change)."""
    n = len(keys[0])
    change = np.zeros(n, dtype=bool)
    if n:
        change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.cumsum(change) - 1


def _compose_scan(seg: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Inclusive segmented prefix composition of row functions.

    ``f[i]`` maps state -> state (an int array). Row ``i`` of the result is
    ``f[i] o f[i-1] o ... o f[start of its segment]``.
    """
    cur = f.copy()
    n, d = len(seg), 1
    while d < n:
        same = seg[d:] == seg[:-d]
        if not same.any():
            break
        comp = np.take_along_axis(cur[d:], cur[:-d], axis=1)
        idx = np.nonzero(same)[0] + d
        cur[idx] = comp[same]
        d *= 2
    return cur


def _exclusive(seg: np.ndarray, incl: np.ndarray, identity: np.ndarray) -> np.ndarray:
    excl = np.empty_like(incl)
    excl[:] = identity
    if len(seg) > 1:
        same = seg[1:] == seg[:-1]
        excl[1:][same] = incl[:-1][same]
    return excl


def run_state_machine(df: DataFrame, sm: StateMachine, key: str, order: list[str],
                      event: str, emit_cols: list[str], *,
                      rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Rows at which ``sm`` emits, with ``key`` and ``emit_cols``."""
    events = sorted({e for (_s, e) in sm.transitions})
    states, nxt, emit = _tables(sm, events)
    n_states = len(states)
    identity = np.arange(n_states, dtype=np.int32)
    code = F.lit(len(events))
    for i, e in reversed(list(enumerate(events))):
        code = F.when(F.col(event) == F.lit(e), F.lit(i)).otherwise(code)

    num = _numeric(F.col(order[0]), df.schema[order[0]].dataType)
    out_cols = list(dict.fromkeys([key, *emit_cols]))
    cols = list(dict.fromkeys([key, *order, *emit_cols]))
    # a null key is a key like others: "n", while values have a "v" in front
    name = F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n"))
    data, split = chunked(df.select(*cols, code.cast("int").alias("_ev")), [key], num, rows_per_chunk, "_chunk",
                          tie_of(df, order[1:]))
    data = data.withColumns({"_k": name, "_chunk": F.col("_chunk").cast("int")})

    def sorted_by(frame: DataFrame, group: list[str], within: list[str]) -> DataFrame:
        return frame.repartition(*[F.col(g) for g in group]).sortWithinPartitions(*group, *within)

    # pass 1: function of each (key, chunk)
    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None  # (key, chunk, composed map)
        for pdf in batches:
            k = pdf["_k"].to_numpy()
            c = pdf["_chunk"].to_numpy()
            f = nxt[pdf["_ev"].to_numpy()]
            if carry is not None and len(k) and k[0] == carry[0] and c[0] == carry[1]:
                k = np.concatenate([[carry[0]], k])
                c = np.concatenate([[carry[1]], c])
                f = np.concatenate([carry[2][None, :], f])
            elif carry is not None and len(k):
                yield pd.DataFrame({"_k": [carry[0]], "_chunk": [carry[1]], "_map": [carry[2].tolist()]})
                carry = None
            if not len(k):
                continue
            seg = _segments([k, c])
            incl = _compose_scan(seg, f)
            ends = np.nonzero(np.r_[seg[1:] != seg[:-1], True])[0]
            done, last = ends[:-1], ends[-1]
            if len(done):
                yield pd.DataFrame({"_k": k[done], "_chunk": c[done],
                                    "_map": [m.tolist() for m in incl[done]]})
            carry = (k[last], c[last], incl[last])
        if carry is not None:
            yield pd.DataFrame({"_k": [carry[0]], "_chunk": [carry[1]], "_map": [carry[2].tolist()]})

    summary = sorted_by(data.filter(HOT), ["_k", "_chunk"], order).mapInPandas(
        summarize, "_k string, _chunk int, _map array<int>")

    # pass 2: entry state of each chunk = composition of the key's earlier chunks
    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None  # (key, composition of all chunks seen so far)
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf["_k"].to_numpy()
            c = pdf["_chunk"].to_numpy()
            f = np.array(pdf["_map"].tolist(), dtype=np.int32).reshape(len(pdf), n_states)
            pad = carry is not None and k[0] == carry[0]
            if pad:
                k = np.concatenate([[carry[0]], k])
                c = np.concatenate([[-1], c])
                f = np.concatenate([carry[1][None, :], f])
            seg = _segments([k])
            incl = _compose_scan(seg, f)
            entry = _exclusive(seg, incl, identity)[:, 0]
            carry = (k[-1], incl[-1])
            sl = slice(1, None) if pad else slice(None)
            yield pd.DataFrame({"_k": k[sl], "_chunk": c[sl], "_entry": entry[sl].astype(np.int32)})

    entry = sorted_by(summary, ["_k"], ["_chunk"]).mapInPandas(
        entries, "_k string, _chunk int, _entry int")

    # pass 3: run each chunk from its entry state, keep the emitting rows
    # (rows of keys that are not hot start in the initial state: no other pass sees them)
    start_state = states.index(sm.initial)
    if split:
        joined = data.join(entry, ["_k", "_chunk"], "left").withColumn("_entry", F.coalesce("_entry", F.lit(start_state)))
    else:
        joined = data.withColumn("_entry", F.lit(start_state))
    out_schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in out_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None  # (key, chunk, state after the last row seen)
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf["_k"].to_numpy()
            c = pdf["_chunk"].to_numpy()
            ev = pdf["_ev"].to_numpy()
            start = pdf["_entry"].to_numpy().astype(np.int32)
            if carry is not None:
                cont = (k == carry[0]) & (c == carry[1])
                start = np.where(cont, carry[2], start)
            seg = _segments([k, c])
            incl = _compose_scan(seg, nxt[ev])
            excl = _exclusive(seg, incl, identity)
            before = excl[np.arange(len(k)), start]
            hit = emit[ev, before]
            carry = (k[-1], c[-1], int(incl[-1][start[-1]]))
            if hit.any():
                yield pdf.loc[hit, out_cols]

    return sorted_by(joined.drop(HOT), ["_k", "_chunk"], order).mapInPandas(run, out_schema)
