"""Operator 4: token counts by finite-state transducers.

Two deterministic transducers are composed, and only counts come out.

*Pieces.* The splitting pattern is a transducer over character classes with a
dozen states. A transition says whether a piece starts at the character just
read, or started at the one before. A block of texts is cut into chunks; the
map from every start state to the state after the chunk is computed for all
chunks side by side, the maps are composed by a parallel prefix scan, and one
more pass from the known states reads the cuts off.

*Tokens.* Inside a piece, merging by rank leaves exactly one last token for
every prefix: the suffix of the prefix that is a token and does not merge with
the last token of what stands before it. So the state after a prefix is: the
longest suffix that can still grow into a token, and for each position of that
suffix the last token ending there and the count there relative to the count
here. Reading a byte leads to the next state and annotates the transition with
the change of the count; a piece's tokens are the sum along its path.
Transitions are compiled when first met and kept from task to task.

Null and empty texts have no tokens. A special string in a text counts as one.
Rows are handled one by one, so equal rows, ties and null ids need no rule;
columns that the operator does not name are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import pretoken
from ebbflow.llm.bpe import Vocabulary, pieces_of, split_special
from ebbflow.llm.common import code_points, slices, text_buffer

#: Bytes of text worked on at once inside a task.
BLOCK_BYTES = 4 << 20
#: Chunks that a block is cut into.
CHUNKS = 4096
#: Compiled token states, and bytes of remembered pieces, that a worker keeps;
#: beyond either it starts afresh.
MAX_STATES, MEMORY_BYTES = 250_000, 64 << 20

# Symbols of the piece transducer: classes, with the letters of contractions
# told apart (a: one of s t m d), the blank and the apostrophe; END closes a
# text, PAD does nothing.
SYMBOLS = "other letter number space blank quote a r v e l END PAD".split()
SYM = {s: i for i, s in enumerate(SYMBOLS)}
# start: a text begins or a piece has just been completed; blank1: one blank
# that the next run takes along; space1: one other white space; blanks,
# spaces: longer runs that end in a blank or another white space; quote: an
# apostrophe that may begin a contraction; qr qv ql: such with its first letter.
STATES = "start letters numbers others blank1 space1 blanks spaces quote qr qv ql done".split()
STATE = {s: i for i, s in enumerate(STATES)}
HERE, BEFORE = 1, 2


def _compile() -> tuple[np.ndarray, np.ndarray]:
    """Next state and cuts (bit 1: at this character, bit 2: at the one
    before) for each state and symbol."""
    step = np.zeros((len(STATES), len(SYMBOLS)), np.uint8)
    cut = np.zeros_like(step)
    letter_like = {"letter", "a", "r", "v", "e", "l"}
    run_of = {"other": "others", "number": "numbers", "quote": "quote",
              "blank": "blank1", "space": "space1"} | dict.fromkeys(letter_like, "letters")
    for s in STATES:
        for x in SYMBOLS:
            if x == "PAD":
                step[STATE[s], SYM[x]] = STATE[s]
                continue
            white = x in ("blank", "space")
            to, c = run_of.get(x, "start"), HERE  # by default a piece starts here
            if s == "letters" and x in letter_like or s == "numbers" and x == "number":
                c = 0
            elif s == "others" and x in ("other", "quote"):
                to, c = "others", 0
            elif s == "quote" and x in ("other", "quote"):
                to, c = "others", 0
            elif s == "quote" and x in "arvl" and len(x) == 1:
                to, c = {"a": "done", "r": "qr", "v": "qv", "l": "ql"}[x], 0
            elif (s, x) in (("qr", "e"), ("qv", "e"), ("ql", "l")):
                to, c = "done", 0
            elif s in ("qr", "qv", "ql"):  # no contraction: its letter began a run of letters
                c = BEFORE if x in letter_like else BEFORE | HERE
            elif s in ("blank1", "space1", "blanks", "spaces") and white:
                to, c = "blanks" if x == "blank" else "spaces", 0
            elif s in ("blank1", "blanks") and x != "END":
                to = "others" if x == "quote" else to
                c = 0 if s == "blank1" else BEFORE
            elif s == "spaces" and x != "END":
                c = BEFORE | HERE
            if x == "END":
                to, c = "start", HERE | (BEFORE if s in ("qr", "qv", "ql") else 0)
            step[STATE[s], SYM[x]], cut[STATE[s], SYM[x]] = STATE[to], c
    return step, cut


STEP, CUT = _compile()


def symbol_table(classes: np.ndarray) -> np.ndarray:
    """Symbol of each code point, END for the code point past the last."""
    kind = {pretoken.OTHER: "other", pretoken.LETTER: "letter", pretoken.NUMBER: "number", pretoken.SPACE: "space"}
    table = np.array([SYM[kind[i]] for i in range(4)], np.uint8)[classes]
    for chars, x in ((" ", "blank"), ("'", "quote"), ("stmd", "a"), ("r", "r"), ("v", "v"), ("e", "e"), ("l", "l")):
        table[[ord(c) for c in chars]] = SYM[x]
    return np.append(table, np.uint8(SYM["END"]))


def cut_flags(symbols: np.ndarray) -> np.ndarray:
    """Run the piece transducer over END-closed texts lying end to end: bit 1
    of each position tells that a piece (or END) starts there."""
    n, s, k = len(symbols), len(STATES), len(SYMBOLS)
    width = max(1, -(-n // CHUNKS))
    grid = np.full(width * -(-n // width), SYM["PAD"], np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(-1, width).T)  # position in chunk, chunk
    flat = STEP.ravel()
    maps = np.broadcast_to(np.arange(s, dtype=np.uint8), (grid.shape[1], s))
    wide = grid.astype(np.int16)
    for row in wide:  # every chunk's map, one position at a time
        maps = flat[maps.astype(np.int16) * k + row[:, None]]
    # parallel prefix scan: after round r a map covers 2^r chunks
    reach = 1
    while reach < len(maps):
        composed = maps.copy()
        composed[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        maps, reach = composed, 2 * reach
    state = np.concatenate([[STATE["start"]], maps[:-1, STATE["start"]]]).astype(np.int16)
    flags = np.empty(grid.shape, np.uint8)
    cut = CUT.ravel()
    for i, row in enumerate(wide):
        at = state * k + row
        flags[i] = cut[at]
        state = flat[at].astype(np.int16)
    flags = flags.T.ravel()[:n]
    starts = flags & HERE
    starts[:-1] |= (flags[1:] & BEFORE) >> 1
    return starts


class TokenTransducer:
    """Counts the tokens of a piece; transitions are compiled on demand."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids = {t: i for i, t in enumerate(vocabulary.token_bytes) if i not in vocabulary.special.values()}
        self.ranks = {}
        left, right = np.divmod(vocabulary.keys, vocabulary.size)
        for a, b, r, m in zip(left.tolist(), right.tolist(), vocabulary.ranks.tolist(), vocabulary.merged.tolist()):
            self.ranks[a, b] = (r, m)
        # every proper prefix of a token: a suffix in this set can still grow
        self.growing = {t[:i] for t in self.ids for i in range(len(t))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.next: dict[int, tuple[int, int]] = {}
        self.known: dict[bytes, int] = {}
        self.kept: list[tuple] = []
        self.held = 0
        if len(self.pairs) > 2_000_000:
            self.pairs = {}
        self._state((b"", (-1,), (0,)))

    def _state(self, key: tuple) -> int:
        n = self.states.setdefault(key, len(self.states))
        if n == len(self.kept):
            self.kept.append(key)
        return n

    def stays(self, a: int, b: int) -> bool:
        """Whether merging leaves token ``b`` apart after ``a`` (-1: nothing)."""
        if (a, b) not in self.pairs:
            raw = (self.v.token_bytes[a] if a >= 0 else b"") + self.v.token_bytes[b]
            self.pairs[a, b] = self._merged(raw) == ([a, b] if a >= 0 else [b])
        return self.pairs[a, b]

    def _merged(self, raw: bytes) -> list[int]:
        syms = self.v.byte_id[np.frombuffer(raw, np.uint8)].tolist()
        none = (1 << 40, -1)
        while len(syms) > 1:
            best, at = min((self.ranks.get((syms[i], syms[i + 1]), none), i) for i in range(len(syms) - 1))
            if best[1] < 0:
                break
            syms[at:at + 2] = [best[1]]
        return syms

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        suffix, last, count = self.kept[state]
        grown = suffix + bytes((byte,))
        for at in range(len(grown)):
            token = self.ids.get(grown[at:])
            if token is not None and self.stays(last[at], token):
                break
        else:
            raise ValueError("no token ends here")
        gain = count[at] + 1
        drop = next(i for i in range(len(grown) + 1) if grown[i:] in self.growing)
        last = (*last, token)[drop:]
        count = (*(c - gain for c in count), 0)[drop:]
        to = self._state((grown[drop:], last, count))
        self.next[state << 8 | byte] = to, gain
        return to, gain

    def count(self, piece: bytes) -> int:
        state, total, step = 0, 0, self.next.get
        for byte in piece:
            state, gain = step(state << 8 | byte) or self.compile(state, byte)
            total += gain
        return total

    def counts(self, pieces: Iterator[bytes], n: int) -> np.ndarray:
        """Tokens of each of ``n`` pieces."""
        if len(self.states) > MAX_STATES or self.held > MEMORY_BYTES:
            self.forget()
        known, out = self.known, np.empty(n, np.int64)
        for i, piece in enumerate(pieces):
            c = known.get(piece)
            if c is None:
                c = known[piece] = self.count(piece)
                self.held += 150 + len(piece)
            out[i] = c
        return out


class Counter:
    """Counts the tokens of blocks of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.symbols = symbol_table(vocabulary.classes)
        self.tokens = TokenTransducer(vocabulary)

    def pieces(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, list]:
        """Byte positions at which pieces start, the end of the buffer last."""
        segments, found = split_special(raw, offsets, self.v.special)
        cp, starts, byte_at = code_points(raw, segments)
        starts = starts[starts < len(cp)]
        closed = self.symbols[np.insert(cp.astype(np.int64), np.append(starts[1:], len(cp)), len(self.symbols) - 1)]
        flags = cut_flags(closed)[closed != SYM["END"]] if len(cp) else np.zeros(0, np.uint8)
        bounds = np.append(byte_at[:-1][(flags & HERE) > 0], len(raw))
        for a, b, _ in found:  # a special string is one piece
            bounds = bounds[(bounds <= a) | (bounds >= b)]
        return bounds, found

    def count(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        if not len(raw):
            return np.zeros(len(offsets) - 1, np.int64)
        bounds, found = self.pieces(raw, offsets)
        n = self.tokens.counts(pieces_of(raw, bounds), len(bounds) - 1)
        if found:
            n[np.searchsorted(bounds, [a for a, _, _ in found])] = 1
        total = np.concatenate([[0], np.cumsum(n)])
        return np.diff(total[np.searchsorted(bounds, offsets)])


_COUNTERS: dict[str, Counter] = {}


def counter(vocabulary: Vocabulary) -> Counter:
    """This worker's counter, kept from task to task."""
    if vocabulary.key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[vocabulary.key] = Counter(vocabulary)
    return _COUNTERS[vocabulary.key]


def count_tokens(df: DataFrame, vocabulary: Vocabulary, limit: int, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens) for every row."""
    narrow = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file, of fixed size
    schema = ", ".join([*(f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))),
                        "n_bytes bigint", "n_tokens bigint"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(shared.value)
        for whole in batches:
            for batch in slices(whole, "t", BLOCK_BYTES):
                raw, offsets = text_buffer(batch.column("t"))
                keys = [batch.column(f"k{i}") for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(np.diff(offsets)), pa.array(c.count(raw, offsets))],
                    [*(f"k{i}" for i in range(len(keep))), "n_bytes", "n_tokens"])

    done = narrow.mapInArrow(run, schema)
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
