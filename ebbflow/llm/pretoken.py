"""Splitting a text into the pieces byte-level BPE works on.

The rule is the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Every alternative but the contractions is a run of one character class, with
the last blank before a run joining it, so the cuts follow from comparing
neighbouring classes; :func:`cuts` does it for a whole batch of texts at once.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def _by_category() -> np.ndarray:
    """Classes after Python's Unicode tables."""
    table = np.zeros(0x110000, np.uint8)
    cats = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    cats = np.array(cats)
    table[cats == "L"] = LETTER
    table[cats == "N"] = NUMBER
    # fixed values: the code points with the White_Space property
    table[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return table


@functools.lru_cache(2)
def class_table(path: str) -> np.ndarray:
    """Character class of each code point as the tokenizer of ``path`` takes
    it. Unicode versions differ in what they have assigned: for code points
    that Python's tables hold unassigned, the tokenizer's own splitting rule
    is asked, a block of them at a time (planes 4 to 13 have none assigned in
    any version). Built once, on the driver."""
    from tokenizers import Tokenizer
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    table = _by_category()
    open_ = [c for c in range(0x110000) if not 0x40000 <= c < 0xE0000 and unicodedata.category(chr(c)) == "Cn"]
    for lo in range(0, len(open_), 50_000):
        block = open_[lo:lo + 50_000]
        for cls, probe in ((LETTER, "a"), (NUMBER, "1")):
            # each probe is three characters; the asked one joins the run before it or not
            pieces = split("".join(f"{probe}{chr(c)}\n" for c in block))
            starts = np.zeros(3 * len(block), bool)
            starts[[span[0] for _, span in pieces]] = True
            table[np.array(block)[~starts[1::3]]] = cls
    return table


def cuts(cp: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where a piece starts. ``cp``: code points of all texts, end to
    end; ``starts``: where the (non-empty) texts start; ``classes``: see
    :func:`class_table`."""
    n = len(cp)
    if not n:
        return np.zeros(0, bool)
    cls = classes[cp]
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= cls[1:] != cls[:-1]
    blank = cp == 32
    cut = run[:n].copy()
    # a run after a blank of the same text takes that blank along
    joins = np.zeros(n, bool)
    joins[1:] = run[1:n] & ~first[1:n] & blank[:-1] & (cls[1:] != SPACE)
    cut &= ~joins
    # the last white space before a run starts a piece
    space_end = np.zeros(n, bool)
    space_end[:-1] = (cls[:-1] == SPACE) & run[1:n] & ~first[1:n]
    cut |= space_end
    # contractions: an apostrophe run of length one that took no blank
    q = np.flatnonzero((cp == 39) & run[:n] & ~joins & run[1:])
    q = q[(q + 1 < n)]
    q = q[~first[q + 1]]
    if len(q):
        nxt = cp[q + 1]
        third = np.where((q + 2 < n) & ~first[np.minimum(q + 2, n)], cp[np.minimum(q + 2, n - 1)], 0)
        one = np.isin(nxt, [ord(c) for c in "stmd"])
        two = ((nxt == ord("r")) & (third == ord("e"))) | ((nxt == ord("v")) & (third == ord("e"))) \
            | ((nxt == ord("l")) & (third == ord("l")))
        for hit, length in ((q[one], 1), (q[two], 2)):
            cut[hit + 1] = False
            after = hit + 1 + length
            after = after[after < n]
            after = after[~run[after]]
            cut[after] = True
    return cut
