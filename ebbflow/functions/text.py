"""String helpers with the record semantics of the original jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_words(line: Column | str) -> Column:
    """Split a line on single spaces, keeping inner and leading empty
    strings and dropping trailing ones (Java ``String.split(" ")``).

    * ``"a  b "`` -> ``["a", "", "b"]``
    * ``""``      -> ``[""]``  (one empty word)
    * ``"   "``   -> ``[]``    (only trailing empties)
    """
    line = _c(line)
    trimmed = F.rtrim(line)
    return (F.when(line.isNull(), F.lit(None))
            .when((line != F.lit("")) & (trimmed == F.lit("")),
                  F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def split_lines(text: Column | str) -> Column:
    """A text value read as a file: one element per line.

    A final newline ends the last line (it does not open an empty one) and an
    empty text has no lines, as when the text is read with ``spark.read.text``.
    """
    text = _c(text)
    body = F.when(text.endswith("\n"), text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    return (F.when(text.isNull(), F.lit(None))
            .when(text == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(body, "\n", -1)))
