"""Event-time helpers (T1, T2) and duration parsing.

Tables store ``ts`` as ``TIMESTAMP_NTZ``. Batch code keeps NTZ (it is what
the parquet files and DuckDB hold); streaming code needs a zoned timestamp
for ``withWatermark`` and uses :func:`as_event_time`. Sessions run in UTC, so
the casts between the two are exact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def duration_ms(spec: str | int) -> int:
    """'10 hours' / '5 s' / 3000 -> milliseconds."""
    if isinstance(spec, int):
        return spec
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", spec)
    if not m:
        raise ValueError(f"bad duration: {spec!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ms(ts: Column | str) -> Column:
    """Timestamp (NTZ or zoned) -> epoch milliseconds (bigint)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_us(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def from_epoch_ms(ms: Column | str) -> Column:
    """Epoch-ms field -> TIMESTAMP_NTZ."""
    return F.timestamp_millis(_c(ms)).cast("timestamp_ntz")


def from_epoch_seconds(sec: Column | str) -> Column:
    """Epoch-seconds field -> TIMESTAMP_NTZ (seconds x 1000 in ms terms)."""
    return F.timestamp_seconds(_c(sec)).cast("timestamp_ntz")


def as_event_time(ts: Column | str) -> Column:
    """NTZ -> zoned TIMESTAMP, the type ``withWatermark`` requires."""
    return _c(ts).cast("timestamp")


def interval(spec: str | int) -> Column:
    """A day-time interval literal: '10 minutes', '3 seconds', or milliseconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              F.lit(duration_ms(spec) / 1000.0).cast("decimal(18,6)"))
