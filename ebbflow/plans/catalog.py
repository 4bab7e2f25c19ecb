"""Registry of named queries: a Spark builder and, where SQL can say the same
thing, the DuckDB oracle text the driver compares it with.

Every query reads the driver tables under ``sf_dir`` in full. Column names
and types are the same on both sides (aliases everywhere, bigint counts,
``TIMESTAMP_NTZ`` / ``TIMESTAMP`` times).
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbflow.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    covers: tuple[str, ...]
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def query(name: str, *, covers: tuple[str, ...], oracle: str | None = None,
          headline: bool = False):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Query(name, build, oracle.strip() if oracle else None, covers, headline)
        return fn
    return deco
