"""Record-at-a-time operators: map, filter, flat-map and SQL select.

All of these are narrow transformations: no shuffle, fused into one
whole-stage-codegen span, and the filters and projections reach the parquet
scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.time import epoch_ms


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """B1: map a record to some of its fields."""
    return df.select(*cols)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """B2: keep records whose field equals a value."""
    return df.filter(F.col(col) == F.lit(value))


def flatmap_fields(df: DataFrame, id_col: str, fields: list[str | Column]) -> DataFrame:
    """One record -> one output string per field (``pos`` is the field index)."""
    arr = F.array(*[(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields])
    return df.select(F.col(id_col), F.posexplode(arr).alias("pos", "field")) \
             .withColumn("pos", F.col("pos").cast("long"))


def event_fields(ts: str = "ts") -> Column:
    """The text form of an event time field: epoch milliseconds."""
    return epoch_ms(ts)


def sql_select(spark: SparkSession, df: DataFrame, view: str, cols: list[str]) -> DataFrame:
    """B6 + S8: register a table over the records and select with SQL."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT {', '.join(cols)} FROM {view}")


def select_where(df: DataFrame, cols: list[str], col: str, value) -> DataFrame:
    """Expression API ``select(...).where(col == value)``."""
    return df.select(*cols).where(F.col(col) == F.lit(value))


def view_chain(spark: SparkSession, df: DataFrame, filter_col: str, value,
               cols: list[str], view: str) -> DataFrame:
    """Filter -> select -> temporary view -> SQL select over the view."""
    df.where(F.col(filter_col) == F.lit(value)).select(*cols).createOrReplaceTempView(view)
    return spark.sql(f"SELECT {', '.join(cols)} FROM {view}")
