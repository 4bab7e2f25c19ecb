"""SQL sink tables (S11): a named table over a folder in the shared scratch
location, filled with ``INSERT OVERWRITE`` from a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbflow.session import work_dir


def create_sink_table(spark: SparkSession, name: str, ddl_cols: str, fmt: str = "parquet") -> str:
    path = work_dir(spark, "sink-tables", name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl_cols}) USING {fmt} LOCATION '{path}'")
    return path


def insert_query(spark: SparkSession, name: str, ddl_cols: str, select_sql: str) -> DataFrame:
    """Create the sink table, run ``INSERT OVERWRITE name <select>`` and return
    the table as written (the batch form of ``executeInsert``)."""
    create_sink_table(spark, name, ddl_cols)
    spark.sql(f"INSERT OVERWRITE TABLE {name} {select_sql}")
    spark.catalog.refreshTable(name)
    return spark.table(name)
