"""Driver tables and the staged copies some sources need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.functions.time import epoch_ms
from ebbflow.session import work_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# Line layout of the staged click file: user, item, behaviour, epoch ms.
CLICK_LINE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("event_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("ts_ms", T.LongType(), False),
])


def staged_click_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the events as comma lines and return the folder. Every call has a
    folder of its own: results that are still lazy keep the files they read."""
    path = work_dir(spark, "staged-clicks")
    (events(spark, sf_dir)
     .select("user_id", "event_id", "event_type", epoch_ms("ts").alias("ts_ms"))
     .write.mode("overwrite").option("header", "false").csv(path))
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file (or folder) as one ``value`` row per line."""
    return spark.read.text(path)


def parse_lines(lines: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """S3 for a line column: split on commas into a typed record.

    ``from_csv`` with FAILFAST raises on a malformed number, as the original
    ``Long.parseLong`` does.
    """
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(col), F.lit(ddl), {"mode": "FAILFAST"})
    return lines.select(parsed.alias("_r")).select("_r.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: comma lines -> typed records; a bad field fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("header", "false").csv(path)


def register_csv_table(spark: SparkSession, name: str, path: str, ddl_cols: str) -> DataFrame:
    """S5 + S6: SQL DDL over a CSV folder, then look the table up by name."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"CREATE TEMPORARY VIEW {name} ({ddl_cols}) USING csv "
              f"OPTIONS (path '{path}', header 'false', mode 'FAILFAST')")
    return spark.table(name)
