"""Query results as JSON lines and query plans as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_json(df: DataFrame, folder: str, name: str) -> str:
    """All rows to ``<folder>/<name>.json``, NULLs included, keys in order of name."""
    path = f"{folder.rstrip('/')}/{name}.json"
    rows = df.select(*sorted(df.columns))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_plan(df: DataFrame, folder: str, name: str) -> str:
    """Spark's formatted plan of ``df`` to ``<folder>/<name>.explain.txt``."""
    path = f"{folder.rstrip('/')}/{name}.explain.txt"
    plan = df.sparkSession.sql("EXPLAIN FORMATTED SELECT * FROM {rows}", rows=df)
    plan.coalesce(1).write.mode("overwrite").text(path)
    return path
