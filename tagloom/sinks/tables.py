"""The table store: a folder with one parquet table per entity, and post_tags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.posts import post_tags
from tagloom.schemas import ENTITIES
from tagloom.session import side_by_side


def table_path(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/{name}"


def write_table(df: DataFrame, store: str, name: str) -> None:
    """Rebuild one table with its fixed columns."""
    schema = ENTITIES[name].schema
    columns = [df[f.name].cast(f.dataType).alias(f.name) for f in schema]
    df.select(*columns).write.mode("overwrite").parquet(table_path(store, name))


def write_tables(spark: SparkSession, tables: Mapping[str, DataFrame], store: str) -> None:
    """Rebuild all tables; one that is missing becomes an empty table."""
    writes = []
    for name, entity in ENTITIES.items():
        df = tables.get(name)
        if df is None:
            df = spark.createDataFrame([], entity.schema)
        writes.append(partial(write_table, df, store, name))
    side_by_side(spark, writes)


def read_table(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.schema(ENTITIES[name].schema).parquet(table_path(store, name))


def read_tables(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, store, name) for name in ENTITIES}


def refresh_post_tags(spark: SparkSession, store: str) -> None:
    """Build or rebuild the post_tags table from the stored posts.

    Laid out by tag, so that reading one tag skips the other files and row
    groups. The post id is part of the range key: a tag on a third of all posts
    is spread over many tasks.
    """
    rows = post_tags(read_table(spark, store, "posts"))
    rows = rows.repartitionByRange("tag", "post_id").sortWithinPartitions("tag", "post_id")
    rows.write.mode("overwrite").parquet(table_path(store, "post_tags"))


def read_post_tags(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema("post_id bigint, tag string").parquet(table_path(store, "post_tags"))
