"""A table store whose tables are bucketed and sorted by id.

What joins or groups by id then needs no shuffle of the stored side: answers meet their
questions, references their targets, and new rows the table they are merged into, where the
table's rows lie. Only the side that comes by another column, or is new, moves.

Bucketing is a property of a catalog table, not of files. So the number of buckets is kept in the
store, and reading registers the folder in the session's catalog under a name of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schemas import ENTITIES
from tagloom.session import shuffles_freed, side_by_side
from tagloom.sinks.tables import table_path

LAYOUT = "layout"  # one row: how many buckets the store's tables have
BUCKET_BYTES = 128_000_000  # of rows as they are in memory, in one task
ROW_BYTES = 150  # of a row, besides its texts


def _registered(store: str, name: str, buckets: int) -> str:
    place = hashlib.sha256(f"{table_path(store, name)} {buckets}".encode()).hexdigest()[:16]
    return f"tagloom_{name}_{place}"


def _write(df: DataFrame, store: str, name: str, buckets: int) -> None:
    schema = ENTITIES[name].schema
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
    table = _registered(store, name, buckets)
    df.sparkSession.sql(f"drop table if exists {table}")
    # Dealt as the buckets are, so that each task writes one file.
    writer = rows.repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id").mode("overwrite")
    writer.option("path", table_path(store, name)).format("parquet").saveAsTable(table)


def _bytes(df: DataFrame) -> int:
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    size = sum(texts, F.lit(ROW_BYTES).cast("long"))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def buckets_for(spark: SparkSession, tables: Mapping[str, DataFrame], least: int = 1) -> int:
    """So many buckets that one of the largest table holds about ``BUCKET_BYTES``."""
    sizes = side_by_side(spark, [partial(_bytes, df) for df in tables.values()])
    return max(least, -(-max(sizes, default=0) // BUCKET_BYTES))


def write_clustered(spark: SparkSession, tables: Mapping[str, DataFrame], store: str, buckets: int) -> None:
    """Rebuild all tables in ``buckets`` buckets each; one that is missing becomes an empty table.

    All have the same number, so that any two meet bucket by bucket: about the bytes of the
    largest table by what one task should read, as ``buckets_for`` has it. Rows without an id share a bucket.
    One table is written after the other, and each one's shuffles go before the next one's are made.
    """
    with shuffles_freed(spark):
        for name, entity in ENTITIES.items():
            df = tables.get(name)
            if df is None:
                df = spark.createDataFrame([], entity.schema)
            _write(df, store, name, buckets)
    layout = spark.range(1).select(F.lit(buckets).alias("buckets"))
    layout.write.mode("overwrite").parquet(table_path(store, LAYOUT))


def read_clustered(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The tables of a store that ``write_clustered`` wrote, in this or another session."""
    buckets = spark.read.parquet(table_path(store, LAYOUT)).first()["buckets"]
    found = {}
    for name, entity in ENTITIES.items():
        table, path = _registered(store, name, buckets), table_path(store, name).replace("'", r"\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entity.schema)
        spark.sql(
            f"create table if not exists {table} ({columns}) using parquet "
            f"clustered by (id) sorted by (id) into {buckets} buckets location '{path}'"
        )
        found[name] = spark.table(table)
    return found
