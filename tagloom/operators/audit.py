"""Audits in place of the constraints that Spark tables do not enforce."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.references import reference_values, without_target
from tagloom.schemas import ENTITIES, FOREIGN_KEYS


def _reports(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fk_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: rows and distinct values whose target does not exist.

    All keys to one parent are counted per value in one pass before anything is
    joined, so the parent's ids are shuffled once for them all and a value that
    many rows share is one row at the join.
    """
    parts = []
    for parent in dict.fromkeys(p for _, _, p in FOREIGN_KEYS):
        keys = sorted((child, column) for child, column, p in FOREIGN_KEYS if p == parent)
        streams = []
        for child in dict.fromkeys(c for c, _ in keys):
            slots = [i for i, (table, _) in enumerate(keys) if table == child]
            columns = [keys[i][1] for i in slots]
            streams.append(reference_values(tables[child], columns, first_slot=slots[0]))
        counts = _reports(streams).groupBy("value").agg(
            *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(len(keys))]
        )
        orphans = without_target(counts, tables[parent].select("id"))
        totals = orphans.agg(
            *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"rows{i}") for i in range(len(keys))],
            *[F.count_if(F.col(f"n{i}") > 0).alias(f"values{i}") for i in range(len(keys))],
        )
        cells: list[Column] = []
        for i, (child, column) in enumerate(keys):
            cells += [F.lit(child), F.lit(column), F.lit(parent), F.col(f"rows{i}"), F.col(f"values{i}")]
        report = F.stack(F.lit(len(keys)), *cells)
        parts.append(
            totals.select(
                report.alias(
                    "child_table", "child_column", "parent_table", "orphan_rows", "orphan_values"
                )
            )
        )
    return _reports(parts)


def pk_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, distinct ids, ids that repeat, rows without an id."""
    parts = []
    for name in ENTITIES:
        per_id = tables[name].groupBy("id").count()
        known = F.col("id").isNotNull()
        parts.append(
            per_id.agg(
                F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
                F.count("id").alias("distinct_ids"),
                F.count_if(known & (F.col("count") > 1)).alias("repeated_ids"),
                F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0)).alias("null_ids"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return _reports(parts)


def not_null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per required column: rows that hold NULL. One pass per table."""
    parts = []
    for name, entity in ENTITIES.items():
        columns = entity.required
        totals = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        cells: list[Column] = []
        for c in columns:
            cells += [F.lit(name), F.lit(c), F.col(c)]
        report = F.stack(F.lit(len(columns)), *cells)
        parts.append(totals.select(report.alias("table_name", "column_name", "null_rows")))
    return _reports(parts)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session beside this one whose Parquet scans answer counts from the files' footers."""
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def not_null_audit_stored(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``not_null_audit`` of stored tables without reading a value: NULLs are the rows less the
    values, and both counts stand in the footers. ``paths`` names each table's folder.

    The report belongs to a session of its own, as the setting that allows this counts for all
    of a session's tables.
    """
    footers = _footer_session(spark)
    parts = []
    for name, entity in ENTITIES.items():
        columns = entity.required
        stored = footers.read.schema(entity.schema).parquet(paths[name])
        counts = stored.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
        cells: list[Column] = []
        for c in columns:
            # Counts taken from no row group at all are NULL, against their type, which lets the
            # planner strike a coalesce.
            cells += [F.lit(name), F.lit(c), F.greatest(F.col("_rows") - F.col(c), F.lit(0))]
        report = F.stack(F.lit(len(columns)), *cells)
        parts.append(counts.select(report.alias("table_name", "column_name", "null_rows")))
    return _reports(parts)
