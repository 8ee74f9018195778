"""Joins on a key that very many rows may share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import settled


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _broadcast_below(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def heavy_keys(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """``key`` and ``salts``: the keys with more rows than half a task's even share, and over how many
    tasks to spread each. There are fewer than twice as many as ``partitions``, and so many salts in all."""
    counts = settled(rows.where(F.col(key).isNotNull()).groupBy(key).count())
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    share = max(1, total // (2 * partitions))
    return counts.where(F.col("count") > share).select(key, F.ceil(F.col("count") / share).cast("int").alias("salts"))


def spread_join(rows: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``unique``, which has one row for each key, on ``key``.

    Keys are counted first, on their column alone. The rows of a heavy one are dealt over as many tasks
    as they fill, and its row of the other side is repeated for each. Without heavy keys, or with
    a side that the planner will broadcast, it is a plain join. Rows without a key are dropped.
    """
    if _estimated_bytes(unique) <= _broadcast_below(unique):
        return rows.join(unique, key)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = settled(heavy_keys(rows.select(key), key, partitions))
    if heavy.isEmpty():
        return rows.join(unique, key)
    few = F.broadcast(heavy)  # fewer than 2 * partitions
    salted = rows.join(few, key, "left")
    others = [c for c in rows.columns if c != key] or [key]
    which = F.pmod(F.xxhash64(*others, F.rand(11)), F.coalesce("salts", F.lit(1)))
    salted = salted.withColumn("_salt", which.cast("int")).drop("salts")
    repeated = unique.join(few, key, "left")
    numbers = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = repeated.withColumn("_salt", F.explode(numbers)).drop("salts")
    return salted.join(repeated, [key, "_salt"]).drop("_salt")


def spread_left_join(rows: DataFrame, unique: DataFrame, key: str, by: str, counted: DataFrame) -> DataFrame:
    """All ``rows`` with the one column of ``unique``, distinct values, where it is the row's ``key``, else NULL.

    Rows of a heavy key are dealt over tasks as ``spread_join`` does, and those without a key over all tasks,
    by their column ``by`` and by chance. Keys are counted in ``counted``, which has the same ones.
    """
    value = unique.columns[0]
    if _estimated_bytes(unique) <= _broadcast_below(unique):
        return rows.join(unique, F.col(key) == F.col(value), "left")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = settled(heavy_keys(counted.select(key), key, partitions).withColumnRenamed(key, "_heavy"))
    few = F.broadcast(heavy)  # fewer than 2 * partitions
    salts = F.when(F.col(key).isNull(), partitions).otherwise(F.coalesce("salts", F.lit(1)))
    dealt = rows.join(few, F.col(key) == F.col("_heavy"), "left")
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64(by, F.rand(11)), salts).cast("int")).drop("_heavy", "salts")
    numbers = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = unique.join(few, F.col(value) == F.col("_heavy"), "left")
    repeated = repeated.withColumn("_part", F.explode(numbers)).drop("_heavy", "salts")
    same = (F.col(key) == F.col(value)) & (F.col("_salt") == F.col("_part"))
    return dealt.join(repeated, same, "left").drop("_salt", "_part")
