"""A table store in blocks of ids, into which new rows are merged in place.

Each table's rows lie in one folder for each range of neighbouring ids. Ranges begin at multiples
of ``width`` and are cut by the number of rows, about ``width`` in each, so that there are as many
blocks as the rows fill, however many ids are missing; where none is, a block is ``width`` ids. A
folder has the number of its first ``width`` ids, and a block goes on to where the next one begins,
so that the folders' names are the whole layout. A merge reads and writes the blocks that the
new rows reach and no others: their files keep their names. New ids above those that a block
holds get blocks of their own, and one that has come to hold more than twice ``width`` rows is cut
anew, so blocks never outgrow a task.

Spark writes the new files beside the old ones and puts them in the blocks' folders when all tasks
are done. Losing an executor costs its tasks only, and a job that fails before that point changes
nothing. Folders are swapped one by one: readers should wait for the merge to end.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.merge import collapse_repeats, key_profile, merge_upsert
from tagloom.schemas import ENTITIES
from tagloom.session import settled, side_by_side
from tagloom.sinks.tables import table_path

BLOCK = "id_block"
WIDTH = 1_000_000
LAYOUT = "layout"  # one row: the width of the store's blocks


def _base(width: int) -> Column:
    """The number of the ``width`` ids that an id is among."""
    return F.expr(f"(id - pmod(id, {width})) div {width}")


def _up_to(starts: Sequence[int], value: Column) -> Column:
    """The last of the sorted numbers that is not above ``value``, or the first; looked up in two steps."""
    step = max(1, math.isqrt(len(starts)))
    groups = F.array(*[F.array(*map(F.lit, starts[i : i + step])) for i in range(0, len(starts), step)])
    heads = F.array(*map(F.lit, starts[::step]))
    group = F.element_at(groups, F.greatest(F.size(F.filter(heads, lambda s: s <= value)), F.lit(1)))
    return F.element_at(group, F.greatest(F.size(F.filter(group, lambda s: s <= value)), F.lit(1)))


def _block(width: int, starts: Sequence[int]) -> Column:
    """The block of an id, if blocks begin at ``starts``; the first one takes what is below it."""
    if not starts:
        return F.lit(None).cast("bigint").alias(BLOCK)
    return F.when(F.col("id").isNotNull(), _up_to(starts, _base(width))).cast("bigint").alias(BLOCK)


def _cuts(rows: DataFrame, width: int) -> list[int]:
    """Where to begin blocks of about ``width`` rows: the lowest, and quantiles of the rows' numbers.

    Each number is one that rows have, so no block is empty. Not every number comes to the driver
    but one for each ``width`` rows.
    """
    numbers = rows.where("id is not null").select(_base(width).alias("base"))
    n, low = numbers.agg(F.count(F.lit(1)), F.min("base")).first()
    if n == 0:
        return []
    parts = -(-n // width)
    middles = [(i + 0.5) / parts for i in range(parts)]
    found = numbers.agg(F.percentile_approx("base", middles, max(10_000, 20 * parts))).first()[0]
    return sorted({low, *found})


def _schema(name: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ENTITIES[name].schema]
    return ", ".join([*fields, f"`{BLOCK}` bigint"])


def _put(rows: DataFrame, store: str, name: str, width: int, starts: Sequence[int], mode: str) -> None:
    """Writes the blocks that ``rows`` have; those that are there already are replaced."""
    schema = ENTITIES[name].schema
    typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema])
    typed = typed.withColumn(BLOCK, _block(width, starts))
    # Rows without an id share a folder, not a task.
    spread = F.when(F.col("id").isNull(), F.xxhash64(*typed.columns))
    typed = typed.repartition(BLOCK, spread).sortWithinPartitions(BLOCK, "id")
    writer = typed.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(BLOCK).parquet(table_path(store, name))


def _rebuild(df: DataFrame, store: str, name: str, width: int) -> None:
    df = settled(df)  # its ids are read before its rows
    _put(df, store, name, width, _cuts(df, width), "static")


def write_blocks(
    spark: SparkSession, tables: Mapping[str, DataFrame], store: str, width: int = WIDTH
) -> None:
    """Rebuild all tables in blocks of about ``width`` rows; one that is missing becomes an empty table."""
    writes = []
    for name, entity in ENTITIES.items():
        if name in tables:
            writes.append(partial(_rebuild, tables[name], store, name, width))
        else:
            empty = spark.createDataFrame([], entity.schema)
            writes.append(partial(_put, empty, store, name, width, [], "static"))
    side_by_side(spark, writes)
    layout = spark.range(1).select(F.lit(width).cast("long").alias("width"))
    layout.write.mode("overwrite").parquet(table_path(store, LAYOUT))


def block_width(spark: SparkSession, store: str) -> int:
    return spark.read.parquet(table_path(store, LAYOUT)).first()["width"]


def _stored(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.schema(_schema(name)).parquet(table_path(store, name))


def read_blocks(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    return {name: _stored(spark, store, name).drop(BLOCK) for name in ENTITIES}


def _among(blocks: Sequence[int | None]) -> Column:
    """A filter that prunes the blocks' folders before any file is opened."""
    known = ", ".join(str(b) for b in blocks if b is not None)
    found = F.expr(f"{BLOCK} in ({known})") if known else F.lit(False)
    return found | F.col(BLOCK).isNull() if None in blocks else found


def _starts(spark: SparkSession, store: str, name: str) -> list[int]:
    """Where the stored blocks begin: one number for each."""
    found = _stored(spark, store, name).where(f"{BLOCK} is not null").select(BLOCK).distinct()
    return sorted(r[BLOCK] for r in found.collect())


def _reached(rows: DataFrame, width: int, starts: Sequence[int]) -> list[int | None]:
    """The blocks of the rows' ids."""
    return [r[BLOCK] for r in rows.select(_block(width, starts)).distinct().collect()]


def _new_starts(near: DataFrame, rows: DataFrame, width: int, starts: Sequence[int]) -> list[int]:
    """The starts with those that ``rows`` add to them; ``near`` has the id and block of the rows that
    are stored in the blocks they reach.

    What is above all stored ids of its block gets blocks of its own. Then blocks that the rows
    would fill to more than twice ``width`` are cut.
    """
    number, block = _base(width).alias("base"), _block(width, starts)
    held = near.groupBy(BLOCK).agg(F.max(number).alias("_last"))
    beyond = rows.select("id", block).join(held, BLOCK, "left")
    beyond = beyond.where((_base(width) > F.col("_last")) | F.col("_last").isNull() | (_base(width) < F.col(BLOCK)))
    starts = sorted({*starts, *_cuts(beyond, width)})
    if not starts:
        return starts
    ids = near.select("id").unionByName(rows.select("id")).where("id is not null").distinct()
    ids = settled(ids.select("id", _block(width, starts)))
    full = ids.groupBy(BLOCK).count().where(F.col("count") > 2 * width).select(BLOCK)
    return sorted({*starts, *_cuts(ids.join(full, BLOCK, "left_semi"), width)})


def merge_blocks(
    spark: SparkSession, store: str, name: str, new: DataFrame, order: Column | None = None
) -> list[int | None]:
    """``new`` merged into a stored table as ``merge_upsert`` does it; the blocks it rewrote.

    An entity without updated columns takes unknown ids only, so that a block in which all are
    known stays as it is: that is found by the ids alone. Rows without an id match no other and are
    added. Without new rows, nothing is written. ``order`` tells a repeated id's first row from its last.
    """
    entity, width = ENTITIES[name], block_width(spark, store)
    new = settled(new)  # computed once, read several times
    profile = key_profile(new)
    if profile.rows == 0:
        return []
    rows = collapse_repeats(new, update=entity.update, order=order, profile=profile)
    rows = rows.select(*entity.columns)
    if profile.repeated:
        rows = settled(rows)
    stored, starts = _stored(spark, store, name), _starts(spark, store, name)
    blocks = _reached(rows, width, starts)
    if not entity.update:
        ids = stored.where(_among(blocks)).select("id")
        rows = settled(rows.join(ids, "id", "left_anti").select(*entity.columns))
        blocks = _reached(rows, width, starts)
    if not blocks:
        return []
    known = stored.where(_among(blocks) & F.col(BLOCK).isNotNull()).select("id", BLOCK)
    grown = _new_starts(known, rows, width, starts)
    # Blocks of new ids alone leave the stored ones before them as they are; one that is cut
    # is written whole.
    reached = {*_reached(rows, width, grown)}
    cut = {*grown} - {*starts}
    if cut and starts:
        moved = _reached(known.where(_block(width, grown) != F.col(BLOCK)).select("id"), width, starts)
        reached |= {*moved}
    near = stored.where(_among([b for b in reached if b is None or b in {*starts}])).select(*entity.columns)
    written = reached | {*_reached(near.select("id"), width, grown)} if cut else reached
    once = profile._replace(repeated=0)
    _put(merge_upsert(near, rows, update=entity.update, profile=once), store, name, width, grown, "dynamic")
    return [*written]
