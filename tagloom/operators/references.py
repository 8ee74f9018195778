"""References that point nowhere: finding, listing and clearing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tagloom.operators.spread import spread_join, spread_left_join
from tagloom.session import settled, side_by_side

# Most values a set of references may hold to be broadcast (8 bytes each).
BROADCAST_VALUES = 1_000_000


def reference_values(child: DataFrame, columns: Sequence[str], first_slot: int = 0) -> DataFrame:
    """(slot, value) per reference that is not NULL; the slot counts the columns."""
    if len(columns) == 1:  # a plain select lets the filter reach the scan
        cells = child.select(F.lit(first_slot).alias("slot"), F.col(columns[0]).alias("value"))
    else:
        pairs = [c for i, name in enumerate(columns) for c in (F.lit(first_slot + i), F.col(name))]
        cells = child.select(F.stack(F.lit(len(columns)), *pairs).alias("slot", "value"))
    return cells.where("value is not null")


def without_target(values: DataFrame, parent_ids: DataFrame) -> DataFrame:
    """The rows of ``values`` whose value is no id of the parent."""
    # Not broadcast: ids out of a wide table are more than the planner takes them for.
    parent = parent_ids.select(F.col(parent_ids.columns[0]).alias("_id")).hint("merge")
    return values.join(parent, values["value"] == parent["_id"], "left_anti")


def dangling_values(child: DataFrame, columns: Sequence[str], parent_ids: DataFrame) -> DataFrame:
    """Distinct values of the columns that are no id of the parent: ``value``, and
    ``in0``, ``in1``, ... for the columns that hold it.

    Values are made distinct before they are shuffled to the join, so neither
    the NULLs nor a value that many rows share reach it, and the parent's ids
    are shuffled once for all columns.
    """
    values = reference_values(child, columns).groupBy("value")
    flags = [F.bool_or(F.col("slot") == i).alias(f"in{i}") for i in range(len(columns))]
    return without_target(values.agg(*flags), parent_ids)


def orphan_rows(child: DataFrame, column: str, parent_ids: DataFrame) -> DataFrame:
    """Rows of ``child`` whose reference has no target. NULL references are fine."""
    gone = settled(dangling_values(child, [column], parent_ids).select("value"))
    return child.join(gone, child[column] == gone["value"], "left_semi")


def null_dangling(
    rows: DataFrame,
    parents: Mapping[str, DataFrame],
    key: str = "id",
    broadcast_values: int = BROADCAST_VALUES,
    slim: DataFrame | None = None,
    by_value: bool = True,
) -> DataFrame:
    """``rows`` with NULL in each column of ``parents`` whose value is no parent id.

    The values without a target are found first, on the slim columns alone. A
    counted, small set is broadcast and the wide rows stay in place. If only one is bigger, the
    wide rows are joined with it on the value, those of one that many rows share or of none over many tasks.
    Of several, or without ``by_value``, each is
    turned into the broken values of each key, and the wide rows are joined once on the
    key, however many columns are broken. Only slim rows meet on the value there, and one
    that many rows share is spread over many tasks. Rows with a repeated or NULL
    key get the same answer either way, as key and value must both agree. ``slim`` may
    hold the key and reference columns of ``rows`` where computing them again is dear.
    """
    columns, marks, broken = rows.columns, {}, []
    source = rows if slim is None else slim

    def find(names: list[str], parent_ids: DataFrame) -> tuple[list[str], DataFrame, Row]:
        gone = settled(dangling_values(source, names, parent_ids))
        return names, gone, gone.agg(*[F.count_if(f"in{i}") for i in range(len(names))]).first()

    searches = [
        partial(find, [c for c, p in parents.items() if p is parent_ids], parent_ids)
        for parent_ids in {id(p): p for p in parents.values()}.values()
    ]
    found = side_by_side(rows.sparkSession, searches)
    big = sum(size > broadcast_values for _, _, sizes in found for size in sizes)
    for names, gone, sizes in found:
        for i, column in enumerate(names):
            if sizes[i] == 0:
                continue
            mark = f"_gone_{column}"
            values = gone.where(f"in{i}").select(F.col("value").alias(mark))
            if sizes[i] <= broadcast_values:
                marks[column] = F.col(mark).isNotNull()
                rows = rows.join(F.broadcast(values), F.col(column) == F.col(mark), "left")
            elif by_value and big == 1:
                marks[column] = F.col(mark).isNotNull()
                rows = spread_left_join(rows, values, column, key, source)
            else:
                marks[column] = F.coalesce(F.array_contains(f"_broken.{column}", F.col(column)), F.lit(False))
                pairs = source.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
                hits = spread_join(pairs, values.withColumnRenamed(mark, "_value"), "_value")
                broken.append(hits.select("_key", F.lit(column).alias("_column"), "_value"))
    if broken:
        hits = reduce(DataFrame.unionByName, broken)
        values = [F.collect_set(F.when(F.col("_column") == c, F.col("_value"))).alias(c) for c in marks]
        repair = hits.groupBy("_key").agg(F.struct(*values).alias("_broken"))
        rows = rows.join(repair, F.col(key).eqNullSafe(F.col("_key")), "left")
    return rows.select(
        *[F.when(~marks[c], F.col(c)).alias(c) if c in marks else F.col(c) for c in columns]
    )
