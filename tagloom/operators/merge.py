"""Row-level merges of a loaded table with newly read rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import settled

# Rows of the new side that may be worth a broadcast; beyond, a merge keeps rows
# outside its key range apart.
SPLIT_ABOVE = 1_000_000


class KeyProfile(NamedTuple):
    rows: int
    low: Any
    high: Any
    repeated: int  # keys on more than one row
    repeated_low: Any
    repeated_high: Any


def key_profile(rows: DataFrame, key: str = "id") -> KeyProfile:
    """Counts and ranges of the keys, in one job on the key column alone."""
    twice = F.col("count") > 1
    found = rows.groupBy(key).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)),
        F.min(key),
        F.max(key),
        F.count_if(twice),
        F.min(F.when(twice, F.col(key))),
        F.max(F.when(twice, F.col(key))),
    )
    return KeyProfile(*found.first())


def collapse_repeats(
    rows: DataFrame,
    key: str = "id",
    update: Sequence[str] = (),
    order: Column | None = None,
    profile: KeyProfile | None = None,
) -> DataFrame:
    """One row per key: its first row, with the ``update`` columns of its last.

    ``order`` tells first from last; without it the whole row does, so that the
    result is repeatable. Only rows of a repeated key are grouped; finding them
    shuffles nothing but counted keys. The grouping combines before its shuffle,
    so a key that a third of all rows share is no burden.
    """
    profile = profile or key_profile(rows, key)
    if profile.repeated == 0:
        return rows
    # The range lets the scan skip most of what holds no repeated key.
    suspects = rows.where(
        F.col(key).between(profile.repeated_low, profile.repeated_high) | F.col(key).isNull()
    )
    repeated = settled(suspects.groupBy(key).count().where("count > 1").select(key))
    single = rows.join(repeated, rows[key].eqNullSafe(repeated[key]), "left_anti")
    several = suspects.join(repeated, suspects[key].eqNullSafe(repeated[key]), "left_semi")
    position = F.struct(*rows.columns) if order is None else order
    picks = [F.min_by(F.struct(*rows.columns), position).alias("first")]
    if update:
        picks.append(F.max_by(F.struct(*update), position).alias("last"))
    merged = several.groupBy(key).agg(*picks)
    collapsed = merged.select(
        *[F.col(f"{'last' if c in update else 'first'}.{c}") for c in rows.columns]
    )
    return single.unionByName(collapsed)


def merge_upsert(
    base: DataFrame,
    new: DataFrame,
    key: str = "id",
    update: Sequence[str] = (),
    order: Column | None = None,
    split_above: int = SPLIT_ABOVE,
    profile: KeyProfile | None = None,
) -> DataFrame:
    """``base`` with the rows of ``new``: an unknown key adds its row, a known
    key overwrites the ``update`` columns only (none: the row is ignored).

    ``base`` has unique keys; repeated keys in ``new`` act one after another in
    ``order``. The wide rows of ``base`` meet only the key and update columns of
    ``new``. Up to ``split_above`` rows those are written to a table, so that the
    planner knows their true size and leaves the wide rows in place if it is
    small. Beyond, only rows of ``base`` within the key range of ``new`` are shuffled.
    Sites number their rows from one, so a small site reaches few of a big one's,
    and the scan skips to them by the key statistics of the files. ``profile`` is
    that of ``new`` where it is known, as it is of rows that are stored; others are
    stored first, as they are read several times.
    """
    if profile is None:
        new = settled(new)
        profile = key_profile(new, key)
    if profile.rows == 0:
        return base
    new = collapse_repeats(new, key, update, order, profile).select(*base.columns)
    in_range = F.col(key).between(profile.low, profile.high)
    near = base.where(in_range)
    # The planner takes one column of a wide stored table for smaller than it is, and would
    # collect and broadcast millions of keys: only those that few new rows have may be.
    keys = near.select(key)
    if profile.rows <= split_above:
        keys = keys.join(new.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"), "left_semi")
    else:
        keys = keys.hint("merge")
    added = new.join(keys, key, "left_anti").select(*base.columns)
    if not update:
        return base.unionByName(added)
    fresh = new.select(F.col(key).alias("_key"), F.struct(*update).alias("_fresh"))
    if profile.rows <= split_above:
        met, fresh = base, settled(fresh)
    else:
        met = near
    known = F.col("_key").isNotNull()
    updated = met.join(fresh, met[key] == fresh["_key"], "left").select(
        *[
            F.when(known, F.col(f"_fresh.{c}")).otherwise(met[c]).alias(c)
            if c in update
            else met[c]
            for c in base.columns
        ]
    )
    if met is near:
        # Exactly the rest, also where the range or a key is NULL.
        updated = updated.unionByName(base.where(~F.coalesce(in_range, F.lit(False))))
    return updated.unionByName(added)


def insert_ignore(
    base: DataFrame, new: DataFrame, key: str = "id", order: Column | None = None
) -> DataFrame:
    """``base`` plus the rows of ``new`` with unknown keys; the first row of a key wins."""
    return merge_upsert(base, new, key, order=order)
