"""Shuffled shards of a table by an external shuffle in two passes.

Pass one scatters the rows over buckets of about ``bucket_bytes`` by a seeded hash of the
id. Pass two loads one bucket at a time, shuffles it by Fisher-Yates from a seed of its own
and gives its rows their places: a bucket begins where the one before it ends, and shards
cut the whole sequence into runs whose row counts differ by one at most.

Where buckets begin is a running sum over a table of counts, in ranges of ``RANGE`` buckets.
A bucket with more than ``CROWDED`` times its bytes, as a repeated id makes, is scattered again
by all columns, and if that leaves it crowded, as equal rows do, by the rows' places in the
input; those are written down once, so that a lost task changes nothing. Only in that case does
the outcome depend on how the input is split, and only as to where buckets begin.

A null id is scattered by its text; a null or empty text has one byte, a very long one fills a
bucket alone. Rows equal in id are ordered by text, then by all other columns, before they are
shuffled; rows equal in all are interchangeable. An empty table gives no rows. Columns called
``shard`` and ``slot`` in the input give way to the operator's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, pieces

BUCKET_BYTES = 8 << 20
CROWDED = 4
RANGE = 4096
SEED = 11


def _whole(docs: DataFrame) -> Column:
    """A hash of all columns that have one; nulls count by their column."""
    named = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*named, *[c.isNull() for c in named])


def _split(rows: DataFrame, salt: Column, bucket_bytes: int, scratch: Scratch) -> DataFrame:
    """The rows, those of crowded buckets dealt over more of them by ``salt``."""
    loads = rows.groupBy("_bucket").agg(F.sum("_size").alias("load"))
    parts = F.ceil(F.col("load") / bucket_bytes).alias("_parts")
    crowded = scratch.keep(loads.where(F.col("load") > CROWDED * bucket_bytes).select("_bucket", parts))
    number = crowded.count()
    if not number:
        return rows
    # At most one in CROWDED buckets; beyond this many, both sides are shuffled.
    known = F.broadcast(crowded) if number <= 100_000 else crowded.hint("merge")
    joined = rows.withColumn("_salt", salt).join(known, "_bucket", "left")
    dealt = F.xxhash64("_bucket", F.pmod(F.col("_salt"), F.col("_parts")))
    bucket = F.when(F.col("_parts").isNull(), F.col("_bucket")).otherwise(dealt)
    return scratch.keep(joined.withColumn("_bucket", bucket).drop("_parts", "_salt"))


def _begins(rows: DataFrame, buckets: int) -> DataFrame:
    """``_of`` (bucket) and ``begin``, the number of rows in the buckets before it."""
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    # By a hash, so that buckets made of a crowded one stand among the others.
    counts = counts.withColumn("hash", F.xxhash64(F.lit("order"), "_bucket"))
    counts = counts.withColumn("range", F.pmod("hash", F.lit(pieces(buckets, RANGE))))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row for each RANGE buckets, 32 GB of text.
    sums = counts.groupBy("range").agg(F.sum("n").alias("n"))
    earlier = sums.select("range", F.sum("n").over(before.orderBy("range")).alias("earlier"))
    inside = F.sum("n").over(before.partitionBy("range").orderBy("hash", "_bucket"))
    placed = counts.withColumn("inside", inside).join(earlier, "range")
    begin = F.coalesce("earlier", F.lit(0)) + F.coalesce("inside", F.lit(0))
    return placed.select(F.col("_bucket").alias("_of"), begin.alias("begin"))


def sharded(
    docs: DataFrame,
    shards: int = 16,
    id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows with ``shard`` (from 0) and ``slot`` (their place in the shard, gapless
    from 0). The law is ``rows``: shards differ by one row at most.
    """
    docs, scratch = docs.drop("shard", "slot"), Scratch(docs.sparkSession)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    total, everything = docs.agg(F.sum(size), F.count(F.lit(1))).first()
    buckets = pieces(total or 0, bucket_bytes)
    # A null does not enter a hash: the text alone then tells rows apart.
    key = F.xxhash64(F.lit(seed), F.when(F.col(id).isNull(), F.col(text)), F.col(id))
    rows = docs.withColumns(
        {"_bucket": F.pmod(key, F.lit(buckets)), "_size": size, "_crc": F.xxhash64(F.col(text)), "_row": _whole(docs)}
    )
    rows = _split(rows, F.xxhash64(F.lit(seed), "_row"), bucket_bytes, scratch)
    rows = _split(rows, F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), bucket_bytes, scratch)
    names = docs.columns

    def shuffle(rows: pa.Table, begins: pa.Table) -> pa.Table:
        number, first = begins.column("_of")[0].as_py(), begins.column("begin")[0].as_py()
        # The order of arrival is not fixed, so the rows are ordered before they are shuffled.
        ordered = rows.take(pc.sort_indices(rows, [(x, "ascending") for x in (id, "_crc", "_row")]))
        ordered = ordered.take(np.random.default_rng([seed, number % 2**64]).permutation(len(rows)))
        place = first + np.arange(len(rows))
        shard_begins = np.arange(shards) * everything // shards
        # The last of the shards that begin there: those before it are empty.
        shard = np.searchsorted(shard_begins, place, side="right") - 1
        return pa.Table.from_arrays(
            [
                *[ordered.column(c) for c in names],
                pa.array(shard, pa.int32()),
                pa.array(place - shard_begins[shard], pa.int64()),
            ],
            names=[*names, "shard", "slot"],
        )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    begins = _begins(rows, buckets).groupBy("_of")
    together = rows.drop("_size").groupBy("_bucket").cogroup(begins)
    return together.applyInArrow(shuffle, f"{schema}, shard int, slot long")


def write_shards(docs: DataFrame, path: str, **options: int) -> DataFrame:
    """Writes the shards as folders ``shard=0``, ``shard=1``, ... and reads them back."""
    placed = sharded(docs, **options)
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)
