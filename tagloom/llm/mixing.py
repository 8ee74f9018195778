"""Mixing sources to target weights with whole numbers of equal blocks.

The mix holds ``share`` times all words. Each source's target is its part of that by weight,
but at most ``most`` times its own words; what is cut off goes to the others by weight, until
none is above. The mix is dealt out in blocks of equal words, ``LEAST_BLOCKS`` for the smallest
target at least, so a source of any size has its part: sources get blocks by highest
quotients (Sainte-Lague, divisors 1, 3, 5, ...), and a source's blocks are dealt out the same
way to its shards, sets of documents that a seeded hash puts together. In each shard the
documents stand in a seeded order; its quota takes them from the front, as often as it goes
round, and cuts the document in which the last block ends. What is above ``most`` times a
shard's words goes to the source's other shards.

To the driver come one row per source and nothing else. A shard has about ``shard_words``
words whatever its source's size, so a source with most rows is many shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.words import slices, words_of

WEIGHTS = (3, 1, 2)
BLOCKS = 1 << 16
LEAST_BLOCKS = 64
SHARD_WORDS = 1 << 20
SEED = 23


def with_word_counts(docs: DataFrame, text: str, keep_text: bool = False) -> DataFrame:
    """The other columns and ``size``, the number of words of each text; 0 for a null."""
    columns = [c for c in docs.columns if keep_text or c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, text):
                sizes = pa.array(words_of(some.column(text)).counts(), pa.int64())
                kept = [some.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, sizes], names=[*columns, "size"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.mapInArrow(count, f"{schema}, size long")


def targets(
    sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> list[float]:
    """Words wanted of each source; weights repeat over the sources in their order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        each = left / sum(weight[i] for i in free)
        above = [i for i in free if each * weight[i] > most * sizes[i]]
        if not above:
            for i in free:
                out[i] = each * weight[i]
            break
        for i in sorted(above):
            out[i] = most * sizes[i]
            left -= out[i]
            free.remove(i)
    return out


def apportioned(weights: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients weight / (2 * seats so far + 1); ties to the first."""
    weights = np.asarray(weights, dtype=np.float64)
    total = weights.sum()
    given = np.zeros(len(weights), dtype=np.int64)
    if total <= 0 or seats <= 0:
        return given
    # Rounding at the divisor total / seats is within one seat each; the rest is moved singly.
    given = np.floor(weights * (seats / total) + 0.5).astype(np.int64)
    more = seats - int(given.sum())
    if more > 0:
        heap = [(-w / (2 * g + 1), i) for i, (w, g) in enumerate(zip(weights, given, strict=True))]
        heapq.heapify(heap)
        for _ in range(more):
            _, i = heap[0]
            given[i] += 1
            heapq.heapreplace(heap, (-weights[i] / (2 * given[i] + 1), i))
    elif more < 0:
        heap = [(w / (2 * g - 1), -i) for i, (w, g) in enumerate(zip(weights, given, strict=True)) if g]
        heapq.heapify(heap)
        for _ in range(-more):
            _, i = heap[0]
            given[-i] -= 1
            if given[-i]:
                heapq.heapreplace(heap, (weights[-i] / (2 * given[-i] - 1), i))
            else:
                heapq.heappop(heap)
    return given


@dataclass(frozen=True)
class Mix:
    """Options of a mix; ``blocks`` is how many equal blocks make up the whole at least."""

    weights: tuple[int, ...] = WEIGHTS
    share: float = 1.5
    most: float = 2.0
    blocks: int = BLOCKS
    shard_words: int = SHARD_WORDS
    seed: int = SEED


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: the id, ``size`` (words), ``source_size``, ``target`` (its
    source's), ``taken`` (words the mix takes, repeats counted) and the columns in ``carry``.

    Sources stand in code point order, a null source last. Nothing is taken from a text
    without words. Documents equal in id and text are interchangeable. An empty table gives
    an empty mix.
    """
    mix = mix or Mix()
    extra = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)]
    rows = docs.select(
        F.col(id).alias("_id"), F.col(source).alias("_source"), F.col(text).alias("_text"), *extra
    )
    sums = with_word_counts(rows.select("_source", "_text"), "_text").groupBy("_source")
    found = sorted(
        ((r[0], int(r[1])) for r in sums.agg(F.sum("size")).collect()),
        key=lambda x: (x[0] is None, x[0] or ""),
    )
    spark = docs.sparkSession
    wanted = targets([n for _, n in found], mix.weights, mix.share, mix.most)
    smallest = min((t for t in wanted if t > 0), default=0)
    block = max(1, min(int(sum(wanted)) // mix.blocks, int(smallest) // LEAST_BLOCKS))
    seats = apportioned(np.array(wanted), round(sum(wanted) / block))
    plan = spark.createDataFrame(
        [
            (i, name, n, float(t), int(q), max(1, -(-n // mix.shard_words)))
            for i, ((name, n), t, q) in enumerate(zip(found, wanted, seats, strict=True))
        ],
        "_number int, _name string, source_size long, target double, _seats long, _shards int",
    )
    # The mixing plan has one row per source; the weights name each of them.
    if len(found) <= 10_000:
        plan = F.broadcast(plan)
    key = F.xxhash64(F.lit(mix.seed), F.col("_id"), F.col("_text"))
    counted = with_word_counts(rows.withColumn("_order", key), "_text")
    counted = counted.join(plan, F.col("_source").eqNullSafe(F.col("_name"))).withColumn(
        "_shard", F.pmod(F.col("_order"), F.col("_shards")).cast("int")
    )
    most = mix.most

    def quotas(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("_shard")
        sizes = shards["_words"].to_numpy()
        seats, highest = int(shards["_seats"].iloc[0]), (most * sizes).astype(np.int64)
        quota = np.minimum(apportioned(sizes, seats) * block, highest)
        left = min(seats * block, int(highest.sum())) - int(quota.sum())
        shards["_quota"] = quota + apportioned(highest - quota, left)
        return shards[["_number", "_shard", "_words", "_quota"]]

    per_shard = counted.groupBy("_number", "_seats", "_shard").agg(F.sum("size").alias("_words"))
    quota = per_shard.groupBy("_number").applyInPandas(
        quotas, "_number int, _shard int, _words long, _quota long"
    )
    # A shard's other order bits decide: the low ones chose the shard.
    order = Window.partitionBy("_number", "_shard").orderBy(
        F.xxhash64(F.lit(mix.seed + 1), F.col("_order")), "_id", "_order"
    )
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("_before", F.coalesce(before, F.lit(0)))
    placed = placed.join(quota, ["_number", "_shard"])
    rounds = F.when(F.col("_words") > 0, F.floor(F.col("_quota") / F.col("_words"))).otherwise(0)
    rest = F.col("_quota") - rounds * F.col("_words") - F.col("_before")
    taken = rounds * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.select(
        F.col("_id").alias(id),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)],
    )


def mixed_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix | None = None,
) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and of one that a block's
    end cuts its first words as they stand. Columns are the input's, whatever their names; a
    column ``n_chars`` follows a text that was cut.
    """
    columns = docs.columns
    renamed = docs.withColumnsRenamed({c: f"in_{c}" for c in columns})
    others = tuple(f"in_{c}" for c in columns if c != id)
    taken = mixed(renamed, f"in_{id}", f"in_{text}", f"in_{source}", mix, carry=others)
    names = [f"in_{c}" for c in columns]

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, f"in_{text}"):
                size, wanted = (some.column(c).to_numpy() for c in ("size", "taken"))
                whole = wanted // np.maximum(size, 1)
                out = some.select(names).take(pa.array(np.repeat(np.arange(len(size)), whole)))
                yield out
                for row in np.flatnonzero(wanted - whole * size):
                    yield _cut(some.slice(row, 1).select(names), int(wanted[row] - whole[row] * size[row]))

    def _cut(row: pa.RecordBatch, n: int) -> pa.RecordBatch:
        words = words_of(row.column(f"in_{text}"))
        piece = words.data[: words.ends[n - 1]].tobytes().decode()
        arrays = {c: row.column(c) for c in names}
        arrays[f"in_{text}"] = pa.array([piece], arrays[f"in_{text}"].type)
        if "in_n_chars" in arrays:
            arrays["in_n_chars"] = pa.array([len(piece)], arrays["in_n_chars"].type)
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=names)

    chosen = taken.where("taken > 0")
    schema = ", ".join(f"`in_{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = chosen.select(*names, "size", "taken").mapInArrow(repeat, schema)
    return out.select(*[F.col(f"in_{c}").alias(c) for c in columns])
