"""Nearest vectors by inner product with cross-polytope hashing.

A vector's direction is turned by three rounds of random signs and a fast Hadamard
transform, and falls to the signed axis nearest to it. Each table has two such rotations, and
the pair of axes is the vector's cell. A query scores a cell by the sum of its nearness to both
axes and probes, in each of several tables, its best ``PROBED`` share of all cells; the vectors
found are ranked by their exact inner product in double precision. Only vectors in probed cells
are multiplied.

Inner product and angle agree among vectors of one length, so the index is kept apart by
length, in bands of a factor sqrt(2): every query searches all bands.

Equal vectors are one entry that knows the smallest ``k + 1`` of its ids, all that a result
can need; copies are put together batch by batch before they are shuffled. Entries are dealt
to blocks of neighbouring cells, which become narrower as the table grows; a query goes to the
blocks that hold a cell it probes. Where neighbouring cells alone fill a block, it is split by
a hash, so a crowded cell is many tasks. A query that finds fewer than ``k`` vectors is
searched again in all cells.

Rows take no part whose id or vector is null, whose vector is zero, holds a null or a
non-finite number, or is not as long as most are. Rows equal in id and vector are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch

TABLES = 4
PROBED = 0.18  # of a table's cells
GROUPS = 8  # ranges of first axes in a table
BLOCK_ROWS = 8192
SEED = 31


def rotated(unit: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The directions under a table's pseudo-rotation, padded to a power of two."""
    width = 1 << max(0, unit.shape[1] - 1).bit_length()
    out = np.zeros((len(unit), width))
    out[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], size=(3, width))
    for round_ in range(3):
        out = out * signs[round_]
        half = 1
        while half < width:
            pair = out.reshape(len(out), -1, 2, half)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2)
            out = out.reshape(-1, width)
            half *= 2
        out = out / np.sqrt(width)
    return out


def axis_scores(unit: np.ndarray, rotation: int) -> np.ndarray:
    """How near each direction is to each signed axis; axis a is number 2a, -a is 2a + 1."""
    turned = rotated(unit, rotation)
    return np.stack([turned, -turned], axis=2).reshape(len(unit), -1)


def cell_scores(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearness to the first and to the second axes of a table; a cell's is their sum."""
    return axis_scores(unit, 2 * table), axis_scores(unit, 2 * table + 1)


def least_scores(first: np.ndarray, second: np.ndarray, share: float) -> np.ndarray:
    """For each direction the score that about ``share`` of all cells reach, found by halving."""
    if share >= 1:
        return np.full(len(first), -np.inf)
    wanted = max(1, round(share * first.shape[1] * second.shape[1]))
    out = np.empty(len(first))
    for i, (a, b) in enumerate(zip(first, np.sort(second, axis=1), strict=True)):
        low, high = a.min() + b[0], a.max() + b[-1]
        for _ in range(24):
            middle = (low + high) / 2
            if np.sum(len(b) - np.searchsorted(b, middle - a)) >= wanted:
                low = middle
            else:
                high = middle
        out[i] = low
    return out


def block_products(
    rows: np.ndarray, axes: tuple[np.ndarray, np.ndarray], vectors: np.ndarray,
    scores: tuple[np.ndarray, np.ndarray], least: np.ndarray,
) -> np.ndarray:
    """Inner products of queries with the rows in cells they probe, minus infinity elsewhere.

    Rows come sorted by their ``axes``; each cell is one slice, multiplied by its queries only.
    """
    out = np.full((len(vectors), len(rows)), -np.inf)
    new = (np.diff(axes[0]) != 0) | (np.diff(axes[1]) != 0)
    begins = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows)]])
    for low, high in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        asking = np.flatnonzero(scores[0][:, axes[0][low]] + scores[1][:, axes[1][low]] >= least)
        if len(asking):
            out[asking, low:high] = vectors[asking] @ rows[low:high].T
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _valid(rows: DataFrame, id: str, vector: str) -> tuple[DataFrame, int]:
    given = rows.schema[vector].dataType.simpleString()
    kind = given if given == "array<double>" else "array<float>"
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector"))
    good = rows.where(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths["n"] if lengths else 0
    # -0.0 becomes 0.0, so that equal vectors are equal as keys.
    clean = F.transform("vector", lambda x: x + F.lit(0.0).cast("float")).cast(kind)
    return good.where(F.size("vector") == width).select("vec_id", clean.alias("vector")), width


def _kind(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.simpleString()


def _entries(good: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``entry`` (the smallest id), the ``ids`` that matter, the vector."""
    kind, number = _kind(good), np.float64 if _kind(good) == "array<double>" else np.float32

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("vector")).astype(number)
            keys = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
            ids = batch.column("vec_id").to_numpy()
            order = np.lexsort((ids, np.unique(keys, return_inverse=True)[1]))
            new = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
            lists = [np.unique(x)[: k + 1] for x in np.split(ids[order], new[1:])]
            yield pa.RecordBatch.from_pydict(
                {
                    "vector": pa.array(list(rows[order[new]]), pa.list_(pa.from_numpy_dtype(number))),
                    "ids": pa.array(lists, pa.list_(pa.int64())),
                }
            )

    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    partial = good.mapInArrow(together, f"vector {kind}, ids array<long>")
    salted = partial.groupBy("vector", F.pmod(F.hash("ids"), F.lit(64)).alias("salt")).agg(merged.alias("ids"))
    return salted.groupBy("vector").agg(merged.alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "vector")


def _hashed(entries: DataFrame, tables: int) -> DataFrame:
    """A row for each entry and table: band of length, the cell's two axes."""

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("vector"))
            norms = np.linalg.norm(rows, axis=1)
            band = np.floor(2 * np.log2(norms) + 0.5).astype(np.int32)
            for table in range(tables):
                first, second = cell_scores(rows / norms[:, None], table)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("entry"),
                        batch.column("vector"),
                        pa.array(band),
                        pa.array(np.full(len(rows), table, np.int32)),
                        pa.array(first.argmax(axis=1).astype(np.int32)),
                        pa.array(second.argmax(axis=1).astype(np.int32)),
                    ],
                    names=["entry", "vector", "band", "table", "first", "second"],
                )

    return entries.select("entry", "vector").mapInArrow(
        hash_, f"entry long, vector {_kind(entries)}, band int, table int, first int, second int"
    )


def _blocks(hashed: DataFrame) -> DataFrame:
    """Blocks of about ``BLOCK_ROWS`` entries: a range of first axes, some second ones, and the
    parts of a block whose second axis is crowded.

    There are at most bands * tables * GROUPS * axes of them, whatever the number of vectors.
    """
    place = ["band", "table", "group"]
    cells = hashed.groupBy(*place, "second").count()
    before = F.sum("count").over(
        Window.partitionBy(*place).orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    )
    number = F.floor(F.coalesce(before, F.lit(0)) / BLOCK_ROWS).cast("int")
    blocks = cells.withColumn("block", number).groupBy(*place, "block").agg(
        F.sort_array(F.collect_list("second")).alias("seconds"), F.sum("count").alias("rows")
    )
    return blocks.withColumn("parts", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")).drop("rows")


def _search(
    hashed: DataFrame, queries: DataFrame, k: int, width: int, tables: int, probed: float
) -> DataFrame:
    """The best ``k + 1`` entries of each query entry among those in the cells it probes."""
    per_group = -(-2 * (1 << max(0, width - 1).bit_length()) // GROUPS)
    group = (F.col("first") / per_group).cast("int")
    hashed = hashed.withColumn("group", group)
    blocks = Scratch(hashed.sparkSession).keep(_blocks(hashed))
    of_second = blocks.select("band", "table", "group", "block", "parts", F.explode("seconds").alias("second"))
    members = hashed.join(F.broadcast(of_second), ["band", "table", "group", "second"]).withColumn(
        "part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int")
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("vector"))
            unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
            for table in range(tables):
                first, second = cell_scores(unit, table)
                least = least_scores(first, second, probed)
                for g in range(-(-first.shape[1] // per_group)):
                    best = first[:, g * per_group : (g + 1) * per_group].max(axis=1)
                    open_ = best[:, None] + second >= least[:, None]
                    some = np.flatnonzero(open_.any(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("entry").take(pa.array(some)),
                            batch.column("vector").take(pa.array(some)),
                            pa.array(np.full(len(some), table, np.int32)),
                            pa.array(np.full(len(some), g, np.int32)),
                            pa.array([np.flatnonzero(open_[i]) for i in some], pa.list_(pa.int32())),
                            pa.array(least[some]),
                        ],
                        names=["entry", "vector", "table", "group", "probes", "least"],
                    )

    asked = queries.select("entry", "vector").mapInArrow(
        probe, f"entry long, vector {_kind(queries)}, table int, `group` int, probes array<int>, least double"
    )
    place = ["band", "table", "group", "block", "part"]
    asked = asked.join(F.broadcast(blocks), ["table", "group"])
    asked = asked.where(F.arrays_overlap("probes", "seconds")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    asked = asked.select(*[F.col(c).alias(f"of_{c}") for c in place], "entry", "vector", "least")

    def rank(block: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(block) and len(asking):
            table = block.column("table")[0].as_py()
            block = block.sort_by([("first", "ascending"), ("second", "ascending"), ("entry", "ascending")])
            rows = _matrix(block.column("vector").combine_chunks())
            ids = block.column("entry").to_numpy()
            axes = block.column("first").to_numpy(), block.column("second").to_numpy()
            wanted = asking.column("vector").combine_chunks()
            asked_ids, least = asking.column("entry").to_numpy(), asking.column("least").to_numpy()
            for low in range(0, len(asking), 512):
                some = slice(low, low + 512)
                vectors = _matrix(wanted[some])
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                scores = block_products(rows, axes, vectors, cell_scores(unit, table), least[some])
                # Every score that ties with the last place stays; exact order comes later.
                if scores.shape[1] > k + 1:
                    last = np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)]
                    keep = (scores >= last[:, None]) & (scores > -np.inf)
                else:
                    keep = scores > -np.inf
                q, c = np.nonzero(keep)
                out.append((asked_ids[low + q], ids[c], scores[q, c]))
        columns = [np.concatenate(x) if out else np.zeros(0) for x in (zip(*out) if out else [(), (), ()])]
        return pa.table(
            {
                "query": pa.array(columns[0], pa.int64()),
                "entry": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    return (
        members.select(*place, "entry", "vector", "first", "second")
        .groupBy(*place)
        .cogroup(asked.groupBy(*[f"of_{c}" for c in place]))
        .applyInArrow(rank, "query long, entry long, score double")
    )


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probed: float = PROBED,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row of ``queries``, rows
    of the same table, the ``k`` rows of ``rows`` with the largest inner product that the index
    finds, itself left out; all if there are fewer. Equal scores stand by ``vec_id``.
    """
    scratch = Scratch(rows.sparkSession)
    good, width = _valid(rows, id, vector)
    entries = scratch.keep(_entries(good, k))
    asking, _ = _valid(queries, id, vector)
    asking = asking.where(F.size("vector") == width).distinct()
    asking = asking.join(entries.select("entry", "vector"), "vector")
    asking = scratch.keep(asking.select(F.col("vec_id").alias("query_id"), "entry"))
    unique = asking.select("entry").distinct().join(entries.select("entry", "vector"), "entry")
    hashed = _hashed(entries, tables)
    found = _best(_search(hashed, unique, k, width, tables, probed), entries, k)
    found = scratch.keep(found)
    total = entries.agg(F.sum(F.size("ids"))).first()[0] or 0
    # Ids beyond the k + 1 of an entry can't be needed, so this many suffice.
    enough = min(k + 1, int(total))
    short = unique.join(found.where(F.size("best") >= enough), unique["entry"] == found["query"], "left_anti")
    short = scratch.keep(short)
    if not short.isEmpty():
        again = _best(_search(hashed.where("table = 0"), short, k, width, 1, 1.0), entries, k)
        found = found.join(short, found["query"] == short["entry"], "left_anti").unionByName(again)
    ranked = asking.join(found, F.col("entry") == F.col("query")).select(
        "query_id",
        F.posexplode(
            F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
        ).alias("place", "x"),
    )
    return ranked.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"),
    )


def _best(candidates: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """Each query entry's best ``k + 1`` ids in order, as one array."""
    once = candidates.groupBy("query", "entry").agg(F.max("score").alias("score"))
    # Spark keeps the first k + 1 of each task before it shuffles them.
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    best = once.withColumn("place", place).where(F.col("place") <= k + 1)
    ids = best.join(entries.select("entry", "ids"), "entry").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id", "score")))
    return ids.groupBy("query").agg(F.slice(order, 1, k + 1).alias("best"))
