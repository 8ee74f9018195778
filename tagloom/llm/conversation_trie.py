"""The prefix trie of all conversations: its nodes, how often each prefix occurs and what sharing saves.

A node is a distinct sequence of a conversation's first d turns (role and text); the root is d = 0.

1. ``conversation_bands``: turns become slim rows (a 128-bit digest and a size), sorted over the whole table by
   conversation and turn, so that a conversation with a third of all turns lies in many tasks. Runs of a
   conversation become one row each and get their place by the counts of the runs before. Conversations may
   borrow the first turns of another one. They are cut into bands of ``BAND`` turns.
2. ``_classes``: equal conversations are one class with a count, their ids' hash and the least id for all.
3. ``_shards``: classes, sorted by their digests, are dealt in runs of ``SHARD`` turns. A shard's
   trie is written as balanced parentheses (parentheses.py): ``find_close`` delimits each subtree, the
   rank of pairs () counts its leaves, and running sums over the opening brackets give conversations and savings.
4. ``_merged``: neighbouring shards share no nodes but the prefixes that the last conversation of one has in common
   with the first of the next. What each shard knows of such a spine is counted so that it can be added
   up: a node's bytes and a child count in the first shard that has it only.

Conversations of more than one band that are alone after it are chains, and are listed without a trie. Where
several share a whole band, the next band's trie is built first and what is below its root counts for the last node of
the band. So a task holds ``SHARD`` turns and one band, whatever the lengths.

Null roles and texts are empty, null turns come first, and turns with one number go by their digests (equal ones
are equal rows, in any order). Every row is a turn, repeated or not. Rows without conv_id are no
conversation's and take no part. An empty table has no conversation and no node, not even the root. Only the four columns
are read, so that other names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.parentheses import Parentheses, RangeMinimum
from tagloom.llm.scratch import Scratch

BAND = 1 << 16  # turns of a conversation that stand together
SHARD = 1 << 18  # turns in one trie, and one more band at most

_DIGEST = 16  # bytes that stand for a role and a text
_SIZE = 4  # bytes that a text's size takes
_NOTHING = hashlib.sha256(b"").hexdigest()

DONE, PENDING, SPINE = 0, 1, 2  # what a shard knows of a node: all; all but its parent; its own part

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


@dataclass(frozen=True)
class Borrowing:
    """Conversation c begins with the first h turns of c - c % family, h = crc32(c) % spread, and goes on
    with its own turns after its first h."""

    family: int
    spread: int

    def base(self) -> Column:
        return F.col("conv_id") - F.col("conv_id") % self.family

    def turns(self) -> Column:
        return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % self.spread).cast("int")


def _binary_rows(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of a binary column, and where each row's begin and end."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (data.to_pybytes() if data else b"")[offsets[0] : offsets[-1]], offsets - offsets[0]


# --- conversations as rows -----------------------------------------------------


def _slim(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("int").alias("size"),
        F.rand(7).alias("salt"),  # deals rows that are equal otherwise; their order means nothing
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as one row for each conversation of a batch."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv_id").to_numpy(zero_copy_only=False)
        data, _ = _binary_rows(batch.column("digest"))
        sizes = batch.column("size").to_numpy(zero_copy_only=False).astype("<i4").tobytes()
        starts = np.flatnonzero(np.diff(convs, prepend=convs[0] - 1) != 0)
        ends = np.append(starts[1:], len(convs))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(convs[starts], pa.int64()),
                pa.array(np.full(len(starts), part), pa.int32()),
                pa.array(np.arange(number, number + len(starts)), pa.int64()),
                pa.array(ends - starts, pa.int64()),
                pa.array([data[_DIGEST * a : _DIGEST * b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
                pa.array([sizes[_SIZE * a : _SIZE * b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
            ],
            names=["conv_id", "part", "number", "turns", "digests", "sizes"],
        )
        number += len(starts)


def _cut(band: int):
    """Runs with what they borrow, as rows of one band each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("conv_id", "band", "start", "digests", "sizes")}
            for r in batch.to_pylist():
                skip = max(0, r["borrow"] - r["begin"])
                digests, sizes = r["digests"][_DIGEST * skip :], r["sizes"][_SIZE * skip :]
                place = max(r["begin"], r["borrow"]) - r["borrow"] + r["borrowed"]
                if r["begin"] == 0:
                    place = 0
                    digests = (r["head_digests"] or b"")[: _DIGEST * r["borrowed"]] + digests
                    sizes = (r["head_sizes"] or b"")[: _SIZE * r["borrowed"]] + sizes
                at, n = 0, len(sizes) // _SIZE
                while at < n or (r["begin"] == 0 and at == 0):
                    number, start = divmod(place + at, band)
                    to = min(n, at + band - start)
                    row = (r["conv_id"], number, start, digests[_DIGEST * at : _DIGEST * to], sizes[_SIZE * at : _SIZE * to])
                    for values, value in zip(out.values(), row, strict=True):
                        values.append(value)
                    at = max(to, 1)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    return cut


def _joined(parts: str, name: str) -> Column:
    return F.aggregate(parts, F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p[name]))


def conversation_bands(turns: DataFrame, scratch: Scratch, borrowing: Borrowing | None, band: int) -> DataFrame:
    """``conv_id, band, digests, sizes`` of every conversation; one without turns has an empty band 0."""
    order = ("conv_id", F.asc_nulls_first("turn"), "digest", "salt")
    slim = scratch.keep(_slim(turns))
    runs = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "size")
    runs = scratch.keep(
        runs.mapInArrow(_runs, "conv_id long, part int, number long, turns long, digests binary, sizes binary")
    )
    scratch.drop(slim)
    key = ["conv_id", "part", "number"]
    before = Window.partitionBy("conv_id").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    places = runs.select(*key, "turns").withColumn("begin", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    if borrowing is None:
        placed = places.select(*key, "begin").withColumns(
            {"borrow": F.lit(0), "borrowed": F.lit(0), "head_digests": F.lit(None).cast("binary"), "head_sizes": F.lit(None).cast("binary")}
        )
    else:
        places = scratch.keep(places)
        most = borrowing.spread - 1
        firsts = places.where((F.col("begin") < most) & (F.col("conv_id") == borrowing.base()))
        heads = firsts.join(runs.drop("turns"), key).groupBy(F.col("conv_id").alias("base")).agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "begin",
                        F.substring("digests", 1, most * _DIGEST).alias("digests"),
                        F.substring("sizes", 1, most * _SIZE).alias("sizes"),
                    )
                )
            ).alias("parts")
        )
        heads = heads.select("base", _joined("parts", "digests").alias("head_digests"), _joined("parts", "sizes").alias("head_sizes"))
        own = places.where("begin = 0").select("conv_id", borrowing.base().alias("base"), borrowing.turns().alias("borrow"))
        known = F.coalesce(F.octet_length("head_sizes") / _SIZE, F.lit(0)).cast("int")
        own = scratch.keep(own.join(heads, "base", "left").withColumn("borrowed", F.least("borrow", known)).drop("base"))
        first = places.where("begin = 0").join(own, "conv_id")
        # A conversation's later runs need its two numbers only.
        later = places.where("begin > 0").join(own.drop("head_digests", "head_sizes"), "conv_id")
        placed = first.unionByName(later, allowMissingColumns=True).drop("turns")
    pieces = runs.drop("turns").join(placed, key).mapInArrow(
        _cut(band), "conv_id long, band long, start long, digests binary, sizes binary"
    )
    bands = pieces.groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("start", "digests", "sizes"))).alias("parts"))
    return scratch.keep(
        bands.select("conv_id", "band", _joined("parts", "digests").alias("digests"), _joined("parts", "sizes").alias("sizes"))
    )


# --- classes of equal conversations ----------------------------------------------


def _chains(bands: DataFrame, scratch: Scratch, band: int) -> DataFrame:
    """Every band without its turns: the key of what comes before it (``root``) and up to its end."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _binary_rows(batch.column("sizes"))
            sums = np.concatenate([[0], np.cumsum(np.frombuffer(data, dtype="<i4"), dtype=np.int64)])
            at = at // _SIZE
            yield batch.drop_columns(["sizes"]).append_column("bytes", pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64()))

    # The band's number stands in its hash, so that the order counts though the hashes are combined by xor.
    slim = bands.select(
        "conv_id",
        "band",
        (F.octet_length("sizes") / _SIZE).cast("long").alias("turns"),
        F.xxhash64("band", "digests").alias("h1"),
        F.xxhash64(F.lit("second"), "digests", "band").alias("h2"),
        "sizes",
    )
    slim = slim.mapInArrow(total, "conv_id long, band long, turns long, h1 long, h2 long, bytes long")
    so_far = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("long")
    chained = slim.withColumns(
        {
            "root1": F.coalesce(F.bit_xor("h1").over(so_far), zero),
            "root2": F.coalesce(F.bit_xor("h2").over(so_far), zero),
            "before": F.coalesce(F.sum("bytes").over(so_far), zero),
            "all_bytes": F.sum("bytes").over(whole),
            "more": F.max("band").over(whole) > F.col("band"),
        }
    )
    return scratch.keep(
        chained.select(
            "conv_id", "band", "turns", "bytes", "before", "all_bytes", "more", "root1", "root2",
            F.col("root1").bitwiseXOR(F.col("h1")).alias("end1"),
            F.col("root2").bitwiseXOR(F.col("h2")).alias("end2"),
            (F.col("band") * band + F.col("turns")).alias("length"),
        )
    )


_CLASS = ["end1", "end2", "length"]


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (class, conv_id) rows as one row for each class of a batch, with its ids joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _CLASS])
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(keys) != 0).any(axis=0)]))
        ends = np.append(starts[1:], batch.num_rows)
        ids = batch.column("conv_id")
        texts = [str(i) for i in ids.to_pylist()]
        joined = [",".join(texts[a:b]) if b - a > 1 else texts[a] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        firsts = pa.array(starts, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(firsts) for c in _CLASS), ids.take(firsts), pa.array(ends - starts, pa.int64()), pa.array(joined)],
            names=[*_CLASS, "conv_id", "n", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each class out of its runs in order; ids are hashed as they pass."""
    state: list | None = None
    for batch in batches:
        done: list[list] = []
        columns = [batch.column(c).to_pylist() for c in (*_CLASS, "conv_id", "n", "ids")]
        for end1, end2, length, conv, n, ids in zip(*columns, strict=True):
            key = (end1, end2, length)
            if state is not None and state[0] == key:
                state[2] += n
                state[3].update(b"," + ids.encode())
                continue
            if state is not None:
                done.append(state)
            state = [key, conv, n, hashlib.sha256(ids.encode())]
        yield _class_rows(done)
    if state is not None:
        yield _class_rows([state])


def _class_rows(states: list[list]) -> pa.RecordBatch:
    rows = [(*key, conv, n, ids.hexdigest()) for key, conv, n, ids in states]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [pa.int64()] * 5 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*_CLASS, "conv_id", "n", "ids_sha256"]
    )


def _classes(chains: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes of equal conversations: least ``conv_id``, count ``n`` and the hash of all their ids."""
    order = [*_CLASS, "conv_id"]
    ends = chains.where("not more").select(*order)
    kinds = "end1 long, end2 long, length long, conv_id long, n long"
    runs = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_id_runs, f"{kinds}, ids string")
    runs = runs.repartition(*_CLASS).sortWithinPartitions(*order)
    return scratch.keep(runs.mapInArrow(_hashed, f"{kinds}, ids_sha256 string").select("conv_id", "n", "ids_sha256"))


# --- shards and their tries ---------------------------------------------------------

_ROWS = (
    "root1 long, root2 long, digests binary, more boolean, conv_id long, n long, sizes binary, "
    "ids_sha256 string, below_children long, below_leaves long, below_saved long"
)
_FIELDS = [f.split(" ")[0] for f in _ROWS.split(", ")]
_SHARD_ROW = "part int, number int, {}, first binary, last binary".format(
    ", ".join("{} array<{}>".format(*f.split(" ")) for f in _ROWS.split(", "))
)


def _packed(most: int):
    """Sorted rows as one row of lists for each run of some ``most`` turns."""

    def path(batch: pa.RecordBatch, row: int) -> bytes:
        root = np.array([batch.column(c)[row].as_py() for c in ("root1", "root2")], dtype="<i8")
        return root.tobytes() + batch.column("digests")[row].as_py()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, weight = TaskContext.get().partitionId(), 0, [], 0

        def shard() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lists = [
                pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column(c)) for c in _FIELDS
            ]
            ends = [pa.array([path(whole, row)], pa.binary()) for row in (0, whole.num_rows - 1)]
            place = [pa.array([part], pa.int32()), pa.array([number], pa.int32())]
            return pa.RecordBatch.from_arrays([*place, *lists, *ends], names=["part", "number", *_FIELDS, "first", "last"])

        for batch in batches:
            _, at = _binary_rows(batch.column("digests"))
            weights = np.diff(at) // _DIGEST + 1
            low = 0
            while low < batch.num_rows:
                sums = weight + np.cumsum(weights[low:])
                high = low + min(int(np.searchsorted(sums, most)) + 1, batch.num_rows - low)
                held.append(batch.slice(low, high - low))
                weight = int(sums[high - low - 1])
                if weight >= most:
                    yield shard()
                    number, held, weight = number + 1, [], 0
                low = high
        if weight:
            yield shard()

    return pack


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many elements, the root included, each shard's ends have in common with its neighbours'."""

    def prefix(a: bytes | None, b: bytes | None) -> int:
        if a is None or b is None:
            return 0
        n = min(len(a), len(b)) // _DIGEST * _DIGEST
        x, y = (np.frombuffer(v[:n], dtype="<i8").reshape(-1, 2) for v in (a, b))
        differs = (x != y).any(axis=1)
        return int(differs.argmax()) if differs.any() else n // _DIGEST

    for batch in batches:
        rows = batch.to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("part"),
                batch.column("number"),
                pa.array([prefix(r["previous"], r["first"]) for r in rows], pa.int64()),
                pa.array([prefix(r["last"], r["following"]) for r in rows], pa.int64()),
            ],
            names=["part", "number", "shared_before", "shared_after"],
        )


def _keys(elements: np.ndarray, n: int) -> list[bytes]:
    """The keys of a path's first ``n`` nodes: digests of their prefixes."""
    state, out = hashlib.md5(), []
    for i in range(n):
        state.update(elements[i].tobytes())
        out.append(state.digest())
    return out


def shard_nodes(rows: pa.RecordBatch, shared_before: int, shared_after: int, root_is_spine: bool) -> dict[str, list | np.ndarray]:
    """The nodes of one shard's trie, in the order of their opening brackets."""
    columns = {c: rows.column(c) for c in _FIELDS}
    data, at = _binary_rows(columns["digests"])
    turns = np.frombuffer(data, dtype="<i8").reshape(-1, 2)
    lengths = np.diff(at) // _DIGEST + 1  # elements: the root's key and the turns
    n_rows, begins = len(lengths), np.cumsum(lengths) - lengths
    elements = np.empty((int(lengths.sum()), 2), dtype=np.int64)
    is_root = np.zeros(len(elements), dtype=bool)
    is_root[begins] = True
    elements[~is_root] = turns
    elements[begins, 0], elements[begins, 1] = columns["root1"].to_numpy(), columns["root2"].to_numpy()
    size = np.zeros(len(elements), dtype=np.int64)
    size[~is_root] = np.frombuffer(_binary_rows(columns["sizes"])[0], dtype="<i4")

    # How many elements each row has in common with the row before.
    row = np.repeat(np.arange(n_rows), lengths)
    place = np.arange(len(elements)) - begins[row]
    other = np.where(row > 0, begins[row - 1] + place, 0)
    differs = (row == 0) | (place >= lengths[row - 1])
    differs |= (elements != elements[np.where(differs, 0, other)]).any(axis=1)
    common = np.minimum.reduceat(np.where(differs, place, lengths[row]), begins)

    new = place >= common[row]  # elements that are nodes of their own
    closed = np.append(0, lengths[:-1]) - common
    counts = np.stack([closed, lengths - common], axis=1).ravel()
    brackets = np.repeat(np.tile([False, True], n_rows), counts)
    trie = Parentheses(np.concatenate([brackets, np.zeros(lengths[-1], dtype=bool)]))
    ends, leaf_pairs = trie.subtree_ends()
    depth, parent = trie.depths().astype(np.int64), trie.parents()
    size, nodes = size[new], len(ends)

    # A row ends at its last new node, or where the row before ended if it has none.
    terminal = np.cumsum(lengths - common) - 1
    n_at, least_at = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.iinfo(np.int64).max)
    np.add.at(n_at, terminal, columns["n"].to_numpy())
    np.minimum.at(least_at, terminal, columns["conv_id"].to_numpy())

    index = np.arange(nodes)
    before = (index < shared_before) & (index < lengths[0])  # the first row's nodes come first
    after = np.zeros(nodes, dtype=bool)
    last_path = np.zeros(int(lengths[-1]), dtype=np.int64)
    on_path = depth < lengths[-1]
    last_path[depth[on_path]] = index[on_path]  # the last node of each depth
    after[last_path[:shared_after]] = True

    def summed(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[ends] - sums[index]

    # What lies below a band's last node counts once, in the first shard that has it.
    more = columns["more"].to_numpy(zero_copy_only=False)
    first_more = np.zeros(nodes, dtype=bool)
    first_more[terminal[more]] = True
    counted = first_more & ~before
    below = {}
    for name in ("below_children", "below_leaves", "below_saved"):
        below[name] = np.zeros(nodes, dtype=np.int64)
        below[name][terminal[more]] = columns[name].to_numpy(zero_copy_only=False)[more]
        below[name][~counted] = 0
    is_leaf = ends == index + 1
    weight = np.where(first_more, below["below_leaves"], (~before & ~after).astype(np.int64))
    n_leaves = leaf_pairs + summed(np.where(is_leaf, weight - 1, 0))

    n_convs = summed(n_at)
    saved = summed((n_convs - ~before) * size + below["below_saved"])
    inner = (parent >= 0) & ~before
    n_children = np.bincount(parent[inner], minlength=nodes) + below["below_children"]
    least = RangeMinimum(least_at).of(index, ends)

    spine = before | after | (root_is_spine & (depth == 0))
    key_of: dict[int, bytes] = {}
    first_keys = _keys(elements[: lengths[0]], int(np.count_nonzero(before)))
    key_of.update(enumerate(first_keys))
    last_keys = _keys(elements[begins[-1] :], min(shared_after, int(lengths[-1])))
    key_of.update(zip(last_path.tolist(), last_keys, strict=False))
    for i in np.flatnonzero(spine & (depth == 0)).tolist():
        key_of.setdefault(i, hashlib.md5(elements[new][i].tobytes()).digest())
    spine_parent = np.where(parent >= 0, spine[parent], False)
    kind = np.where(spine, SPINE, np.where(spine_parent, PENDING, DONE))
    hashes: list[str | None] = [None] * nodes
    for i, text in zip(terminal.tolist(), columns["ids_sha256"].to_pylist(), strict=True):
        hashes[i] = text or hashes[i]
    parent_keys: list[bytes | None] = [None] * nodes
    for i in np.flatnonzero(spine_parent).tolist():
        parent_keys[i] = key_of[int(parent[i])]
    parent_conv = np.where((parent >= 0) & ~spine_parent, least[parent], 0)
    return {
        "kind": kind,
        "key": [key_of[i] if s else None for i, s in enumerate(spine.tolist())],
        "parent_key": parent_keys,
        "conv_id": least,
        "depth": depth,
        "parent_conv_id": pa.array(parent_conv, pa.int64(), mask=(parent < 0) | spine_parent),
        "n_convs": n_convs,
        "n_children": n_children,
        "n_leaves": n_leaves,
        "saved_tokens": saved,
        "ends_sha256": hashes,
    }


_PARTS = (
    "shard long, kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _tries(root_is_spine: bool):
    kinds = {"kind": pa.int32(), "key": pa.binary(), "parent_key": pa.binary(), "ends_sha256": pa.string()}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                rows = pa.RecordBatch.from_arrays([one.column(c).flatten() for c in _FIELDS], names=_FIELDS)
                before, after = (one.column(c)[0].as_py() for c in ("shared_before", "shared_after"))
                nodes = shard_nodes(rows, before, after, root_is_spine)
                shard = (one.column("part")[0].as_py() << 32) + one.column("number")[0].as_py()
                arrays = [pa.array([shard], pa.int64()).take(pa.array(np.zeros(len(nodes["kind"]), dtype=np.int64)))]
                for name, values in nodes.items():
                    arrays.append(values if isinstance(values, pa.Array) else pa.array(values, kinds.get(name, pa.int64())))
                whole = pa.RecordBatch.from_arrays(arrays, names=["shard", *nodes])
                for low in range(0, whole.num_rows, 1 << 14):
                    yield whole.slice(low, 1 << 14)

    return build


def _shards(rows: DataFrame, scratch: Scratch, most: int, root_is_spine: bool) -> DataFrame:
    """What each shard knows of its nodes."""
    # Of equal bands those that go on come first.
    order = ["root1", "root2", "digests", F.desc("more")]
    packed = rows.select(*_FIELDS).repartitionByRange(*order).sortWithinPartitions(*order)
    shards = scratch.keep(packed.mapInArrow(_packed(most), _SHARD_ROW))
    # One row for each shard of some 260,000 turns.
    along = Window.orderBy("part", "number")
    ends = shards.select("part", "number", "first", "last").withColumns(
        {"previous": F.lag("last").over(along), "following": F.lead("first").over(along)}
    )
    shared = scratch.keep(ends.mapInArrow(_common, "part int, number int, shared_before long, shared_after long"))
    parts = shards.drop("first", "last").join(shared, ["part", "number"])
    found = scratch.keep(parts.mapInArrow(_tries(root_is_spine), _PARTS))
    scratch.drop(shards, shared)
    return found


def _merged(parts: DataFrame, scratch: Scratch, roots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All nodes with their parents, and the merged spines with their keys.

    ``roots`` has the least conversations (``ended``) that end at a later band's roots, by ``key``."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    spine = parts.where(F.col("kind") == SPINE)
    merged = spine.groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256")
    )
    if roots is not None:
        merged = merged.join(roots.select("key", "ended"), "key", "left")
        merged = merged.withColumn("conv_id", F.least("conv_id", "ended")).drop("ended")
    merged = scratch.keep(merged)
    of_key = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # A spine's children look their parent up within their own shard: the root's would all meet otherwise.
    in_shard = spine.select("shard", F.col("key").alias("parent_key")).join(of_key, "parent_key")
    pending = parts.where(F.col("kind") == PENDING).drop("parent_conv_id").join(in_shard, ["shard", "parent_key"])
    columns = [f.split(" ")[0] for f in NODES.split(", ")]
    nodes = parts.where(F.col("kind") == DONE).select(*columns).unionByName(pending.select(*columns))
    return nodes.unionByName(merged.join(of_key, "parent_key", "left").select(*columns)), merged


def _chain_nodes(band: int):
    """Nodes of a band that no other class shares."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                size = np.frombuffer(r["sizes"], dtype="<i4").astype(np.int64)
                n = len(size)
                rest = r["all_bytes"] - r["before"] - (np.cumsum(size) - size)
                hashes: list[str | None] = [None] * n
                children = np.ones(n, dtype=np.int64)
                if not r["more"]:
                    hashes[-1], children[-1] = r["ids_sha256"], 0
                same = np.full(n, r["conv_id"])
                parent = same.copy()
                parent[0] = r["parent"]
                arrays = [
                    same, r["band"] * band + np.arange(1, n + 1), parent, np.full(n, r["n"]), children,
                    np.ones(n, dtype=np.int64), (r["n"] - 1) * rest, hashes,
                ]
                kinds = [pa.int64()] * 7 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)],
                    names=[f.split(" ")[0] for f in NODES.split(", ")],
                )

    return chain


def prefix_trie(
    turns: DataFrame, borrowing: Borrowing | None = None, band: int = BAND, shard: int = SHARD
) -> DataFrame:
    """A row for each node of the trie of all conversations in ``turns`` (conv_id, turn, role, text).

    ``conv_id`` is the least id of the conversations that begin with the node's turns and
    ``n_convs`` their number; ``n_leaves`` counts the childless nodes of its subtree and ``saved_tokens`` sums up the
    bytes of turns that need not be kept again there, each with its node's ``n_convs - 1``;
    ``ends_sha256`` hashes the ids of the conversations that end at the node.
    """
    scratch = Scratch(turns.sparkSession)
    bands = conversation_bands(turns, scratch, borrowing, band)
    chains = _chains(bands, scratch, band)
    classes = _classes(chains, scratch)
    slim = scratch.keep(chains.join(classes, "conv_id"))
    # Roots of later bands that several classes share; most tables have none.
    later = slim.where("band > 0").groupBy("band", "root1", "root2").agg(F.count(F.lit(1)).alias("sharing"))
    shared = scratch.keep(later.where("sharing > 1").drop("sharing"))
    deepest = shared.agg(F.max("band")).first()[0] or 0
    on = ["band", "root1", "root2"]
    in_trie = slim.where("band = 0").unionByName(slim.where("band > 0").join(shared, on, "left_semi"))
    alone = slim.where("band > 0").join(shared, on, "left_anti")
    # A class that ends where another one's band does is that band's parent too.
    ended = slim.where((~F.col("more")) & (F.col("turns") == band)).select(
        F.col("end1").alias("root1"), F.col("end2").alias("root2"), (F.col("band") + 1).alias("band"), F.col("conv_id").alias("ended")
    )
    alone = alone.join(ended, on, "left").withColumn("parent", F.least("conv_id", "ended"))
    full = alone.join(bands, ["conv_id", "band"])
    tables = [full.mapInArrow(_chain_nodes(band), NODES)]
    roots: DataFrame | None = None
    for level in range(deepest, -1, -1):
        rows = in_trie.where(F.col("band") == level).join(bands, ["conv_id", "band"])
        rest = (F.col("n") - 1) * (F.col("all_bytes") - F.col("before") - F.col("bytes"))
        below = {"below_children": F.lit(1), "below_leaves": F.lit(1), "below_saved": rest}
        if roots is not None:
            rows = rows.join(roots, (F.col("end1") == F.col("next1")) & (F.col("end2") == F.col("next2")), "left")
            below = {c: F.coalesce(F.col(f"root_{c}"), value) for c, value in below.items()}
        rows = rows.withColumns({c: F.when(F.col("more"), value.cast("long")) for c, value in below.items()})
        rows = rows.withColumn("ids_sha256", F.when(~F.col("more"), F.col("ids_sha256")))
        parts = _shards(rows, scratch, shard, level > 0)
        if level > 0:
            keys = in_trie.where(F.col("band") == level).select(*on).distinct().join(ended, on, "left")
            keys = keys.select("root1", "root2", "ended").mapInArrow(_root_keys, "next1 long, next2 long, ended long, key binary")
            keys = scratch.keep(keys)
            nodes, spines = _merged(parts, scratch, keys)
            nodes = nodes.where("depth > 0")
            totals = spines.where("depth = 0").select(
                "key",
                F.col("n_children").alias("root_below_children"),
                F.col("n_leaves").alias("root_below_leaves"),
                F.col("saved_tokens").alias("root_below_saved"),
            )
            roots = scratch.keep(keys.join(totals, "key").drop("key", "ended"))
        else:
            nodes, _ = _merged(parts, scratch)
        tables.append(nodes.withColumn("depth", F.col("depth") + level * band))
    whole = reduce(DataFrame.unionByName, tables)
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))


def _root_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
        keys = [hashlib.md5(r.tobytes()).digest() for r in roots]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["next1", "next2", "ended", "key"])
