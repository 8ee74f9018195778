"""Documents whose sets of word n-grams have a Jaccard similarity of 0.8 or more.

A set is the distinct 64-bit hashes of a text's ``WIDTH``-word shingles. Documents with equal
sets are one class; everything below works on classes.

1. Grouping. Classes that share a minimum hash are compared with the least of them, and those
   that are similar enough are linked. Linked classes, and others that share their two most common
   minima (a family that may lie just below the threshold), form groups, cut into parts of about ``PART`` members.
2. Token-group matrix. Each part has the union of its members' tokens, as a bitmap, and an
   index of the tokens that matter: sorted with heavy ones last, two sets that are similar
   enough must share a token among the first fifth (two tokens, unless they are tiny).
3. Bound. A class meets a part only over such tokens, and not where all who hold one are linked
   already; the bitmaps then bound its overlap with the part from above, and only parts that can
   hold a similar set are opened.
4. The members of an opened part and the classes that opened it are compared exactly by the sets
   of their texts, in one table of counts; links that tell nothing new are not kept.
   All links make the components.

A family of copies, however large, is one class or a few parts; members ask parts, and are not paired as rows.
Heavy tokens are known by counts in a table of fixed size; which tokens are called heavy
changes the order, and so the work, but no result. Only that table and a filter of fixed
size come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.links import components
from tagloom.llm.scratch import Scratch, pieces
from tagloom.llm.words import Words, mixed, runs, slices, words_of

WIDTH = 5
PERCENT = 80
STARS = 4  # minimum hashes by which classes are grouped
PART = 64
ASKING = 256  # classes that are compared with a part in one piece of work
DEAL_BYTES = 2 << 20  # of text that a task's pieces stand for
COUNT_BITS, FILTER_BITS, BLOCKS = 19, 23, 16
SHARD_BYTES = 16 << 20  # of text that a shard of the index stands for
UNIT_BYTES = 2 << 20
_PAIRED = 8  # from this many tokens on, two shared ones are asked for


def _least_common(n: int | np.ndarray) -> int | np.ndarray:
    """Tokens that a set of n shares at least with one that is similar enough."""
    return -(-n * PERCENT // 100)


def _similar(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


def token_sets(words: Words) -> list[np.ndarray]:
    """Each text's distinct shingles, in order; of a shorter text its whole sequence."""
    hashes, owners, _ = runs(words.hashes, words.at, WIDTH)
    cuts = np.searchsorted(owners, np.arange(len(words) + 1))
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    counts = words.counts()
    for i in np.flatnonzero((counts > 0) & (counts < WIDTH)):
        one = np.uint64(0)
        for h in words.hashes[words.at[i] : words.at[i + 1]]:
            one = mixed(np.array([one ^ h]) + np.uint64(int(counts[i])))[0]
        sets[i] = np.array([one], dtype=np.uint64)
    return sets


def set_keys(sets: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """A 16-byte key of each set, and its first 8 bytes as a number."""
    pairs = np.zeros((len(sets), 2), dtype=np.uint64)
    for i, tokens in enumerate(sets):
        if len(tokens):
            pairs[i] = mixed(tokens).sum(), mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum()
    return [row.tobytes() for row in pairs], pairs[:, 0].astype(np.int64)


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit for each token's leading bits; two to four bits for a token."""
    size = max(6, int(2 * max(len(tokens), 1) - 1).bit_length())
    bits = np.zeros(1 << size, dtype=bool)
    bits[(tokens >> np.uint64(64 - size)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _bits(data: bytes, size: int) -> np.ndarray:
    """The bitmap, folded to ``size`` bits."""
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8)).astype(bool)
    return bits if len(bits) == size else bits.reshape(size, -1).any(axis=1)


def shared_at_most(n: int, of: bytes, other: bytes) -> int:
    """A set's tokens that can be in the other: each bit that only it has is one that isn't."""
    size = 8 * min(len(of), len(other))
    return n - int(np.count_nonzero(_bits(of, size) & ~_bits(other, size)))


def union_bitmap(maps: list[bytes]) -> bytes:
    size = 8 * min(len(m) for m in maps)
    out = np.zeros(size, dtype=bool)
    for m in maps:
        out |= _bits(m, size)
    return np.packbits(out).tobytes()


def similar_pairs(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Which sets are similar enough to which others, as rows of two places."""
    n, m = (np.array([len(s) for s in group], dtype=np.int64) for group in (sets, others))
    common = np.zeros((len(sets), len(others)))
    if not common.size:
        return np.zeros((0, 2), dtype=np.int64)
    left, right = np.concatenate(sets), np.concatenate(others)
    left_owner, right_owner = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)
    shared = np.intersect1d(left, right)
    for low in range(0, len(shared), 4096):  # a bounded table at a time; its counts are exact
        some = shared[low : low + 4096]
        tables = []
        for values, owner, rows in ((left, left_owner, len(sets)), (right, right_owner, len(others))):
            at = np.minimum(np.searchsorted(some, values), len(some) - 1)
            hit = some[at] == values
            table = np.zeros((rows, len(some)), dtype=np.float32)
            table[owner[hit], at[hit]] = 1
            tables.append(table)
        common += tables[0] @ tables[1].T
    return np.argwhere(100 * common >= PERCENT * (n[:, None] + m[None, :] - common))


def spanning(keys: list[bytes], others: list[bytes], pairs: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Enough of the pairs to link all that they link."""
    root: dict[bytes, bytes] = {}

    def find(key: bytes) -> bytes:
        while (up := root.get(key, key)) != key:
            root[key] = key = root.get(up, up)
        return key

    links = []
    for i, j in pairs.tolist():
        a, b = find(keys[i]), find(others[j])
        if a != b:
            root[a] = b
            links.append((keys[i], others[j]))
    return links


def _blocks(values: np.ndarray) -> dict[str, list]:
    parts = np.split(values, BLOCKS)
    return {"block": list(range(BLOCKS)), "data": [p.tobytes() for p in parts]}


def _gathered(df: DataFrame, dtype: type, pick: np.ufunc, out: type) -> np.ndarray:
    """Arrays of fixed size that tasks made, put together block by block."""

    def join(rows: pa.Table) -> pa.Table:
        total = None
        for data in rows.column("data").to_pylist():
            part = np.frombuffer(data, dtype=dtype).astype(out)
            total = part if total is None else pick(total, part)
        return pa.table({"block": rows.column("block").slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})

    found = df.groupBy("block").applyInArrow(join, "block int, data binary").collect()
    if not found:
        return np.zeros(0, dtype=out)
    return np.concatenate([np.frombuffer(r["data"], dtype=out) for r in sorted(found, key=lambda r: r["block"])])


class Join:
    """One run of the join over a table."""

    def __init__(self, docs: DataFrame, id: str, text: str) -> None:
        self.spark: SparkSession = docs.sparkSession
        self.scratch = Scratch(self.spark)
        self.docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        self.id_type = self.docs.schema["id"].dataType.simpleString()

    def describe(self) -> np.ndarray:
        """Keeps each document's set in short; returns which token buckets are heavy."""
        fields = "block int, data binary, id {}, key binary, head long, n int, bits binary, least array<long>"

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
            odd = [np.uint64(2 * k + 0x9E3779B97F4A7C15) for k in range(STARS)]
            ids = pa.int64()
            for batch in batches:
                ids = batch.schema.field("id").type
                for unit in slices(batch, "text", UNIT_BYTES):
                    sets = token_sets(words_of(unit.column("text"), fold_case=True))
                    places = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - COUNT_BITS)
                    counts += np.bincount(places.astype(np.int64), minlength=len(counts)).astype(np.uint32)
                    keys, heads = set_keys(sets)
                    yield _filled(
                        {
                            "id": unit.column("id"),
                            "key": keys,
                            "head": heads,
                            "n": [len(s) for s in sets],
                            "bits": [bitmap(s) for s in sets],
                            "least": [[int((s * o).min().astype(np.int64)) for o in odd] if len(s) else [] for s in sets],
                        },
                        unit.num_rows,
                        _described(ids),
                    )
            yield _filled(_blocks(counts), BLOCKS, _described(ids))

        kept = self.docs.mapInArrow(read, fields.format(self.id_type))
        kept = self.scratch.keep(kept.withColumn("kind", F.when(F.col("data").isNull(), "doc").otherwise("count")), "kind")
        self.sets = kept.where("kind = 'doc'").select("id", "key", "head", "n", "bits", "least")
        counts = _gathered(kept.where("kind = 'count'").select("block", "data"), np.uint32, np.add, np.int64)
        usual = counts.mean() if len(counts) else 0.0
        return counts > usual + 8 * np.sqrt(usual) + 32

    def classify(self) -> None:
        """One row for each distinct set: its least id, and what is known of it."""
        same = [F.first(c).alias(c) for c in ("head", "n", "bits", "least")]
        self.classes = self.scratch.keep(
            self.sets.where("n > 0").groupBy("key").agg(F.min("id").alias("least_id"), *same)
        )

    def index(self, heavy: np.ndarray) -> None:
        """``token`` and ``head`` of the classes that share a token that matters with another."""
        self.total = int(self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
        shards = pieces(self.total, SHARD_BYTES)
        shared = self.spark.sparkContext.broadcast(heavy)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit in slices(batch, "text", UNIT_BYTES):
                    sets = token_sets(words_of(unit.column("text"), fold_case=True))
                    heads = set_keys(sets)[1]
                    tokens, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                    for i in np.unique(heads, return_index=True)[1]:  # copies in the unit count once
                        n = len(sets[i])
                        if n:
                            last = shared.value[(sets[i] >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                            ordered = np.concatenate([sets[i][~last], sets[i][last]])
                            first = ordered[: n - _least_common(n) + 1 + (n >= _PAIRED)]
                            tokens.append(first)
                            owners.append(np.full(len(first), heads[i]))
                    token, owner = np.concatenate(tokens), np.concatenate(owners)
                    shard = ((token >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)
                    order = np.argsort(shard, kind="stable")
                    found, at = np.unique(shard[order], return_index=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": pa.array(found, pa.int32()),
                            "tokens": pa.array([x.tobytes() for x in np.split(token[order], at[1:])][: len(found)], pa.binary()),
                            "heads": pa.array([x.tobytes() for x in np.split(owner[order], at[1:])][: len(found)], pa.binary()),
                        }
                    )

        def meet(rows: pa.Table) -> pa.Table:
            token, head = (
                np.concatenate([np.frombuffer(x.as_py(), t) for x in rows.column(c)]) for c, t in (("tokens", np.uint64), ("heads", np.int64))
            )
            order = np.lexsort((head, token))
            token, head = token[order], head[order]
            del order
            new_token = np.append(True, token[1:] != token[:-1])
            distinct = new_token | np.append(True, head[1:] != head[:-1])
            token, head, new_token = token[distinct], head[distinct], new_token[distinct]
            sizes = np.diff(np.append(np.flatnonzero(new_token), len(token)))
            keep = np.repeat(sizes > 1, sizes)
            return pa.table({"token": token[keep].astype(np.int64), "head": head[keep]})

        sent = self.docs.mapInArrow(send, "shard int, tokens binary, heads binary")
        self.tokens = self.scratch.keep(sent.groupBy("shard").applyInArrow(meet, "token long, head long"))

    def star_links(self) -> DataFrame:
        """Links between classes and the least class with which they share a minimum."""
        rows = self.classes.select("key", "n", "bits", F.posexplode("least").alias("star", "value"))
        leaders = rows.groupBy("star", "value").agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("size"))
        near = self.scratch.keep(rows.join(leaders.where("size > 1"), ["star", "value"]).select("key", "b", "star", "value", "size"))
        # Of a class's minima the two that most others share name its family: one may come from a
        # passage that else different texts have in common.
        most = F.sort_array(F.collect_list(F.struct("size", "star", "value")), asc=False)
        named = near.groupBy("key").agg(F.transform(F.slice(most, 1, 2), lambda m: m["value"]).alias("names"))
        self.families = self.scratch.keep(named.where(F.size("names") == 2).select("key", F.xxhash64("names").alias("family")))
        pairs = near.where("key != b").select(F.col("key").alias("a"), "b").distinct()
        return self.scratch.keep(self.compared(self.bounded(pairs)))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes that can be similar enough by sizes and bitmaps."""
        pairs = self.scratch.keep(pairs)
        known = self._known(pairs.select(F.col("a").alias("key")).union(pairs.select("b")))
        rows = pairs.join(known.select(*[F.col(c).alias(d) for c, d in (("key", "a"), ("n", "n_a"), ("bits", "bits_a"))]), "a")
        rows = rows.join(known.select(*[F.col(c).alias(d) for c, d in (("key", "b"), ("n", "n_b"), ("bits", "bits_b"))]), "b")
        rows = rows.where(
            (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
        )

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")]
                keep = []
                for n_a, n_b, a, b in zip(*columns, strict=True):
                    common = min(shared_at_most(n_a, a, b), shared_at_most(n_b, b, a))
                    keep.append(_similar(common, n_a, n_b))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return rows.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bound, "a binary, b binary")

    def _known(self, keys: DataFrame) -> DataFrame:
        """Sizes and bitmaps of some classes, so that the others' move only once."""
        return self.scratch.keep(self.classes.join(keys.distinct(), "key", "left_semi").select("key", "n", "bits"))

    def texts_of(self, keys: DataFrame) -> DataFrame:
        """``key`` and ``text``, one for each of some classes."""
        wanted = self.scratch.keep(keys.distinct().join(self.classes, "key").select("key", "least_id"))
        place = F.pmod(F.xxhash64(F.col("least_id")), F.lit(1 << FILTER_BITS))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            for batch in batches:
                bits[batch.column("at").to_numpy()] = True
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, t) for (k, v), t in zip(_blocks(np.packbits(bits)).items(), (pa.int32(), pa.binary()), strict=True)}
            )

        marked = wanted.select(place.alias("at")).mapInArrow(mark, "block int, data binary")
        bits = self.spark.sparkContext.broadcast(_gathered(marked, np.uint8, np.bitwise_or, np.uint8))

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Texts of the ids that may be wanted, with the keys of their sets."""
            for batch in batches:
                at = batch.column("at").to_numpy()
                inside = (bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 if len(bits.value) else at * 0
                rows = batch.filter(pa.array(inside == 1))
                for unit in slices(rows, "text", UNIT_BYTES):
                    keys, _ = set_keys(token_sets(words_of(unit.column("text"), fold_case=True)))
                    yield pa.RecordBatch.from_arrays(
                        [unit.column("id"), pa.array(keys, pa.binary()), unit.column("text")], names=["id", "key", "text"]
                    )

        hashed = F.pmod(F.xxhash64(F.col("id")), F.lit(1 << FILTER_BITS))
        texts = self.docs.select("id", "text", hashed.alias("at")).where("text is not null")
        texts = texts.mapInArrow(fetch, f"id {self.id_type}, key binary, text string")
        renamed = wanted.withColumnRenamed("key", "wanted")
        texts = texts.join(renamed, (F.col("key") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("least_id")))
        return self.scratch.keep(texts.select("key", "text").dropDuplicates(["key"]))

    def compared(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough, by the sets of their texts."""
        pairs = self.scratch.keep(pairs)
        texts = self.texts_of(pairs.select(F.col("a").alias("key")).union(pairs.select("b")))
        both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        both = both.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, "text_a", UNIT_BYTES):
                    a, b = (token_sets(words_of(rows.column(c), fold_case=True)) for c in ("text_a", "text_b"))
                    keep = [
                        _similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
                        for x, y in zip(a, b, strict=True)
                    ]
                    yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")

    def matrix_links(self, grouped: DataFrame) -> DataFrame:
        """Links between classes of different groups; ``grouped`` has ``node`` and ``root``."""
        # Numbers stand for keys here; two groups or classes that share one would only be met less
        # or more often, with the chance that two shingles have one hash.
        shared = self.classes.select("key", "head", "n").join(
            self.tokens.select("head").distinct(), "head", "left_semi"
        )
        shared = shared.join(self.families, "key", "left")
        member = shared.join(grouped.withColumnRenamed("node", "key"), "key", "left")
        member = self.scratch.keep(member.withColumn("root", F.coalesce("root", "key")))
        linked = member.groupBy("root").agg(F.count(F.lit(1)).alias("linked"), F.min("family").alias("family"))
        member = member.drop("family").join(linked, "root")
        # Large linked groups stand for themselves; small ones stay together within their family.
        large = F.col("linked") > PART
        group = F.when(large | F.col("family").isNull(), F.xxhash64("root")).otherwise(F.xxhash64(F.lit("family"), "family"))
        member = self.scratch.keep(member.select("key", "head", "n", "root", "linked", group.alias("group")))
        sizes = member.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
        together = F.xxhash64(F.when(large, F.col("key")).otherwise(F.col("root")))
        member = member.join(sizes, "group").withColumn("part", F.pmod(together, F.col("parts")).cast("int"))
        placed = self.scratch.keep(member.select("key", "head", "n", F.xxhash64("root").alias("root"), "group", "part"))
        member, keys = placed, placed.select("head", "key")
        members = member.groupBy("group", "part").agg(F.count(F.lit(1)).alias("members"))
        member = member.select("head", "n", "root", "group", "part").distinct().join(members, ["group", "part"])
        asking = self.scratch.keep(self.tokens.join(member, "head"))
        held = asking.groupBy("token", "group", "part", "members").agg(
            F.min("n").alias("low"), F.max("n").alias("high"), F.min("root").alias("first"), F.max("root").alias("last")
        )
        held = held.select("token", *[F.col(c).alias(f"of_{c}") for c in held.columns if c != "token"])
        # The smaller part asks, so that a large one's members don't ask for single texts.
        place = ("members", "group", "part")
        once = F.struct(*place) <= F.struct(*[F.col(f"of_{c}").alias(c) for c in place])
        fits = (100 * F.col("n") >= PERCENT * F.col("of_low")) & (100 * F.col("of_high") >= PERCENT * F.col("n"))
        known = (F.col("of_first") == F.col("root")) & (F.col("of_last") == F.col("root"))
        met = asking.join(held, "token").where(once & fits & ~known).groupBy("head", "n", "of_group", "of_part")
        # A set of 10 is similar to none below 8.
        least = F.when(F.col("n") >= _PAIRED * 100 / PERCENT, 2).otherwise(1)
        met = met.agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)
        met = met.select("head", "n", F.col("of_group").alias("group"), F.col("of_part").alias("part"))
        met = self.scratch.keep(met.join(keys, "head").select("key", "n", "group", "part"))
        named = placed.select("key", "group", "part").join(
            met.select("group", "part").distinct(), ["group", "part"], "left_semi"
        )
        named = self.scratch.keep(named)
        known = self._known(met.select("key").union(named.select("key"))).select("key", "bits")

        def unite(rows: pa.Table) -> pa.Table:
            found: dict[tuple, list[bytes]] = {}
            columns = [rows.column(c).to_pylist() for c in ("group", "part", "bits")]
            for group, part, bits in zip(*columns, strict=True):
                found.setdefault((group, part), []).append(bits)
            return pa.table(
                {
                    "group": pa.array([k[0] for k in found], pa.int64()),
                    "part": pa.array([k[1] for k in found], pa.int32()),
                    "tokens": pa.array([union_bitmap(v) for v in found.values()], pa.binary()),
                }
            )

        # Parts are small, so many are united at a time.
        dealt = F.pmod(F.xxhash64("group", "part"), F.lit(pieces(self.total, DEAL_BYTES))).alias("deal")
        joint = named.join(known, "key").select("group", "part", "bits", dealt).groupBy("deal")
        unions = joint.applyInArrow(unite, "`group` long, part int, tokens binary")
        rows = met.join(unions, ["group", "part"]).join(known, "key")

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("n", "bits", "tokens")]
                keep = [shared_at_most(n, b, t) >= _least_common(n) for n, b, t in zip(*columns, strict=True)]
                yield batch.select(["key", "group", "part"]).filter(pa.array(keep, pa.bool_()))

        opened = rows.select("key", "n", "bits", "tokens", "group", "part").mapInArrow(
            bound, "key binary, `group` long, part int"
        )
        opened = self.scratch.keep(opened)  # a task runs one Python function at a time
        return self.scratch.keep(self.examined(opened, named))

    def examined(self, opened: DataFrame, named: DataFrame) -> DataFrame:
        """Links between classes and members of the parts that they opened.

        A part's members and ``ASKING`` of the classes that opened it are one piece of work,
        many of which make a task: texts are sent once for a piece, and no pairs but links
        that join what was apart in it leave it.
        """
        place = ["group", "part"]
        shares = opened.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / ASKING).cast("int").alias("shares"))
        inside = named.join(shares, place)
        texts = self.texts_of(opened.select("key").union(inside.select("key")))
        asking = opened.join(shares, place).withColumn("share", F.pmod(F.xxhash64("key"), F.col("shares")).cast("int"))
        held = inside.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        deal = F.pmod(F.xxhash64("group", "part", "share"), F.lit(pieces(self.total, DEAL_BYTES))).alias("deal")
        columns = ["group", "part", "share", "key", "text"]
        asking = asking.join(texts, "key").select(deal, *columns)
        held = held.join(texts, "key").select(deal, *columns)

        def pieces_of(rows: pa.Table) -> dict[tuple, list[int]]:
            found: dict[tuple, list[int]] = {}
            for i, place in enumerate(zip(*[rows.column(c).to_pylist() for c in columns[:3]], strict=True)):
                found.setdefault(place, []).append(i)
            return found

        def sets_of(rows: pa.Table, which: list[int]) -> tuple[list[bytes], list[np.ndarray]]:
            some = rows.take(which)
            return some.column("key").to_pylist(), token_sets(words_of(some.column("text").combine_chunks(), fold_case=True))

        def look(asking: pa.Table, held: pa.Table) -> pa.Table:
            links: list[tuple[bytes, bytes]] = []
            held = held.rename_columns(["deal", *columns])
            members = pieces_of(held)
            for place, which in pieces_of(asking).items():
                keys, sets = sets_of(asking, which)
                others, other_sets = sets_of(held, members.get(place, []))
                links += spanning(keys, others, similar_pairs(sets, other_sets))
            return pa.table(
                {"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())}
            )

        held = held.select([F.col(c).alias(f"of_{c}") for c in ("deal", *columns)])
        return asking.groupBy("deal").cogroup(held.groupBy("of_deal")).applyInArrow(look, "a binary, b binary")

    def run(self) -> DataFrame:
        heavy = self.describe()
        self.classify()
        self.index(heavy)
        stars = self.star_links()
        grouped = components(stars, self.scratch)
        links = grouped.select(F.col("node").alias("a"), F.col("root").alias("b")).union(self.matrix_links(grouped))
        root = components(links, self.scratch)
        classes = self.classes.select("key", "least_id").join(root.withColumnRenamed("node", "key"), "key", "left")
        classes = self.scratch.keep(classes.withColumn("root", F.coalesce("root", "key")))
        least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
        found = self.scratch.keep(classes.join(least, "root").select("key", "component_id"))
        alone = self.sets.where("n = 0").select("id", F.col("n").cast("long"), F.col("id").alias("component_id"))
        rows = self.sets.where("n > 0").join(found, "key").select("id", F.col("n").cast("long"), "component_id")
        rows = Scratch(self.spark).keep(rows.union(alone))
        self.scratch.close()
        return rows


def _described(ids: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("block", pa.int32()), ("data", pa.binary()), ("id", ids), ("key", pa.binary()), ("head", pa.int64()),
         ("n", pa.int32()), ("bits", pa.binary()), ("least", pa.list_(pa.int64()))]
    )


def _filled(columns: dict, rows: int, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of these columns, and nulls in the others."""
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(rows, field.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def similar_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its id, ``n_shingles`` (the size of its set) and ``component_id`` (the
    least id that links reach, its own included).

    Words are runs of anything but space and ``\\t``..``\\r``, with A-Z in lower case. A text of
    fewer than five words is one shingle; one without words, or a null, has none and stays by
    itself. Rows with a null id are compared like others; a component of theirs only is null.
    Repeated rows are in one component. Other columns, whatever their names, are not carried.
    """
    found = Join(docs, id, text).run()
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with one document of each component, that of the least id.

    Of rows equal in id and text one stays; rows with a null id stay as they are.
    """
    found = similar_documents(docs, id, text)
    first = found.where(F.col(id) == F.col("component_id")).select(F.col(id).alias("_kept")).distinct()
    renamed = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
    kept = renamed.join(first, F.col(f"in_{id}") == F.col("_kept"), "left_semi")
    kept = kept.withColumn("_text", F.xxhash64(f"in_{text}")).dropDuplicates([f"in_{id}", "_text"]).drop("_text")
    kept = kept.union(renamed.where(F.col(f"in_{id}").isNull()))
    return kept.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])
