"""Quality of texts by a language model of trusted text.

The model is an interpolated modified Kneser-Ney model of order 4 over code points, and a text begins and
ends with a boundary. Counts of all trusted texts are summed up by n-gram, continuation counts,
discounts and backed-off probabilities come from joins of the sharded count tables by context
and by suffix. It has two parts, which differ in how n-grams are looked up.

The most frequent code points of the corpus have a symbol each and all others share one. With ``SYMBOLS``
symbols there are at most ``SYMBOLS ** ORDER`` n-grams (2**24), so these tables have a bound whatever the
corpus, and every task looks its texts up in them. That is all there is to n-grams of such code points alone.

An n-gram with any other code point is counted as it is, over all code points there are, in tables that grow with
the texts and stay sharded (``exact_tables``). There its probability is refined order by order, by its own count
and its context's: from that of the symbols, of which a code point without one has
its share in trusted texts, over the code points before it, to the full order. A context that has
such a code point shares out all that follows; another one, what its
symbols give to the code points without one. So probabilities add up to one over all that the corpus has. The n-grams that the texts have
are joined with those tables once each (``refinements``); ``KNOWN`` of the results, the most frequent, go to every task, and texts
that have others are joined with them.

A text's perplexity is read as if ``PRIOR`` symbols of its language's usual one came with it,
since few symbols say little. A text is rejected above its language's threshold, which is
``REACH`` times as far from the median as the 95 % quantile, of trusted texts that were kept
out of the counts. A language with less than ``LEAST`` of those, and a null one, take the
threshold of all together. Without any trusted text, nothing is rejected.

Null and empty texts hold no evidence and are kept. Rows are judged one by one, so repeated
ids and ties need no rule; a trusted id marks every row that has it.
Very long texts are read whole. An empty table has no rows to judge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, crc_of_id
from tagloom.llm.words import slices

ORDER = 4
SYMBOLS = 64
PRIOR = 200
REACH = 4.0
LEAST = 50
KNOWN = 1 << 20
LEAST_DISCOUNT = 0.1
POINT = 21  # bits of a code point plus one; three of them are a context, 0 is the boundary


@dataclass
class Model:
    """Sparse tables of a model: per order n-grams with probabilities, contexts with weights."""

    alphabet: list[int]
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: The code points that share the last symbol, and -log of each one's share of it.
    rest: tuple[np.ndarray, np.ndarray] | None = None

    def rest_losses(self) -> np.ndarray | None:
        """What each code point adds to its symbol's loss; one that the corpus lacks adds nothing."""
        if self.rest is None:
            return None
        out = np.zeros(0x110000, dtype=np.float32)
        out[self.rest[0]] = self.rest[1]
        return out

    def losses(self) -> np.ndarray:
        """-log p of each n-gram of the full order, seen or backed off. Every order is made in
        place in single precision, so that little more than the last one stands in memory."""
        p = np.full(1, 1 / SYMBOLS, dtype=np.float32)
        for n, ((grams, chances), (contexts, weights)) in enumerate(
            zip(self.grams, self.contexts, strict=True), start=1
        ):
            weight = np.ones(SYMBOLS ** (n - 1), dtype=np.float32)
            weight[contexts] = weights
            if n == 1:
                p = np.full(SYMBOLS, weight[0] / SYMBOLS, dtype=np.float32)
            else:
                lower = p.reshape(1, -1, SYMBOLS)
                p = (weight.reshape(SYMBOLS, -1, 1) * lower).reshape(-1)
            p[grams] = chances
        return np.negative(np.log(p, out=p), out=p)


def symbol_table(alphabet: list[int]) -> np.ndarray:
    """Symbol of each code point; 0 is the boundary, the last one everything else."""
    table = np.full(0x110000, SYMBOLS - 1, dtype=np.int32)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    return table


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and each text's number of them."""
    column = column.fill_null("")
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(column.to_pylist())
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), lengths


@dataclass
class Grams:
    """All n-grams of several texts, text by text: one for each symbol and one for the end; none for an empty text."""

    codes: np.ndarray  # by symbols
    n: np.ndarray  # how many each text has
    ids: np.ndarray  # code points plus one, with boundaries of 0
    begins: np.ndarray  # where in ids an n-gram begins, as a mask

    def others(self) -> tuple[np.ndarray, np.ndarray]:
        """Which of them have a code point without a symbol of its own, and ``apart``: bits for where, the last one's first."""
        apart = np.zeros(len(self.codes), dtype=np.int8)
        for place in range(ORDER):
            apart |= (self.codes // SYMBOLS**place % SYMBOLS == SYMBOLS - 1).astype(np.int8) << place
        which = np.flatnonzero(apart)
        return which, apart[which].astype(np.int64)

    def exact(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and last code points of the n-grams ``which``, whatever their symbols."""
        at = np.flatnonzero(self.begins)[which]
        context = np.zeros(len(at), dtype=np.int64)
        for place in range(ORDER - 1):
            context = (context << POINT) | self.ids[at + place]
        return context, self.ids[at + ORDER - 1].astype(np.int64)


def _grams(column: pa.Array, table: np.ndarray) -> Grams:
    points, lengths = _points(column)
    some = lengths > 0
    pad = ORDER - 1
    begins = np.concatenate([[0], np.cumsum(lengths[some] + pad + 1)])
    symbols = np.zeros(begins[-1] + 1, dtype=np.int32)
    ids = np.zeros(begins[-1] + 1, dtype=np.int32)
    inside = np.arange(len(points)) + np.repeat(
        begins[:-1] + pad - np.concatenate([[0], np.cumsum(lengths[some])[:-1]]) if some.any() else [],
        lengths[some],
    ).astype(np.int64)
    symbols[inside], ids[inside] = table[points], points + 1
    codes = np.zeros(max(0, len(symbols) - 1 - pad), dtype=np.int32)
    for place in range(ORDER):
        codes = codes * SYMBOLS + symbols[place : place + len(codes)]
    # The n-gram that ends at place i begins at i - pad; those that end in the padding go.
    valid = np.ones(len(codes), dtype=bool)
    for place in range(pad):
        at = begins[1:-1] - pad + place
        valid[at] = False
    return Grams(codes[valid], np.where(some, lengths + 1, 0), ids, valid)


def text_grams(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of each text, text by text, and how many each has."""
    found = _grams(column, table)
    return found.codes, found.n


def _counted(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different row of the columns stands, and how often it is there."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    begins = np.flatnonzero(new)
    return order[begins], np.diff(np.append(begins, len(order)))


def point_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``point`` and ``n``: every code point of the texts, and how often it is there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for batch in batches:
            for some in slices(batch, "text"):
                total += np.bincount(_points(some.column("text"))[0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"point": pa.array(seen, pa.int64()), "n": pa.array(total[seen])})

    counted = docs.select(F.col(text).alias("text")).where("text is not null")
    return counted.mapInArrow(count, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))


def common_symbols(docs: DataFrame, text: str = "text") -> list[int]:
    """The most frequent code points of all texts, at most ``SYMBOLS - 2``; ties by value. They get
    symbols of their own, n-grams of the others come from ``exact_tables``."""
    return _most(point_counts(docs, text))


def _most(counts: DataFrame) -> list[int]:
    """The code points whose n-grams are looked up by symbols; the others lose nothing by it."""
    top = counts.orderBy(F.desc("n"), "point").limit(SYMBOLS - 2).collect()
    return sorted(r["point"] for r in top)


def rest_shares(
    counts: DataFrame, trusted: DataFrame, alphabet: list[int]
) -> tuple[np.ndarray, np.ndarray] | None:
    """The code points of ``counts`` without a symbol of their own, and -log of the share that
    each has of their common one by ``trusted``, both from ``point_counts``; None if there are none."""
    own = F.col("point").isin(alphabet) if alphabet else F.lit(False)
    mine = trusted.withColumnRenamed("n", "c")
    rows = counts.where(~own).join(mine, "point", "left").select("point", F.coalesce("c", F.lit(0)).alias("c"))
    found = rows.orderBy("point").toArrow()  # bounded by Unicode
    if not found.num_rows:
        return None
    c = found.column(1).to_numpy().astype(np.float64)
    return found.column(0).to_numpy(), -np.log((c + 1) / (c.sum() + len(c)))


def gram_counts(trusted: DataFrame, alphabet: list[int], text: str = "text", rest: bool = False) -> DataFrame:
    """``gram`` and ``c``, its number in all texts. With ``rest`` also ``last`` and ``apart``, and besides those, where
    ``last`` is -1: -1 - p and the number of each code point p outside the alphabet, where it is -2; and the context and
    number of each n-gram with such a code point, where it is the last one plus one. So texts are read once."""
    keys = ["gram", "last", "apart"] if rest else ["gram"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table(alphabet)
        for batch in batches:
            parts = []
            for some in slices(batch, "text", 1 << 20):
                found = _grams(some.column("text"), table)
                grams, n = np.unique(found.codes, return_counts=True)
                parts.append((grams, np.full(len(grams), -1), np.zeros(len(grams)), n))
                if rest:
                    points = _points(some.column("text"))[0]
                    points, n = np.unique(points[table[points] == SYMBOLS - 1], return_counts=True)
                    parts.append((-1 - points.astype(np.int64), np.full(len(points), -2), np.zeros(len(points)), n))
                    which, apart = found.others()
                    context, last = found.exact(which)
                    at, n = _counted(last, context)
                    parts.append((context[at], last[at], apart[at], n))
            if parts:
                gram, last, apart, n = (np.concatenate([p[k].astype(np.int64) for p in parts]) for k in range(4))
                order = np.lexsort((last, gram))
                at = np.flatnonzero(np.append(True, (np.diff(gram[order]) != 0) | (np.diff(last[order]) != 0))[: len(order)])
                c = np.add.reduceat(n[order], at) if len(at) else n
                columns = {"gram": gram[order][at], "last": last[order][at], "apart": apart[order][at], "c": c}
                yield pa.RecordBatch.from_pydict({k: pa.array(columns[k]) for k in (*keys, "c")})

    texts = trusted.select(F.col(text).alias("text")).where("text is not null")
    schema = ", ".join(f"{k} long" for k in (*keys, "c"))
    return texts.mapInArrow(count, schema).groupBy(*keys).agg(F.sum("c").alias("c"))


def _discount(order: DataFrame) -> Column:
    """What modified Kneser-Ney takes off a count ``c`` of one order's table."""
    n1, n2, n3, n4 = order.agg(
        *[F.count(F.when(F.col("c") == k, 1)).cast("double") for k in (1, 2, 3, 4)]
    ).first()
    y = n1 / max(1.0, n1 + 2 * n2)
    discounts = [
        min(max(k - (k + 1) * y * b / max(1.0, a), 0.0), float(k))
        for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))
    ]
    c = F.col("c")
    discount = F.when(c == 1, discounts[0]).when(c == 2, discounts[1]).otherwise(discounts[2])
    return F.least(discount, c)


def kneser_ney(counts: DataFrame, alphabet: list[int]) -> Model:
    """The model of the counts of the full order."""
    model, orders = Model(alphabet), [counts]
    for n in range(ORDER - 1, 0, -1):  # in how many different contexts each shorter n-gram stands
        suffix = F.pmod(F.col("gram"), F.lit(SYMBOLS**n)).alias("gram")
        orders.insert(0, orders[0].groupBy(suffix).agg(F.count(F.lit(1)).alias("c")))
    lower = None
    for order in orders:
        c = F.col("c")
        rows = order.withColumns({"context": F.floor(F.col("gram") / SYMBOLS), "discount": _discount(order)})
        contexts = rows.groupBy("context").agg(
            F.sum("c").alias("total"), (F.sum("discount") / F.sum("c")).alias("weight")
        )
        rows = rows.join(contexts, "context")
        if lower is None:
            shorter = F.lit(1 / SYMBOLS)
        else:
            size = SYMBOLS ** (len(model.grams))
            rows = rows.withColumn("suffix", F.pmod(F.col("gram"), F.lit(size))).join(lower, "suffix")
            shorter = F.col("shorter")
        rows = rows.select("gram", ((c - F.col("discount")) / F.col("total") + F.col("weight") * shorter).alias("p"))
        lower = rows.select(F.col("gram").alias("suffix"), F.col("p").alias("shorter"))
        for table, target in ((rows, model.grams), (contexts.select("context", "weight"), model.contexts)):
            found = table.toArrow()  # bounded by SYMBOLS ** ORDER, see above
            target.append((found.column(0).to_numpy(), found.column(1).to_numpy()))
    return model


def _suffix(context: Column, n: int) -> Column:
    """The last ``n`` code points of a context."""
    return context.bitwiseAND(F.lit((1 << POINT * n) - 1))


def exact_tables(counts: DataFrame, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """For the orders from two: ``context, last, part``, what an n-gram's own count gives it, and ``context, weight``,
    what a context leaves to the order below. ``counts`` has ``context, last, apart, c`` of the full order,
    of the n-grams that have a code point without a symbol."""
    orders = [counts]
    for n in range(ORDER - 2, 0, -1):  # in how many different contexts each shorter n-gram stands
        apart = F.col("apart").bitwiseAND(F.lit((2 << n) - 1)).alias("apart")
        shorter = orders[0].select(_suffix(F.col("context"), n).alias("context"), "last", apart).where("apart > 0")
        orders.insert(0, scratch.keep(shorter.groupBy("context", "last", "apart").agg(F.count(F.lit(1)).alias("c"))))
    tables = []
    for order in orders:
        # A little is always taken off, as what no context leaves to the order below would be impossible.
        rows = order.withColumn("discount", F.greatest(_discount(order), F.lit(LEAST_DISCOUNT)))
        contexts = scratch.keep(
            rows.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("discount") / F.sum("c")).alias("weight"))
        )
        parts = rows.join(contexts.select("context", "total").hint("merge"), "context")
        tables.append(
            (
                parts.select("context", "last", ((F.col("c") - F.col("discount")) / F.col("total")).alias("part")),
                contexts.select("context", "weight"),
            )
        )
    return tables


def refinements(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``context, last, n`` and ``exact``, the n-gram's loss by all code points. The tables grow with the texts, so nothing
    of them is broadcast by way of the driver. ``asked`` has ``n``, how
    often the texts have it, ``apart``, and ``loss`` and ``rest``, of its symbols and of the last code point's share."""
    rows = asked.withColumn("p", F.exp(-F.col("loss") - F.col("rest")))
    for n, (parts, contexts) in enumerate(tables, 1):
        rows = rows.withColumn("_by", _suffix(F.col("context"), n))
        rows = rows.join(contexts.withColumnRenamed("context", "_by").hint("merge"), "_by", "left")
        rows = rows.join(parts.withColumnRenamed("context", "_by").hint("merge"), ["_by", "last"], "left")
        # A context of symbols shares out what they give to the code points without one.
        mass = F.when(F.col("apart").bitwiseAND(F.lit((2 << n) - 2)) > 0, 1.0).otherwise(F.exp(-F.col("loss")))
        counts = F.col("weight").isNotNull() & (F.col("apart").bitwiseAND(F.lit((2 << n) - 1)) > 0)
        refined = mass * F.coalesce("part", F.lit(0.0)) + F.col("weight") * F.col("p")
        rows = rows.withColumn("p", F.when(counts, refined).otherwise(F.col("p"))).drop("_by", "part", "weight")
    exact = F.when(F.col("p") > 0, -F.log("p")).otherwise(F.lit(float("inf")))
    return rows.select("context", "last", "n", exact.alias("exact"))


def asked_grams(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """What ``refinements`` asks for: each different n-gram of the texts with a code point without a symbol."""
    tables = _shared(docs, model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, losses, rest = tables()
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                found = _grams(some.column("text"), table)
                which, apart = found.others()
                context, last = found.exact(which)
                at, n = _counted(last, context)
                loss = losses[found.codes[which[at]]].astype(np.float64)
                share = np.where(last[at] > 0, rest[last[at] - 1], 0) if rest is not None else np.zeros(len(at))
                columns = (context[at], last[at], apart[at], n, loss, share.astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["context", "last", "apart", "n", "loss", "rest"]
    texts = docs.select(F.col(text).alias("text")).where("text is not null")
    rows = texts.mapInArrow(ask, "context long, last long, apart long, n long, loss double, rest double")
    return rows.groupBy("context", "last", "apart").agg(F.sum("n").alias("n"), F.max("loss").alias("loss"), F.max("rest").alias("rest"))


def learn(
    docs: DataFrame, trusted_ids: DataFrame, id: str = "doc_id", text: str = "text"
) -> Model | None:
    """The model by symbols of the rows whose id is in ``trusted_ids``, but for those held back to set
    thresholds; None if there are none."""
    scratch = Scratch(docs.sparkSession)
    model = _learned(docs, trusted_ids, id, text, scratch)[0]
    scratch.close()
    return model


def _learned(
    docs: DataFrame, trusted_ids: DataFrame, id: str, text: str, scratch: Scratch
) -> tuple[Model | None, DataFrame]:
    """The model, and the counts of n-grams for ``exact_tables``."""
    points = scratch.keep(point_counts(docs, text))
    alphabet = _most(points)
    ids = trusted_ids.select(F.col(id).alias("id")).where(~held_back("id"))
    # Labels grow with the documents: both sides are shuffled at any size.
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    trusted = texts.join(ids.hint("merge"), "id", "left_semi")
    found = scratch.keep(gram_counts(trusted, alphabet, rest=True))
    counts = found.where("last = -1").select("gram", "c")
    model = None if counts.isEmpty() else kneser_ney(counts, alphabet)
    if model is not None:
        apart = found.where("last = -2").select((-1 - F.col("gram")).alias("point"), F.col("c").alias("n"))
        model.rest = rest_shares(points, apart, alphabet)
    return model, found.where("last >= 0").select(F.col("gram").alias("context"), "last", "apart", "c")


def _refined(
    docs: DataFrame, trusted_ids: DataFrame, id: str, text: str, kept: Scratch
) -> tuple[Model | None, DataFrame | None]:
    """The model, and ``refinements`` for all n-grams of the texts that need one, written to ``kept``."""
    scratch = Scratch(docs.sparkSession)
    model, counts = _learned(docs, trusted_ids, id, text, scratch)
    exact = None
    if model is not None and model.rest is not None:
        asked = scratch.keep(asked_grams(docs, model, text))
        exact = kept.keep(refinements(asked, exact_tables(counts, scratch)))
    scratch.close()
    return model, exact


def held_back(id: str) -> Column:
    return crc_of_id(id) % 4 == 0


_ready: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray | None]] = {}  # a worker's tables, by model


def _shared(docs: DataFrame, model: Model) -> Callable[[], tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """The symbols, losses and shares of a model, to be called in a task."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        if key not in _ready:
            known = shared.value
            _ready.clear()
            _ready[key] = (symbol_table(known.alphabet), known.losses(), known.rest_losses())
        return _ready[key]

    return tables


class Known:
    """The most frequent refinements, ``KNOWN`` at most, as sorted arrays."""

    def __init__(self, exact: DataFrame) -> None:
        rows = exact.orderBy(F.desc("n"), "context", "last").limit(KNOWN).select("context", "last", "exact").toArrow()
        context, last, values = (rows.column(k).to_numpy() for k in range(3))
        self.contexts, place = np.unique(context, return_inverse=True)
        keys = (place.astype(np.int64) << POINT) | last
        order = np.argsort(keys)
        self.keys, self.exact = keys[order], values[order]

    def of(self, context: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each n-gram's loss, and whether it is known; 0 if not."""
        if not len(self.keys):
            return np.zeros(len(context)), np.zeros(len(context), dtype=bool)
        at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        keys = (at << POINT) | last
        places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.contexts[at] == context) & (self.keys[places] == keys)
        return np.where(found, self.exact[places], 0.0), found


def with_loss(docs: DataFrame, model: Model | None, text: str = "text", known: Known | None = None) -> DataFrame:
    """The table with ``_loss`` (-log p of the whole text) and ``_symbols`` (how many). With ``known`` also
    ``_asked``, the n-grams that it lacks and ``_loss`` leaves out: each once in a text, with its number ``n``."""
    columns = docs.columns
    tables = None if model is None else _shared(docs, model)
    refined = None if known is None else docs.sparkSession.sparkContext.broadcast(known)
    kind = pa.struct([("context", pa.int64()), ("last", pa.int64()), ("n", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, text, 1 << 20):
                loss, n = np.zeros(some.num_rows), np.zeros(some.num_rows, dtype=np.int64)
                asked = pa.ListArray.from_arrays(np.zeros(some.num_rows + 1, dtype=np.int32), pa.array([], kind))
                if tables is not None:
                    table, losses, rest = tables()
                    grams = _grams(some.column(text), table)
                    codes, n = grams.codes, grams.n
                    has = np.flatnonzero(n)
                    values = losses[codes].astype(np.float64)
                    if refined is not None:
                        which = grams.others()[0]
                        context, last = grams.exact(which)
                        values[which], found = refined.value.of(context, last)
                    if len(has):
                        at = np.concatenate([[0], np.cumsum(n[has])[:-1]])
                        loss[has] = np.add.reduceat(values, at)
                        if rest is not None and refined is None:
                            points, lengths = _points(some.column(text))
                            begins = np.cumsum(lengths[has]) - lengths[has]
                            loss[has] += np.add.reduceat(rest[points].astype(np.float64), begins)
                    if refined is not None:
                        row = np.searchsorted(np.cumsum(n), which, side="right")
                        context, last, row = context[~found], last[~found], row[~found]
                        at, times = _counted(last, context, row)
                        fields = [pa.array(c.astype(np.int64)) for c in (context[at], last[at], times)]
                        ends = np.cumsum(np.bincount(row[at], minlength=some.num_rows))
                        offsets = np.concatenate([[0], ends]).astype(np.int32)
                        asked = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=[*kind]))
                added = [pa.array(loss), pa.array(n, pa.int64())] + ([asked] if refined is not None else [])
                names = [*columns, "_loss", "_symbols", "_asked"][: len(columns) + len(added)]
                yield pa.RecordBatch.from_arrays([*some.columns, *added], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    more = "" if known is None else ", _asked array<struct<context: bigint, last: bigint, n: bigint>>"
    return docs.mapInArrow(add, f"{fields}, _loss double, _symbols long{more}")


def _scored(
    docs: DataFrame, model: Model | None, exact: DataFrame | None, text: str, scratch: Scratch, *drop: str
) -> DataFrame:
    """``with_loss`` by all n-grams, written. Texts that have others than the most frequent ``KNOWN`` are joined with them."""
    if exact is None:
        return scratch.keep(with_loss(docs, model, text).drop(*drop))
    rows = with_loss(docs, model, text, Known(exact)).drop(*drop)
    if exact.count() <= KNOWN:
        return scratch.keep(rows.drop("_asked"))
    rows = scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()))
    asked = rows.select("_row", F.explode("_asked").alias("a")).select("_row", "a.*").withColumnRenamed("n", "_n")
    sums = asked.join(exact, ["context", "last"]).groupBy("_row").agg(F.sum(F.col("_n") * F.col("exact")).alias("_more"))
    loss = F.col("_loss") + F.coalesce("_more", F.lit(0.0))
    return scratch.keep(rows.drop("_asked").join(sums, "_row", "left").withColumn("_loss", loss).drop("_row", "_more"))


@dataclass
class Limits:
    """Usual loss per symbol and highest accepted one, by language; None stands for all."""

    usual: dict[str | None, float]
    highest: dict[str | None, float]

    def of(self, which: str, lang: Column) -> Column:
        values = getattr(self, which)
        out = F.lit(values[None])
        for name, value in values.items():
            if name is not None:
                out = F.when(lang == name, value).otherwise(out)
        return out


def _adjusted(usual: Column) -> Column:
    return (F.col("_loss") + PRIOR * usual) / (F.col("_symbols") + PRIOR)


def limits(held: DataFrame, lang: str = "lang") -> Limits:
    """From ``_loss``, ``_symbols`` and the language of trusted texts kept out of the counts.

    One row per language comes to the driver.
    """
    held = held.select(F.col(lang).alias("lang"), "_loss", "_symbols").where("_symbols > 0")
    per = held.groupBy("lang").agg(
        F.sum("_loss").alias("loss"), F.sum("_symbols").alias("n"), F.count(F.lit(1)).alias("rows")
    ).collect()
    if not per:
        return Limits({None: 0.0}, {None: float("inf")})
    usual: dict[str | None, float] = {None: sum(r["loss"] for r in per) / sum(r["n"] for r in per)}
    usual |= {r["lang"]: r["loss"] / r["n"] for r in per if r["lang"] is not None and r["rows"] >= LEAST}
    found = Limits(usual, {})
    x = _adjusted(found.of("usual", F.col("lang"))) - found.of("usual", F.col("lang"))
    quantiles = F.percentile_approx("x", [0.5, 0.95], 10_000)
    apart = held.withColumn("x", x)
    for row in [
        *apart.groupBy("lang").agg(quantiles.alias("q")).collect(),
        *apart.agg(F.lit(None).cast("string").alias("lang"), quantiles.alias("q")).collect(),
    ]:
        if row["lang"] in usual:  # the row of all texts comes last
            middle, high = row["q"]
            found.highest[row["lang"]] = usual[row["lang"]] + middle + REACH * (high - middle)
    return found


def judged(rows: DataFrame, found: Limits, lang: str = "lang") -> DataFrame:
    """``_loss`` and ``_symbols`` replaced by ``perplexity``, ``threshold`` and ``kept``."""
    x = _adjusted(found.of("usual", F.col(lang)))
    highest = found.of("highest", F.col(lang))
    return rows.select(
        *[c for c in rows.columns if c not in ("_loss", "_symbols")],
        F.exp(x).alias("perplexity"),
        F.exp(highest).alias("threshold"),
        ((F.col("_symbols") == 0) | (x <= highest)).alias("kept"),
    )


def quality(
    docs: DataFrame, trusted_ids: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The id, ``perplexity``, ``threshold`` and ``kept`` of every row."""
    rows, found = _measured(docs, trusted_ids, id, text, lang)[:2]
    return judged(rows, found, "lang").drop("lang").withColumnRenamed("id", id)


def good_documents(
    docs: DataFrame, trusted_ids: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows that are kept, with the input's columns."""
    scratch = Scratch(docs.sparkSession)
    model, exact = _refined(docs, trusted_ids, id, text, scratch)
    renamed = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
    rows = _scored(renamed, model, exact, f"in_{text}", scratch)  # texts are scored once
    found = limits(_held(rows, trusted_ids, id), f"in_{lang}")
    kept = judged(rows, found, f"in_{lang}").where("kept")
    return kept.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def _held(rows: DataFrame, trusted_ids: DataFrame, id: str) -> DataFrame:
    """Rows of trusted texts that were held back, of a table whose columns begin with ``in_``."""
    ids = trusted_ids.select(F.col(id).alias(f"in_{id}")).where(held_back(f"in_{id}"))
    return rows.join(ids, f"in_{id}", "left_semi")


def _measured(
    docs: DataFrame, trusted_ids: DataFrame, id: str, text: str, lang: str
) -> tuple[DataFrame, Limits, Model | None]:
    scratch = Scratch(docs.sparkSession)
    model, exact = _refined(docs, trusted_ids, id, text, scratch)
    source = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("_text"))
    rows = _scored(source, model, exact, "_text", scratch, "_text")
    ids = trusted_ids.select(F.col(id).alias("id")).where(held_back("id"))
    return rows, limits(rows.join(ids, "id", "left_semi")), model
