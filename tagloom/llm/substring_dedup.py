"""Passages of at least ``window`` words that stand in more than one place, found whole.

1. Each window has a seed: the smallest hash among its runs of ``SEED_WORDS`` words. Equal
   windows have equal seeds, so a window recurs only if its seed does. Seeds (one word in
   fourteen) are counted over all texts; those that recur set bits of a filter of fixed size.
   A bit that two seeds share only adds candidates.
2. Texts are cut into units of a few MB. Windows whose seed is in the filter are candidates;
   each unit sends every candidate's hash once to the shard of its hash, which confirms those
   that occur in two units, or twice in one, and answers the units.
3. Each unit compiles its confirmed passages, runs of confirmed windows, into an Aho-Corasick
   automaton over words, and streams its texts through it. Every occurrence is covered.

A passage that a third of all texts share is sent once per unit, not once per text. Shards and
units have a bounded size; nothing but the filter comes to the driver.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, pieces
from tagloom.llm.words import Words, runs, slices, words_of

WINDOW = 35
SEED_WORDS = 8
FILTER_BITS = 26
SEED_SHARD_BYTES, WINDOW_SHARD_BYTES = 128 << 20, 64 << 20  # of text that a shard stands for
UNIT_BYTES = 4 << 20


def _sliding(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``span`` values, at its first; shorter at the end."""
    out, done = values.copy(), 1
    while done < span:
        step = min(done, span - done)
        out[:-step] = pick(out[:-step], out[step:]) if step < len(out) else out[:-step]
        done += step
    return out


class _Windows:
    """Windows of some texts, with hashes and seeds."""

    def __init__(self, words: Words, window: int) -> None:
        span = window - SEED_WORDS + 1
        self.hashes, self.owners, self.first = runs(words.hashes, words.at, window)
        grams, _, place = runs(words.hashes, words.at, SEED_WORDS)
        self.grams = np.full(len(words.hashes), np.uint64(2**64 - 1))
        self.grams[place] = grams
        least = _sliding(self.grams, span, np.minimum)
        self.seeds = least[self.first]
        # A place is a seed's if some window that holds it has its hash for the smallest.
        of_window = np.zeros(len(words.hashes), dtype=np.uint64)
        of_window[self.first] = self.seeds
        padded = np.concatenate([np.zeros(span - 1, dtype=np.uint64), of_window])
        most = _sliding(padded, span, np.maximum)[: len(of_window)]
        chosen = (most == self.grams) & (self.grams != np.uint64(2**64 - 1))
        self.seed_places = self.grams[chosen]


def _once(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and which of them are there more than once."""
    found, counts = np.unique(hashes, return_counts=True)
    return found, counts > 1


def _shard_rows(part: int, hashes: np.ndarray, bounds: np.ndarray) -> dict[str, list]:
    """A row for each shard that gets some of a unit's hashes."""
    found, more = _once(hashes)
    cuts = np.searchsorted(found >> np.uint64(64 - FILTER_BITS), bounds)
    rows: dict[str, list] = {"part": [], "shard": [], "hashes": [], "more": []}
    for shard in range(len(bounds) - 1):
        low, high = cuts[shard], cuts[shard + 1]
        if high > low:
            rows["part"].append(part)
            rows["shard"].append(shard)
            rows["hashes"].append(found[low:high].tobytes())
            rows["more"].append(np.packbits(more[low:high]).tobytes())
    return rows


_SHARD = "part long, shard int, hashes binary, more binary"


def _bounds(shards: int) -> np.ndarray:
    """Where shards begin in the range of the filter's bits, at whole bytes."""
    cuts = (np.arange(shards + 1, dtype=np.int64) << FILTER_BITS) // shards
    return (cuts // 8 * 8).astype(np.uint64)


def _recurring(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All hashes of a shard's rows, their rows, and which of them recur."""
    lists = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
    flags = [
        np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(n)).astype(bool)
        for x, n in zip(rows.column("more").to_pylist(), lists, strict=True)
    ]
    hashes, again = np.concatenate(lists), np.concatenate(flags)
    owners = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return hashes, owners, again


def recurring_seeds(docs: DataFrame, text: str, window: int, total_bytes: int) -> np.ndarray:
    """The filter: a bit for the leading bits of each seed that stands in two places."""
    bounds = _bounds(pieces(total_bytes, SEED_SHARD_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in slices(batch, "text", UNIT_BYTES):
                words = words_of(unit.column("text"))
                rows = _shard_rows(0, _Windows(words, window).seed_places, bounds)
                yield pa.RecordBatch.from_pydict(rows, schema=_arrow_schema())

    def settle(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        hashes, _, again = _recurring(rows)
        low, high = int(bounds[shard]), int(bounds[shard + 1])
        bits = np.zeros(high - low, dtype=bool)
        bits[(hashes[again] >> np.uint64(64 - FILTER_BITS)).astype(np.int64) - low] = True
        return pa.table({"at": pa.array([low // 8]), "bits": pa.array([np.packbits(bits).tobytes()])})

    sent = docs.select(F.col(text).alias("text")).mapInArrow(send, _SHARD)
    found = sent.groupBy("shard").applyInArrow(settle, "at long, bits binary").collect()
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)  # 8 MB in all
    for row in found:
        bits = np.frombuffer(row["bits"], dtype=np.uint8)
        out[row["at"] : row["at"] + len(bits)] = bits
    return out


def _arrow_schema() -> pa.Schema:
    return pa.schema([("part", pa.int64()), ("shard", pa.int32()), ("hashes", pa.binary()), ("more", pa.binary())])


def _in_filter(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    at = (seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def covered_words(words: Words, window: int, confirmed: np.ndarray) -> list[list[tuple[int, int]]]:
    """Spans of words of each text that some confirmed passage covers, by an automaton.

    ``confirmed`` has the hashes of windows that recur, in order.
    """
    hashes, owners, first = runs(words.hashes, words.at, window)
    at = np.searchsorted(confirmed, hashes)
    inside = at < len(confirmed)
    inside[inside] = confirmed[at[inside]] == hashes[inside]
    owners, first = owners[inside], first[inside]
    if not len(first):
        return [[] for _ in range(len(words))]
    # Windows that begin one word apart are one passage.
    cut = np.flatnonzero((np.diff(first) != 1) | (np.diff(owners) != 0)) + 1
    begins = first[np.append(0, cut)]
    ends = first[np.append(cut - 1, len(first) - 1)] + window
    numbers = np.unique(words.hashes, return_inverse=True)[1]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        automaton.add_word(tuple(numbers[begin:end].tolist()), end - begin)
    automaton.make_automaton()
    out: list[list[tuple[int, int]]] = []
    for low, high in zip(words.at[:-1].tolist(), words.at[1:].tolist(), strict=True):
        spans: list[tuple[int, int]] = []
        if high - low >= window:
            for last, length in automaton.iter(tuple(numbers[low:high].tolist())):
                begin, end = last + 1 - length, last + 1
                while spans and spans[-1][1] >= begin:  # matches come by their end
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, end))
        out.append(spans)
    return out


def _outcome(words: Words, spans: list[list[tuple[int, int]]], with_text: bool) -> dict[str, list]:
    """Result columns of some texts."""
    rows: dict[str, list] = {"n_words": [], "spans": [], "kept_sha256": []}
    if with_text:
        rows["kept_text"] = []
    for i, removed in enumerate(spans):
        low, high = int(words.at[i]), int(words.at[i + 1])
        keep = np.ones(high - low, dtype=bool)
        for begin, end in removed:
            keep[begin:end] = False
        kept = low + np.flatnonzero(keep)
        data = b"" if not len(kept) else b" ".join(
            words.data[b:e].tobytes() for b, e in zip(words.starts[kept], words.ends[kept], strict=True)
        ) if removed else b" ".join(words.data[words.starts[low] : words.ends[high - 1]].tobytes().split())
        rows["n_words"].append(high - low)
        rows["spans"].append([{"begin": b, "end": e} for b, e in removed])
        rows["kept_sha256"].append(hashlib.sha256(data).hexdigest())
        if with_text:
            rows["kept_text"].append(data.decode())
    return rows


_RESULT = "n_words long, spans array<struct<begin: long, end: long>>, kept_sha256 string"
_RESULT_ARROW = [
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ("kept_sha256", pa.string()),
]


def removed_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = False
) -> DataFrame:
    """For every row its id, ``n_words``, ``spans`` (word places [begin, end) that a recurring
    window covers, in order, apart), ``kept_sha256`` (of the other words joined by one space)
    and, if asked for, these as ``kept_text``.

    A null text has no words. Every row is a document of its own, whatever its id: a repeated
    row's windows recur. Only the id of the other columns is carried. An empty table gives none.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    total = int(source.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    filter_ = spark.sparkContext.broadcast(recurring_seeds(source, "text", window, total))
    bounds = _bounds(pieces(total, WINDOW_SHARD_BYTES))
    id_type = source.schema["id"].dataType.simpleString()
    result = _RESULT + (", kept_text string" if with_text else "")
    result_arrow = _RESULT_ARROW + ([("kept_text", pa.string())] if with_text else [])
    names = [n for n, _ in result_arrow]

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of texts without candidates, texts with some, and hashes for the shards."""
        for batch in batches:
            ids = batch.schema.field("id").type
            schema = pa.schema(
                [("kind", pa.string()), *_arrow_schema(), ("id", ids), ("text", pa.string()), *result_arrow]
            )
            for unit in slices(batch, "text", UNIT_BYTES):
                words = words_of(unit.column("text"))
                windows = _Windows(words, window)
                candidate = _in_filter(filter_.value, windows.seeds)
                part = secrets.randbits(63)
                rows = _shard_rows(part, windows.hashes[candidate], bounds)
                yield _filled({"kind": ["hashes"] * len(rows["part"])} | rows, schema)
                open_ = np.zeros(unit.num_rows, dtype=bool)
                open_[windows.owners[candidate]] = True
                done, left = unit.filter(pa.array(~open_)), unit.filter(pa.array(open_))
                found = _outcome(words_of(done.column("text")), [[]] * done.num_rows, with_text)
                yield _filled({"kind": ["done"] * done.num_rows, "id": done.column("id")} | found, schema)
                yield _filled(
                    {"kind": ["open"] * left.num_rows, "part": [part] * left.num_rows,
                     "id": left.column("id"), "text": left.column("text")}, schema,
                )

    sifted = scratch.keep(
        source.mapInArrow(sift, f"kind string, {_SHARD}, id {id_type}, text string, {result}"), "kind"
    )

    def confirm(rows: pa.Table) -> pa.Table:
        hashes, owners, again = _recurring(rows)
        parts = rows.column("part").to_numpy()
        cuts = np.cumsum(np.bincount(owners[again], minlength=len(parts)))
        lists = np.split(hashes[again], cuts[:-1])
        return pa.table({"part": pa.array(parts), "hashes": pa.array([x.tobytes() for x in lists], pa.binary())})

    sent = sifted.where("kind = 'hashes'").select("part", "shard", "hashes", "more")
    confirmed = sent.groupBy("shard").applyInArrow(confirm, "part long, hashes binary")
    confirmed = confirmed.where(F.octet_length("hashes") > 0).withColumnRenamed("part", "of_part")

    def locate(texts: pa.Table, answers: pa.Table) -> pa.Table:
        known = [np.frombuffer(x, dtype=np.uint64) for x in answers.column("hashes").to_pylist()]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, dtype=np.uint64)
        words = words_of(texts.column("text").combine_chunks())
        found = _outcome(words, covered_words(words, window, known), with_text)
        types = dict(result_arrow)
        return pa.table(
            [texts.column("id"), *[pa.array(found[n], types[n]) for n in names]], names=["id", *names]
        )

    open_ = sifted.where("kind = 'open'").select("part", "id", "text")
    located = (
        open_.groupBy("part")
        .cogroup(confirmed.groupBy("of_part"))
        .applyInArrow(locate, f"id {id_type}, {result}")
    )
    done = sifted.where("kind = 'done'").select("id", *names)
    return done.unionByName(located).withColumnRenamed("id", id)


def _filled(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of these columns, and nulls in the others."""
    n = len(columns["kind"])
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(n, field.type))
        else:
            arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
