"""The documents that match each query item best by weighted terms: reversed search.

Items, not documents, are indexed. The inverted index from terms to items is broadcast, the
documents stream past it once, each document's term counts add to the scores of the items that
share a term, and every task keeps a bounded heap for each item. The heaps are merged in two
rounds, so that no task gets all heaps of an item at once.

A term is a longest run of bytes other than ASCII ones that are neither letter nor digit, with A-Z
lower-cased; it stands as a 64-bit hash (words.py). Scores are whole numbers, see ``contributions``.
Documents need no index, and no row about a (document, item) pair leaves a task unless it is among
the best ``k`` of that task.

The index is dealt in blocks of about ``POSTINGS`` (term, item) pairs, 16 bytes each, so what is broadcast
is bounded however many items there are; documents pass once for each block's counts and once
for its scores. One item's terms stay in one block.

Rows of ``items`` that are equal in id and text are one item; rows with one id and different texts
are different items under that id. Null texts, and texts without a term, match nothing. Repeated
documents are ranked one by one; of equal scores the smaller id comes first, a null id last. Empty tables
give an empty result. Columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch, pieces
from tagloom.llm.words import Words, slices, words_of

POSTINGS = 1 << 22  # (term, item) pairs of one broadcast index
CELLS = 1 << 22  # scores held at once in a task
FIRST_MERGE = 64  # groups of tasks whose heaps of an item are merged first

# Fixed values of the ranking.
SCALE, SATURATION, LENGTH_PART, LENGTH_FIXED = 1_000_000_000, 12, 25, 75

_GAPS = np.ones(256, dtype=bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_DOCUMENTS, _TERMS = -1, -2  # stand in place of a term's number in the counts


def terms_of(column: pa.Array) -> Words:
    return words_of(column, fold_case=True, gaps=_GAPS)


@dataclass
class Index:
    """Sorted terms; the items that hold term t are at ``at[t]`` to ``at[t + 1]``."""

    terms: np.ndarray
    at: np.ndarray
    items: np.ndarray
    times: np.ndarray  # that the item holds the term
    ids: list[int | None]

    @classmethod
    def of(cls, rows: pa.Table) -> Index:
        lists = rows.column("terms").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        times = rows.column("times").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        owners = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(hashes, kind="stable")
        terms, first = np.unique(hashes[order], return_index=True)
        at = np.append(first, len(order)).astype(np.int64)
        return cls(terms, at, owners[order], times[order], rows.column("item_id").to_pylist())

    def found_in(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the indexed terms in some texts, by text."""
        place = np.minimum(np.searchsorted(self.terms, words.hashes), len(self.terms) - 1)
        hit = self.terms[place] == words.hashes
        keys, often = np.unique(words.owners()[hit] * len(self.terms) + place[hit], return_counts=True)
        return keys // len(self.terms), keys % len(self.terms), often


def _item_terms(items: DataFrame) -> DataFrame:
    """Each distinct item's distinct terms and how often it holds them."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = terms_of(batch.column("text"))
                terms, times = [], []
                for low, high in zip(words.at[:-1], words.at[1:], strict=True):
                    mine, often = np.unique(words.hashes[low:high], return_counts=True)
                    terms.append(mine.view(np.int64))
                    times.append(often.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").cast(pa.int64()),
                        pa.array(terms, pa.list_(pa.int64())),
                        pa.array(times, pa.list_(pa.int64())),
                    ],
                    names=["item_id", "terms", "times"],
                )

    rows = items.select("item_id", "text").distinct()
    found = rows.mapInArrow(split, "item_id long, terms array<long>, times array<long>")
    return found.where(F.size("terms") > 0)


def _counted(docs: DataFrame, index: Index) -> DataFrame:
    """How many documents hold each term, and how many documents and terms there are in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = np.zeros(len(index.terms), dtype=np.int64)
        documents = total = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                words = terms_of(batch.column("text"))
                documents += int(np.count_nonzero(words.counts()))
                total += len(words.hashes)
                holding += np.bincount(index.found_in(words)[1], minlength=len(index.terms))
        some = np.flatnonzero(holding)
        number = np.concatenate([[_DOCUMENTS, _TERMS], some])
        counts = np.concatenate([[documents, total], holding[some]])
        yield pa.RecordBatch.from_pydict({"number": pa.array(number, pa.int64()), "n": pa.array(counts, pa.int64())})

    rows = docs.select("text").mapInArrow(count, "number long, n long")
    return rows.groupBy("number").agg(F.sum("n").alias("n"))


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], dtype=np.int64)


def length_terms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """A document's m, by its number of terms."""
    if LENGTH_PART * int(n.max(initial=0)) * documents >= 1 << 63:
        return np.array([LENGTH_FIXED + LENGTH_PART * int(x) * documents // total for x in n], dtype=np.int64)
    return LENGTH_FIXED + (LENGTH_PART * n * documents) // total


def contributions(weight: np.ndarray, often: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((SCALE * often) // (1000 * often + SATURATION * m))


class Heaps:
    """For each item the best ``k`` of (score, id) seen so far; a score of 0 is an empty place."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.scores = np.zeros((items, k), dtype=np.int64)
        self.ids = np.zeros((items, k), dtype=np.int64)
        self.nulls = np.zeros((items, k), dtype=bool)

    def update(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """``scores``: a row for each document, a column for each item."""
        floor = np.maximum(self.scores[:, -1], 1)
        if len(scores) > self.k:
            floor = np.maximum(floor, np.partition(scores, len(scores) - self.k, axis=0)[-self.k])
        doc, item = np.nonzero(scores >= floor)
        if not len(doc):
            return
        changed, item_at = np.unique(item, return_inverse=True)
        old = np.repeat(np.arange(len(changed)), self.k)
        owner = np.concatenate([item_at, old])
        score = np.concatenate([scores[doc, item], self.scores[changed].ravel()])
        key = np.concatenate([ids[doc], self.ids[changed].ravel()])
        null = np.concatenate([nulls[doc], self.nulls[changed].ravel()])
        order = np.lexsort((key, null, -score, owner))
        owner = owner[order]
        begin = np.searchsorted(owner, np.arange(len(changed)))
        best = order[(begin[:, None] + np.arange(self.k))]
        self.scores[changed], self.ids[changed], self.nulls[changed] = score[best], key[best], null[best]


def _scored(docs: DataFrame, index: Index, weight: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """Every task's best ``k`` documents of each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(index.ids), k)
        for whole in batches:
            for batch in slices(whole, "text"):
                words = terms_of(batch.column("text"))
                ids = batch.column("doc_id").cast(pa.int64())
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                m = length_terms(words.counts(), documents, total)
                doc, term, often = index.found_in(words)
                value = contributions(weight[term], often, m[doc])
                _stream(heaps, index, doc, term, value, ids, nulls)
        item, place = np.nonzero(heaps.scores)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(item), TaskContext.get().partitionId()), pa.int32()),
                pa.array(item, pa.int32()),
                pa.array([index.ids[i] for i in item], pa.int64()),
                pa.array(heaps.ids[item, place], pa.int64(), mask=heaps.nulls[item, place]),
                pa.array(heaps.scores[item, place], pa.int64()),
            ],
            names=["task", "item", "item_id", "doc_id", "score"],
        )

    schema = "task int, item int, item_id long, doc_id long, score long"
    return docs.select("doc_id", "text").mapInArrow(search, schema)


def _stream(
    heaps: Heaps, index: Index, doc: np.ndarray, term: np.ndarray, value: np.ndarray, ids: np.ndarray, nulls: np.ndarray
) -> None:
    """Adds the documents' counts, in runs of documents with a bounded number of scores."""
    if not len(doc):
        return
    items = len(index.ids)
    holders = index.at[term + 1] - index.at[term]
    firsts = np.flatnonzero(np.diff(doc, prepend=-1))  # where each document's terms begin
    filled = np.add.reduceat(holders, firsts)
    group = np.maximum(np.cumsum(filled), (np.arange(len(firsts)) + 1) * items) // CELLS
    cuts = np.flatnonzero(np.diff(group, prepend=-1))
    for low, high in zip(cuts, np.append(cuts[1:], len(firsts)), strict=True):
        begin, end = firsts[low], firsts[high] if high < len(firsts) else len(doc)
        sizes = holders[begin:end]
        entry = np.repeat(np.arange(begin, end), sizes)
        within = np.arange(len(entry)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        posting = index.at[term[entry]] + within
        mine = doc[firsts[low:high]]
        scores = np.zeros((high - low, items), dtype=np.int64)
        cell = np.searchsorted(mine, doc[entry]) * items + index.items[posting]
        np.add.at(scores.ravel(), cell, value[entry] * index.times[posting])
        heaps.update(scores, ids[mine], nulls[mine])


def _best(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20, postings: int = POSTINGS) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's best ``k`` of ``docs``
    with a score above 0. ``docs`` has doc_id and text, ``items`` has item_id and text."""
    scratch = Scratch(docs.sparkSession)
    terms = scratch.keep(_item_terms(items))
    size = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = pieces(size, postings)
    found = []
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block)
        index = Index.of(mine.toArrow())
        if not index.ids:
            continue
        counts = {r["number"]: r["n"] for r in _counted(docs, index).collect()}
        documents, total = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
        holding = np.array([counts.get(i, 0) for i in range(len(index.terms))], dtype=np.int64)
        rows = _scored(docs, index, weights(documents, holding), documents, max(total, 1), k)
        some = _best(rows.withColumn("group", F.col("task") % FIRST_MERGE), k, "item", "group")
        found.append(scratch.keep(_best(some.drop("rank"), k, "item").select("item_id", "rank", "doc_id", "score")))
    scratch.drop(terms)
    if not found:
        empty = "item_id long, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
