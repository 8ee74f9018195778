"""Documents that hold benchmark items, word for word or paraphrased.

1. Word weights: inverse document frequencies over all documents, in a table of fixed size.
   Words that more than ``COMMON`` of the documents have weigh nothing; the others are informative.
2. Latent space: a randomised SVD of ``RANK`` TF-IDF passages of the benchmark at a time, with
   as many dimensions as passages, so that no passage loses energy. Tasks sum up A'(A X) for a
   random X, in ``POWERS`` rounds; the driver only makes the sums orthogonal.
3. Candidates: documents are streamed as overlapping windows, folded into the latent space,
   and compared with the benchmark passages by cosine. A window's length is its TF-IDF length
   before folding, so words outside the space count against it.
4. Check: the longest common subsequence of the passage and the words around the window. From
   ``VERBATIM`` of the passage on it is a copy; from ``PARAPHRASE`` on it is one if the
   item's answer is there too: its column ``answer``, or else its last ``ANSWER_WORDS`` words.
5. Passages with few informative words, such as those of a leak so wide that its own words are
   common, are looked for a second time, with all words at one weight, if they have ``PLAIN``
   words or more; a paraphrase has ``PLAIN_PARAPHRASE`` of them then. And every passage, of whatever words, is looked for as a run of words: seeds
   of up to ``SEED_WORDS`` words are found by hash, and the whole run is compared.

Documents are streamed once for every ``SPACES`` latent spaces and ``ITEMS`` items at most, which
bounds what the tasks hold; they are never shuffled. Items longer than ``PASSAGE`` words are several passages, each enough by itself.

Very long texts are streamed whole, window by window. Without documents or without a benchmark
nothing is found. Only ids, texts and answers are looked at, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.arrays import gathered
from tagloom.llm.words import Words, runs, slices, words_of

IDF_BITS = 18
COMMON = 0.05
PASSAGE = 96
STEP = 16  # words of a block; windows are 2, 4 or 8 blocks and move by half their length
RANK, POWERS, SEED = 256, 2, 3
ITEMS, SPACES = 1000, 8
COSINE = 0.25
VERBATIM, PARAPHRASE = 0.8, 0.5
ANSWER_WORDS, ANSWER = 4, 0.75
LEAST_WORDS = 3  # informative words that a window shares with the benchmark
PLAIN = 12  # shorter passages of common words are in most texts by chance, unless as a run
PLAIN_PARAPHRASE = 2 / 3  # and so is half of a longer one, word by word
SEED_WORDS = 8


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - IDF_BITS)).astype(np.int64)


def word_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The weight of each bucket of words, from all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((1 << IDF_BITS) + 1, dtype=np.int64)  # and the number of texts
        for batch in batches:
            for some in slices(batch, "text"):
                words = words_of(some.column("text"), fold_case=True)
                pairs = (words.owners() << IDF_BITS) | _bucket(words.hashes)
                if len(words) <= 1 << (32 - IDF_BITS):
                    pairs = pairs.astype(np.uint32)  # sorted faster
                pairs.sort()
                once = pairs[np.flatnonzero(np.diff(pairs, prepend=~pairs[:1]))] & ((1 << IDF_BITS) - 1)
                total[:-1] += np.bincount(once, minlength=1 << IDF_BITS)
                total[-1] += len(words)
        return total

    counts = gathered(docs.select(F.col(text).alias("text")).where("text is not null"), count)
    if counts is None:
        return np.zeros(1 << IDF_BITS, dtype=np.float32)
    frequency, n = counts[:-1], counts[-1]
    weights = np.log((n + 1) / (frequency + 1))
    weights[frequency > max(COMMON * n, 3)] = 0
    return weights.astype(np.float32)


@dataclass
class Passages:
    """Part of a benchmark, ready to be looked for."""

    items: list[object]
    words: list[list[int]]  # hashes
    answers: list[list[int]]
    weights: np.ndarray  # of each bucket of words
    least: int  # words of the vocabulary that a window has
    paraphrase: float  # share of the passage that a paraphrase has
    vocabulary: np.ndarray  # hashes of words with a weight, in order
    space: np.ndarray | None = None  # vocabulary x rank, weights included
    folded: np.ndarray | None = None  # passages x rank, unit length before folding

    def vectors(self, which: slice = slice(None)) -> np.ndarray:
        """Unit TF-IDF rows."""
        out = np.zeros((len(self.words[which]), len(self.vocabulary)), dtype=np.float32)
        for row, hashes in zip(out, self.words[which], strict=True):
            found = np.array(hashes, dtype=np.uint64)
            at = np.searchsorted(self.vocabulary, found)
            inside = at < len(self.vocabulary)
            inside[inside] = self.vocabulary[at[inside]] == found[inside]
            np.add.at(row, at[inside], self.weights[_bucket(found[inside])])
            row /= max(np.linalg.norm(row), 1e-9)
        return out


def _window_blocks(n_words: int) -> int:
    """Blocks of the window in which a passage is looked for: a third longer at least."""
    return 2 if 4 * n_words <= 6 * STEP else 4 if 4 * n_words <= 12 * STEP else 8


@dataclass
class Block:
    """Passages that are looked for in one pass over the documents."""

    parts: list[Passages]
    items: list[object]
    words: list[list[int]]
    seeds: list[int]  # where the seed of each passage begins


def _few_informative(weights: np.ndarray) -> bool:
    n = np.count_nonzero(weights)
    return len(weights) >= PLAIN and bool(n < 2 * LEAST_WORDS or 3 * n < len(weights))


def _seed_words(n: int) -> int:
    return min(SEED_WORDS, 1 << (n.bit_length() - 1))


def blocks_of(rows: list[tuple[object, str, str | None]], weights: np.ndarray) -> Iterator[Block]:
    """The items' passages, for each kind of weights ``SPACES`` times ``RANK`` at most in a block."""
    items, lists, answers = [], [], []
    for item, text, answer in rows:
        column = pa.array([text, answer], pa.string())
        words = words_of(column, fold_case=True)
        own = words.hashes[: words.at[1]].tolist()
        told = words.hashes[words.at[1] :].tolist() or own[-ANSWER_WORDS:]
        parts = max(1, -(-len(own) // PASSAGE))
        for part in np.array_split(np.array(own, dtype=np.uint64), parts):
            if len(part):
                items.append(item)
                lists.append(part.tolist())
                answers.append(told)
    own_weights = [weights[_bucket(np.array(x, dtype=np.uint64))] for x in lists]
    alike = np.ones_like(weights)
    for low in range(0, len(lists), SPACES * RANK):
        every = range(low, min(low + SPACES * RANK, len(lists)))
        parts = _spaces([k for k in every if own_weights[k].any()], items, lists, answers, weights, LEAST_WORDS, PARAPHRASE)
        few = [k for k in every if _few_informative(own_weights[k])]
        parts += _spaces(few, items, lists, answers, alike, 1, PLAIN_PARAPHRASE)
        seeds = []
        for k in every:  # the run of most weight
            sums = np.convolve(own_weights[k], np.ones(_seed_words(len(lists[k]))), "valid")
            seeds.append(int(sums.argmax()))
        yield Block(parts, items[low : every.stop], lists[low : every.stop], seeds)


def _spaces(
    which: list[int], items: list[object], lists: list[list[int]], answers: list[list[int]],
    weights: np.ndarray, least: int, paraphrase: float,
) -> list[Passages]:
    out = []
    for low in range(0, len(which), RANK):
        some = which[low : low + RANK]
        every = np.unique(np.array([h for k in some for h in lists[k]], dtype=np.uint64))
        known = every[weights[_bucket(every)] > 0]
        out.append(
            Passages(
                [items[k] for k in some], [lists[k] for k in some], [answers[k] for k in some],
                weights, least, paraphrase, known,
            )
        )
    return out


def latent_space(benchmark: DataFrame, passages: Passages) -> None:
    """Fills in the space: right singular vectors of the passages' TF-IDF rows."""
    spark = benchmark.sparkSession
    n = len(passages.vocabulary)
    rank = min(n, len(passages.words))
    shared = spark.sparkContext.broadcast(passages)
    tasks = max(1, len(passages.words) // 64)
    numbers = spark.range(0, len(passages.words), 1, tasks)

    def product(basis: np.ndarray, inner: bool) -> np.ndarray:
        sent = spark.sparkContext.broadcast(basis.astype(np.float32))

        def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((rank, rank) if inner else basis.shape)
            for batch in batches:
                which = batch.column("id").to_numpy()
                rows = shared.value.vectors(slice(int(which[0]), int(which[-1]) + 1))
                folded = rows @ sent.value
                total += folded.T @ folded if inner else rows.T @ folded
            return total

        out = gathered(numbers, fill)
        assert out is not None
        return out

    basis = np.random.default_rng(SEED).normal(size=(n, rank))
    for _ in range(POWERS):
        basis = np.linalg.qr(product(basis, False))[0]
    values, turn = np.linalg.eigh(product(basis, True))
    useful = values > 1e-6 * max(values.max(), 1e-12)
    space = (basis @ turn[:, useful]).astype(np.float32)
    passages.folded = passages.vectors() @ space
    passages.space = space * passages.weights[_bucket(passages.vocabulary)][:, None]


def places_of(a: list[int]) -> dict[int, int]:
    """Where each word stands, as bits of a number."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    return places


def common_subsequence(a: list[int], b: list[int], places: dict[int, int] | None = None, least: float = 0) -> int:
    """Length of the longest one, by whole rows of the table as bits of a number. ``places`` are
    those of ``a`` where they are known; where fewer than ``least`` words of ``b`` are in ``a``, which
    bounds the length, that number may stand for it."""
    if places is None:
        places = places_of(a)
    met = [places[x] for x in b if x in places]  # other words leave the row as it is
    if len(met) < least:
        return len(met)
    full = (1 << len(a)) - 1
    row = full
    for bits in met:
        match = row & bits
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


class Search:
    """Looks for passages in the words of texts; one per task."""

    def __init__(self, passages: Passages) -> None:
        self.passages, self.weights = passages, passages.weights
        self.slots = np.full(1 << 20, -1, dtype=np.int64)  # first word of the vocabulary there
        slot = (passages.vocabulary >> np.uint64(44)).astype(np.int64)
        self.slots[slot[::-1]] = np.arange(len(slot))[::-1]
        kinds = np.array([_window_blocks(len(w)) for w in passages.words], dtype=np.int64)
        self.by_blocks = {b: np.flatnonzero(kinds == b) for b in (2, 4, 8)}
        self.places = [places_of(w) for w in passages.words]

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in the vocabulary, and their places there."""
        maybe = np.flatnonzero(self.slots[(hashes >> np.uint64(44)).astype(np.int64)] >= 0)
        at = np.searchsorted(self.passages.vocabulary, hashes[maybe])
        at = np.minimum(at, len(self.passages.vocabulary) - 1)
        same = self.passages.vocabulary[at] == hashes[maybe]
        return maybe[same], at[same]

    def matches(self, words: Words) -> Iterator[tuple[int, object, float, float, str]]:
        """(text, item, cosine, share of the passage found, kind) of what passes the check."""
        p = self.passages
        if p.space is None or p.folded is None or not len(p.vocabulary) or not len(words.hashes):
            return
        places, columns = self.known(words.hashes)
        if not len(places):
            return
        # Blocks of STEP words, each within one text; a text's blocks are in a row.
        counts = -(-words.counts() // STEP)
        begins = np.concatenate([[0], np.cumsum(counts)])
        owner = words.owners()
        block = begins[:-1][owner] + (np.arange(len(owner)) - words.at[:-1][owner]) // STEP
        weight = self.weights[_bucket(words.hashes)].astype(np.float64)
        length = np.bincount(block, weight * weight, begins[-1])
        found = np.bincount(block[places], minlength=begins[-1])
        some = np.flatnonzero(found)
        starts = np.searchsorted(block[places], some)
        folded = np.zeros((begins[-1] + 8, p.space.shape[1]), dtype=np.float32)
        folded[some] = np.add.reduceat(p.space[columns], starts, axis=0)
        length, found = np.append(length, np.zeros(8)), np.append(found, np.zeros(8, dtype=np.int64))
        block_owner = np.append(np.repeat(np.arange(len(words)), counts), np.full(8, -1))
        for size, which in self.by_blocks.items():
            if not len(which):
                continue
            first = np.arange(begins[-1])
            first = first[(first - begins[block_owner[first]]) % (size // 2) == 0]
            # Only blocks of the same text count.
            shared = sum((found[first + k] * (block_owner[first + k] == block_owner[first]) for k in range(size)))
            first = first[shared >= p.least]
            for low in range(0, len(first), 4096):
                some = first[low : low + 4096]
                total, square = np.zeros((len(some), folded.shape[1]), np.float32), np.zeros(len(some))
                for k in range(size):
                    own = block_owner[some + k] == block_owner[some]
                    total += folded[some + k] * own[:, None]
                    square += length[some + k] * own
                near = total @ p.folded[which].T / np.sqrt(np.maximum(square, 1e-9))[:, None]
                for row, column in zip(*np.nonzero(near >= COSINE), strict=True):
                    text, passage = int(block_owner[some[row]]), int(which[column])
                    kind, share = self.check(words, text, int(some[row] - begins[text]), size, passage)
                    if kind:
                        yield text, p.items[passage], float(min(near[row, column], 1.0)), share, kind

    def check(self, words: Words, text: int, block: int, size: int, passage: int) -> tuple[str, float]:
        around = size // 2
        low = int(words.at[text]) + max(0, block - around) * STEP
        high = min(int(words.at[text]) + (block + size + around) * STEP, int(words.at[text + 1]))
        seen, wanted = words.hashes[low:high].tolist(), self.passages.words[passage]
        # Below the lower threshold nothing is found, so a bound does there; one word is left for rounding.
        least = min(VERBATIM, self.passages.paraphrase) * len(wanted) - 1
        share = common_subsequence(wanted, seen, self.places[passage], least) / len(wanted)
        if share >= VERBATIM:
            return "verbatim", share
        if share >= self.passages.paraphrase:
            answer = self.passages.answers[passage]
            if common_subsequence(answer, seen) >= ANSWER * len(answer):
                return "paraphrase", share
        return "", share


class Runs:
    """Looks for passages as runs of words; one per task."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.by_seed: dict[int, dict[int, list[int]]] = {}  # by a seed's words and hash, passages
        for k, (hashes, at) in enumerate(zip(block.words, block.seeds, strict=True)):
            n = _seed_words(len(hashes))
            seed = np.array(hashes[at : at + n], dtype=np.uint64)
            found = int(runs(seed, np.array([0, n]), n)[0][0])
            self.by_seed.setdefault(n, {}).setdefault(found, []).append(k)
        self.known = {}
        for n, seeds in self.by_seed.items():
            hashes = np.sort(np.array(list(seeds), dtype=np.uint64))
            slots = np.zeros(1 << 20, dtype=bool)
            slots[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.known[n] = hashes, slots

    def matches(self, words: Words) -> Iterator[tuple[int, object]]:
        """(text, item) wherever a passage stands word for word; once for each passage."""
        for n, (known, slots) in self.known.items():
            hashes, _, first = runs(words.hashes, words.at, n)
            maybe = np.flatnonzero(slots[(hashes >> np.uint64(44)).astype(np.int64)])
            maybe = maybe[np.isin(hashes[maybe], known)]
            if not len(maybe):
                continue
            maybe = maybe[np.argsort(hashes[maybe], kind="stable")]
            seeds, begins = np.unique(hashes[maybe], return_index=True)
            for seed, places in zip(seeds.tolist(), np.split(first[maybe], begins[1:]), strict=True):
                for k in self.by_seed[n][seed]:
                    for text in self._texts(words, places - self.block.seeds[k], self.block.words[k]):
                        yield text, self.block.items[k]

    def _texts(self, words: Words, begin: np.ndarray, wanted: list[int]) -> list[int]:
        begin = begin[begin >= 0]
        text = np.searchsorted(words.at, begin, side="right") - 1
        begin = begin[begin + len(wanted) <= words.at[text + 1]]
        for place, word in enumerate(wanted):
            begin = begin[words.hashes[begin + place] == np.uint64(word)]
        return np.unique(np.searchsorted(words.at, begin, side="right") - 1).tolist()


class BlockSearch:
    """All that is looked for in one pass; one per task."""

    def __init__(self, block: Block) -> None:
        self.searches, self.runs = [Search(x) for x in block.parts], Runs(block)

    def matches(self, words: Words) -> Iterator[tuple[int, object, float, float, str]]:
        whole = set()
        for search in self.searches:
            for match in search.matches(words):
                if match[3] == 1:
                    whole.add(match[:2])
                yield match
        for found in self.runs.matches(words):
            if found not in whole:
                whole.add(found)
                yield *found, 1.0, 1.0, "verbatim"


def _benchmark_blocks(benchmark: DataFrame, item: str, text: str, weights: np.ndarray) -> Iterator[Block]:
    """Passages of ``ITEMS`` items at a time or less; null and empty items have none."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"), answer.alias("answer"))
    rows = rows.where("text is not null").distinct()
    blocks = max(1, -(-rows.count() // ITEMS))
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for block in range(blocks):
        some = rows.where(dealt == block).collect()  # about ITEMS rows
        some = sorted(((r["item"], r["text"], r["answer"]) for r in some), key=str)
        for found in blocks_of(some, weights):
            for passages in found.parts:
                latent_space(benchmark, passages)
            yield found


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """A row for each document and item found in it: the id, ``item_id``, ``cosine``, ``lcs``
    (share of the passage's words found in order) and ``kind`` (verbatim or paraphrase) of the
    closest place. Documents without any have no row.

    Null and empty texts hold nothing. Passages of less than ``PLAIN`` words with few informative
    ones among them may be found as a run of words only. The cosine of a run that was not found by
    its window is the run's own, 1.
    Documents are looked at row by row; rows that share an id are reported together.
    """
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("text is not null")
    weights = word_weights(docs, text)
    id_type = source.schema["id"].dataType.simpleString()
    item_type = benchmark.schema[item].dataType.simpleString()
    out = docs.sparkSession.createDataFrame(
        [], f"id {id_type}, item_id {item_type}, cosine double, lcs double, kind string"
    )
    for block in _benchmark_blocks(benchmark, item, item_text, weights):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # type: ignore[no-untyped-def]
            search = BlockSearch(shared.value)
            for batch in batches:
                for some in slices(batch, "text", 1 << 20):
                    words = words_of(some.column("text"), fold_case=True)
                    found = list(search.matches(words))
                    if found:
                        rows, items, cosines, shares, kinds = zip(*found, strict=True)
                        ids = some.column("id").take(pa.array(rows, pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array(items), pa.array(cosines), pa.array(shares), pa.array(kinds)],
                            names=["id", "item_id", "cosine", "lcs", "kind"],
                        )

        out = out.union(source.mapInArrow(look, out.schema))
    best = F.max(F.struct("lcs", "cosine", "kind")).alias("x")
    return out.groupBy("id", "item_id").agg(best).select(
        F.col("id").alias(id), "item_id", "x.cosine", "x.lcs", "x.kind"
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows in which nothing of the benchmark is found, with the input's columns."""
    weights, out = word_weights(docs, text), docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
    schema = out.schema
    for block in _benchmark_blocks(benchmark, item, item_text, weights):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def sift(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # type: ignore[no-untyped-def]
            search = BlockSearch(shared.value)
            for batch in batches:
                for some in slices(batch, f"in_{text}", 1 << 20):
                    keep = np.ones(some.num_rows, dtype=bool)
                    words = words_of(some.column(f"in_{text}"), fold_case=True)
                    for match in search.matches(words):
                        keep[match[0]] = False
                    yield some.filter(pa.array(keep))

        out = out.mapInArrow(sift, schema)
    return out.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])
