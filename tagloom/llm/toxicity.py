"""Toxicity by a small convolutional network over hashed words, trained in numpy.

A word is the embeddings of five hashes side by side: the whole word and its first 4, 5, 6
and 8 bytes, without closing punctuation and case of A-Z, so that inflected forms share
something. Filters over one, two and three words, their maxima over the whole text and a
logistic layer give the score. Only hashes that several training texts share are embedded;
others are zero, which keeps the network from learning texts by heart.

It is fitted on all labelled rows and their whole texts. The rows are dealt over as many tasks as
they fill, ``SHARE`` rows each, and read in ``ROUNDS`` parts by a hash of their ids. In a round every
task goes on from the same network with its rows of that part, by Adam on batches drawn half from
each label, and sends what it has changed; the changes of a parameter are averaged over the tasks that
have any. What comes to the driver is one network a round, whatever the number of rows. Few rows
are gone over until there were ``STEPS`` steps. Language enters only the thresholds, calibrated
for each on the last fifth of the parts before the network learns from them too.

Rows are scored one by one, so repeated rows get equal scores; an id that is repeated among the
texts or labels is learned from once for each pair. Very long texts are read in pieces, of which
the maxima count. An empty table has no scores. Columns are taken by name and others are not
carried, so that their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.llm.words import Words, mixed, slices, words_of

SHARE = 12_800  # labelled rows of a task that trains
ROUNDS, LEARNED = 10, 8  # parts of the rows, and those learned before the thresholds are set
CHUNK_ROWS, CHUNK_WORDS = 4096, 1 << 22  # that a task holds at once
BINS = 10_000  # of scores, for the thresholds
PREFIXES = (4, 5, 6, 8)
TABLE_BITS = 16
EMBEDDED = 6  # numbers of one hash
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
STEPS, BATCH, RATE, SEED = 400, 64, 0.01, 5
PIECE_WORDS = 1 << 17  # words that are scored at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[[ord(c) for c in ",.;:!?"]] = True


def word_features(words: Words) -> np.ndarray:
    """A row of bucket numbers for each word: the whole word, then its prefixes."""
    ends = words.ends.copy()
    for _ in range(3):
        shut = (ends - words.starts > 1) & _CLOSING[words.data[ends - 1]]
        ends -= shut
    out = np.empty((len(ends), 1 + len(PREFIXES)), dtype=np.int32)
    packed = np.zeros(len(ends), dtype=np.uint64)
    shift = np.uint64(64 - TABLE_BITS)
    out[:, 0] = words.hashes >> shift
    last = len(words.data) - 1
    for place in range(max(PREFIXES)):
        at = words.starts + place
        byte = np.where(at < ends, _LOWER[words.data[np.minimum(at, last)]], 0)
        packed |= byte.astype(np.uint64) << np.uint64(8 * place)
        if place + 1 in PREFIXES:
            column = 1 + PREFIXES.index(place + 1)
            out[:, column] = mixed(packed + np.uint64(column)) >> shift
    return out


@dataclass
class Network:
    tables: np.ndarray  # hash kinds x buckets x EMBEDDED
    filters: list[np.ndarray]  # for each width: width x inputs x FILTERS
    shifts: np.ndarray
    weights: np.ndarray
    bias: float

    def embed(self, features: np.ndarray) -> np.ndarray:
        kinds = [self.tables[k][features[:, k]] for k in range(features.shape[1])]
        return np.concatenate(kinds, axis=1)

    def responses(self, inputs: np.ndarray) -> np.ndarray:
        """Each filter's response at each word, where words beyond the end count as zero."""
        out = np.zeros((len(inputs), len(WIDTHS) * FILTERS), dtype=np.float32)
        for i, width in enumerate(WIDTHS):
            mine = out[:, i * FILTERS : (i + 1) * FILTERS]
            for place in range(min(width, len(inputs))):
                mine[: len(inputs) - place] += inputs[place:] @ self.filters[i][place]
        return out

    def pooled(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima over one text, in pieces that overlap, and where they are."""
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, dtype=np.float32)
        where = np.zeros(len(best), dtype=np.int64)
        for low in range(0, len(features), PIECE_WORDS):
            piece = features[low : low + PIECE_WORDS + max(WIDTHS) - 1]
            found = self.responses(self.embed(piece))[:PIECE_WORDS]
            at = found.argmax(axis=0)
            value = found[at, np.arange(len(best))]
            where = np.where(value > best, at + low, where)
            best = np.maximum(best, value)
        return (best, where) if len(features) else (np.zeros_like(best), where)

    def scores(self, words: Words) -> np.ndarray:
        features = word_features(words)
        pooled = np.zeros((len(words), len(self.weights)), dtype=np.float32)
        counts = words.counts()
        some = np.flatnonzero(counts)
        if counts.sum() <= PIECE_WORDS and len(some):
            # All texts at once: a text's end is padded so that no filter reaches the next one.
            pad = max(WIDTHS) - 1
            places = np.arange(len(features)) + pad * np.repeat(np.arange(len(words)), counts)
            size = (len(features) + pad * len(words), len(self.tables) * EMBEDDED)
            inputs = np.zeros(size, dtype=np.float32)
            inputs[places] = self.embed(features)
            found = self.responses(inputs)[places]
            pooled[some] = np.maximum.reduceat(found, words.at[:-1][some], axis=0)
        else:
            for i in some:
                pooled[i] = self.pooled(features[words.at[i] : words.at[i + 1]])[0]
        raw = np.maximum(pooled + self.shifts, 0) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))


def _features_of(texts: list[str]) -> list[np.ndarray]:
    rows = []
    for low in range(0, len(texts), 256):
        words = words_of(pa.array(texts[low : low + 256], pa.string()), fold_case=True)
        features = word_features(words)
        rows += [features[words.at[i] : words.at[i + 1]] for i in range(len(words))]
    return rows


class _Adam:
    """Steps for some rows of an array; rows that a batch doesn't touch stay as they are."""

    def __init__(self, value: np.ndarray) -> None:
        self.value, self.first, self.second = value, np.zeros_like(value), np.zeros_like(value)

    def step(self, n: int, slope: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        first = self.first[rows] + 0.1 * (slope - self.first[rows])
        second = self.second[rows] + 0.01 * (slope * slope - self.second[rows])
        self.first[rows], self.second[rows] = first, second
        ahead = first / (1 - 0.9**n)
        self.value[rows] -= RATE * ahead / (np.sqrt(second / (1 - 0.99**n)) + 1e-8)


def _new_network(known: np.ndarray) -> Network:
    rng = np.random.default_rng(SEED)
    kinds, buckets = known.shape
    tables = rng.normal(0, 0.1, (kinds, buckets, EMBEDDED)).astype(np.float32) * known[..., None]
    n = len(WIDTHS) * FILTERS
    return Network(
        tables,
        [rng.normal(0, 0.3, (w, kinds * EMBEDDED, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(n, dtype=np.float32),
        np.abs(rng.normal(0, 0.3, n)).astype(np.float32),
        0.0,
    )


class _Trainer:
    """Adam on batches drawn half from each label; ``net`` is changed in place."""

    def __init__(self, net: Network, known: np.ndarray, seed: int = SEED) -> None:
        self.net, self.known, self.rng, self.n = net, known, np.random.default_rng(seed), 0
        self.bias = np.full(1, net.bias, dtype=np.float32)
        self.table_steps = [_Adam(t) for t in net.tables]
        self.other_steps = [_Adam(v) for v in (*net.filters, net.shifts, net.weights, self.bias)]

    def learn(self, rows: list[np.ndarray], labels: np.ndarray, steps: int = 0) -> None:
        """At least so many steps, and each row at least once."""
        groups = [g for k in (0, 1) if len(g := np.flatnonzero(labels == k))]
        size = BATCH // len(groups)
        steps = max(steps, -(-max(map(len, groups)) // size))
        # Each label's rows in turn, in another order each time they have all been taken.
        turns = [-(-steps * size // len(g)) for g in groups]
        order = [np.concatenate([self.rng.permutation(g) for _ in range(t)]) for g, t in zip(groups, turns, strict=True)]
        for step in range(steps):
            self._step(rows, labels, np.concatenate([o[step * size : (step + 1) * size] for o in order]))
        self.net.bias = float(self.bias[0])

    def _step(self, rows: list[np.ndarray], labels: np.ndarray, batch: np.ndarray) -> None:
        net, rng, bias, known = self.net, self.rng, self.bias, self.known
        self.n += 1
        n = len(net.weights)
        # Some words are hidden, so that no single one is relied on.
        texts_ = [rows[r][rng.random(len(rows[r])) > 0.2] for r in batch]
        pooled, where = np.zeros((len(batch), n), np.float32), np.zeros((len(batch), n), np.int64)
        for i, features in enumerate(texts_):
            pooled[i], where[i] = net.pooled(features)
        active = np.maximum(pooled + net.shifts, 0)
        raw = active @ net.weights + bias[0]
        slope = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)).astype(np.float32)
        back = slope[:, None] * net.weights * (pooled + net.shifts > 0)
        slopes = [np.zeros_like(f) for f in net.filters]
        seen, toward = [], []
        for i, features in enumerate(texts_):
            for j, width in enumerate(WIDTHS):
                mine = slice(j * FILTERS, (j + 1) * FILTERS)
                for place in range(width):
                    at = where[i, mine] + place
                    inside = np.flatnonzero((at < len(features)) & (back[i, mine] != 0))
                    if len(inside):
                        pull = back[i, mine][inside]
                        seen.append(features[at[inside]])
                        toward.append(net.filters[j][place].T[inside] * pull[:, None])
                        slopes[j][place][:, inside] += (net.embed(seen[-1]) * pull[:, None]).T
        gradients = [*slopes, back.sum(axis=0), slope @ active, slope.sum(keepdims=True)]
        for adam, gradient in zip(self.other_steps, gradients, strict=True):
            adam.step(self.n, gradient)
        if seen:
            all_seen, all_toward = np.concatenate(seen), np.concatenate(toward)
            for kind in range(len(known)):
                inside = known[kind][all_seen[:, kind]]
                found, back_to = np.unique(all_seen[inside, kind], return_inverse=True)
                part = np.zeros((len(found), EMBEDDED), dtype=np.float32)
                np.add.at(part, back_to, all_toward[inside, kind * EMBEDDED : (kind + 1) * EMBEDDED])
                self.table_steps[kind].step(self.n, part, found)
        net.weights *= 1 - 1e-3


def _known(counts: np.ndarray, texts: int) -> np.ndarray:
    """The hashes that several texts share."""
    return counts >= (3 if texts >= 200 else 2)


def _text_counts(rows: list[np.ndarray]) -> np.ndarray:
    """In how many texts each hash is."""
    counts = np.zeros((1 + len(PREFIXES), 1 << TABLE_BITS), dtype=np.int64)
    for features in rows:
        for kind in range(len(counts)):
            counts[kind, np.unique(features[:, kind])] += 1
    return counts


def fit(texts: list[str], labels: np.ndarray) -> Network:
    """A network that one task learns from texts it holds."""
    rows = _features_of(texts)
    known = _known(_text_counts(rows), len(rows))
    net = _new_network(known)
    _Trainer(net, known).learn(rows, labels, STEPS)
    return net


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score from which calling a text toxic gives the best F1; the middle of the gap."""
    if not len(scores) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + labels.sum())
    i = int(f1.argmax())
    return float((s[i] + (s[i + 1] if i + 1 < len(s) else 0)) / 2)


def best_of_bins(found: list[tuple[int, int, int]]) -> float:
    """``best_threshold`` of scores that are counted: bin, rows and rows with label 1."""
    sums: dict[int, list[int]] = {}
    for at, n, toxic in found:
        both = sums.setdefault(at, [0, 0])
        both[0], both[1] = both[0] + n, both[1] + toxic
    order = sorted(sums, reverse=True)
    rows, hits = (np.cumsum([sums[b][k] for b in order]) for k in (0, 1))
    if not order or hits[-1] in (0, rows[-1]):
        return 0.5
    i = int((2 * hits / (rows + hits[-1])).argmax())
    below = (order[i + 1] + 0.5) / BINS if i + 1 < len(order) else 0
    return float(((order[i] + 0.5) / BINS + below) / 2)


def _flat(net: Network) -> np.ndarray:
    """All parameters in rows of ``EMBEDDED`` numbers: the tables' hashes, then the others, padded."""
    others = np.concatenate([*[f.ravel() for f in net.filters], net.shifts, net.weights, [net.bias]])
    others = np.pad(others.astype(np.float32), (0, -len(others) % EMBEDDED))
    return np.concatenate([net.tables.reshape(-1, EMBEDDED), others.reshape(-1, EMBEDDED)])


def _network(flat: np.ndarray, like: Network) -> Network:
    tables = flat[: like.tables[..., 0].size].reshape(like.tables.shape).astype(np.float32)
    rest, at, parts = flat[like.tables[..., 0].size :].ravel().astype(np.float32), 0, []
    for value in (*like.filters, like.shifts, like.weights):
        parts.append(rest[at : at + value.size].reshape(value.shape))
        at += value.size
    return Network(tables, parts[:-2], parts[-2], parts[-1], float(rest[at]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Features and labels of a task's rows, a bounded number at once."""
    rows: list[np.ndarray] = []
    labels: list[int] = []
    words = 0
    for batch in batches:
        for some in slices(batch, "text"):
            rows += _features_of(some.column("text").to_pylist())
            labels += some.column("label").to_pylist()
            words += sum(map(len, rows[len(rows) - some.num_rows :]))
            if len(rows) >= CHUNK_ROWS or words >= CHUNK_WORDS:
                yield rows, np.array(labels, dtype=np.int64)
                rows, labels, words = [], [], 0
    if rows:
        yield rows, np.array(labels, dtype=np.int64)


def _shared_hashes(rows: DataFrame, texts: int) -> np.ndarray:
    """Counted over all rows; the driver gets one number for each hash at the most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for some in slices(batch, "text"):
                total = total + _text_counts(_features_of(some.column("text").to_pylist())).ravel()
        seen = np.flatnonzero(total) if isinstance(total, np.ndarray) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_pydict({"code": pa.array(seen, pa.int64()), "n": pa.array(total[seen] if len(seen) else seen, pa.int64())})

    sums = rows.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 + len(PREFIXES)) << TABLE_BITS, dtype=np.int64)
    counts[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return _known(counts, texts).reshape(1 + len(PREFIXES), 1 << TABLE_BITS)


def _round(rows: DataFrame, net: Network, known: np.ndarray, steps: int, seed: int) -> Network:
    """The network after all tasks have learned from ``rows`` side by side."""
    shared = rows.sparkSession.sparkContext.broadcast((net, known))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, before, count = None, None, 0
        for features, labels in _chunks(batches):
            if trainer is None:
                start, allowed = shared.value
                before = _flat(start)
                trainer = _Trainer(_network(before.copy(), start), allowed, seed)
            trainer.learn(features, labels, steps if count == 0 else 0)
            count += len(labels)
        if trainer is not None:
            change = _flat(trainer.net) - before
            code = np.flatnonzero(change.any(axis=1))
            columns = {f"d{i}": pa.array(change[code, i]) for i in range(EMBEDDED)}
            weight = pa.array(np.full(len(code), float(count)))
            yield pa.RecordBatch.from_pydict({"code": pa.array(code, pa.int64()), "weight": weight, **columns})

    fields = [f"d{i}" for i in range(EMBEDDED)]
    changes = rows.select("text", "label").mapInArrow(learn, f"code long, weight double, {', '.join(f'{c} float' for c in fields)}")
    means = [(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c) for c in fields]
    found = changes.groupBy("code").agg(*means).toArrow()
    shared.unpersist()
    flat = _flat(net).astype(np.float64)
    if found.num_rows:
        flat[found.column("code").to_numpy()] += np.stack([found.column(c).to_numpy() for c in fields], axis=1)
    return _network(flat, net)


def _thresholds(rows: DataFrame, net: Network) -> dict[str | None, float]:
    """From the scores of all ``rows``, counted in ``BINS`` by language and label."""
    found = scored(rows, net, {}, "label", "text", "lang", keep={"_name": F.col("lang")})
    bins = F.floor(F.col("score") * BINS).alias("bin")
    counts = found.groupBy("_name", bins).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
    table: dict[str | None, list[tuple[int, int, int]]] = {}
    for r in counts.collect():  # bounded by the languages and BINS
        table.setdefault(r["_name"], []).append((r["bin"], r["n"], r["toxic"]))
    limits = {None: best_of_bins([x for found in table.values() for x in found])}
    for name, found in table.items():
        if name is not None:
            limits[name] = best_of_bins(found) if sum(n for _, n, _ in found) >= 20 else limits[None]
    return limits


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    lang: str = "lang", label: str = "toxic",
) -> tuple[Network | None, dict[str | None, float]]:
    """The network and a threshold for each language, from all labelled rows (see above).

    Rows with a null id, text or label teach nothing. Without both labels there is no network.
    """
    scratch = Scratch(docs.sparkSession)
    marked = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null")
    counts = dict(map(tuple, texts.select("id").join(marked.hint("merge"), "id").groupBy("label").count().collect()))
    n = sum(counts.values())
    if len(counts) < 2:
        scratch.close()
        return None, {}
    tasks = -(-n // SHARE)
    order = F.xxhash64(F.lit(SEED), F.col("id"))
    # Labels grow with the documents: both sides are shuffled at any size.
    pairs = texts.join(marked.hint("merge"), "id").withColumn("_order", order)
    pairs = pairs.withColumn("part", F.pmod("_order", F.lit(ROUNDS)).cast("int")).repartition(tasks, "_order")
    rows = scratch.keep(pairs.sortWithinPartitions("part", "_order", "id", "label", F.xxhash64("text")).drop("_order", "id"))
    known = _shared_hashes(rows, n)
    net = _new_network(known)
    learned, held = rows.where(F.col("part") < LEARNED), rows.where(F.col("part") >= LEARNED)
    if tasks == 1:
        net = _round(learned, net, known, STEPS, SEED)
        thresholds = _thresholds(held, net)
        net = _round(rows, net, known, STEPS // 2, SEED + 1)
    else:
        for part in range(LEARNED):
            net = _round(rows.where(F.col("part") == part), net, known, STEPS // ROUNDS, SEED + part)
        thresholds = _thresholds(held, net)
        for part in range(LEARNED, ROUNDS):
            net = _round(rows.where(F.col("part") == part), net, known, STEPS // ROUNDS, SEED + part)
    scratch.close()
    return net, thresholds


def scored(
    docs: DataFrame, network: Network | None, thresholds: dict[str | None, float],
    id: str = "doc_id", text: str = "text", lang: str = "lang", keep: dict[str, Column] | None = None,
) -> DataFrame:
    """The id, ``score``, ``predicted`` (1 from 0.3), ``threshold`` and ``flagged`` (from the
    language's threshold) of every row. Null and empty texts are scored as texts without a
    word; without a network all scores are 0. ``keep`` adds columns computed from the row.
    """
    keep = keep or {}
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few MB, by its parameters

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "_text", 1 << 19):
                net = shared.value
                if net is None:
                    found = np.zeros(some.num_rows)
                else:
                    found = net.scores(words_of(some.column("_text"), fold_case=True))
                out = [some.column(c) for c in some.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(found)], names=[*[c for c in some.schema.names if c != "_text"], "score"]
                )

    source = docs.select(
        F.col(id), *[c.alias(k) for k, c in keep.items()], F.col(lang).alias("_lang"), F.col(text).alias("_text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    rows = source.mapInArrow(score, ", ".join([*fields, "score double"]))
    limit = F.lit(thresholds.get(None, 0.5))
    for name, value in thresholds.items():
        if name is not None:
            limit = F.when(F.col("_lang") == name, value).otherwise(limit)
    rows = rows.withColumn("threshold", limit)
    return rows.select(
        *[c for c in rows.columns if c not in ("_lang", "threshold")],
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )
