"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and its code point.
An n-gram of letters is the product of its letters' vectors, each rotated by its place
from the end (binding by permutation); runs of anything but letters count as one gap.
A text is the sum of its n-grams (bundling), a language the sum of its texts; a text
has the language whose prototype is nearest by cosine. Prototypes are centred: what all
languages share is taken away from each, and from the text.

Learning reads all training rows in one pass; each task returns one vector per language
it met, so that what is shuffled depends on tasks and languages, not on rows.

Rows are read one by one: a repeated row counts again for its language and gets its prediction
again. Very long texts are bundled whole. An empty table teaches nothing and has no predictions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.words import slices

N = 3  # letters of an n-gram
SIZE = 1024  # components of a vector
KNOWN_GRAMS = 16_384  # n-gram vectors kept in a task's memory
PIECE_CHARS = 1 << 19  # letters of a text that are counted at once
SEED = 17


def _letter_table() -> np.ndarray:
    """Lower-case code point of each letter, 0 for anything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for low, high in ((0, 0x3400), (0xA000, 0xD800), (0xF900, 0x10000)):
        for cp in range(low, high):
            if chr(cp).isalpha():
                table[cp] = ord(unicodedata.normalize("NFC", chr(cp).lower())[0])
    for low, high in ((0x3400, 0xA000), (0x10000, 0x110000)):  # no case to fold in most of these
        table[low:high] = [cp if chr(cp).isalpha() else 0 for cp in range(low, high)]
    return table


@dataclass
class Encoder:
    """Bundles of texts. Vectors are a function of the seed alone, alike in all tasks."""

    size: int = SIZE
    n: int = N
    letters: dict[int, np.ndarray] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)
    vectors: np.ndarray | None = None

    def letter(self, cp: int) -> np.ndarray:
        found = self.letters.get(cp)
        if found is None:
            bits = np.random.default_rng([SEED, cp]).integers(0, 2, self.size, dtype=np.int8)
            found = self.letters[cp] = (2 * bits - 1).astype(np.int8)
        return found

    def gram(self, code: int) -> np.ndarray:
        out = np.ones(self.size, dtype=np.int8)
        for place in range(self.n):
            out = out * np.roll(self.letter((code >> (21 * place)) & 0x1FFFFF), place)
        return out

    def matrix(self, codes: np.ndarray) -> np.ndarray:
        """A row for each n-gram, from memory where it is known."""
        if self.vectors is None:
            self.vectors = np.zeros((KNOWN_GRAMS, self.size), dtype=np.float32)
        if len(self.rows) + len(codes) > KNOWN_GRAMS:
            self.rows.clear()
        if len(codes) > KNOWN_GRAMS:
            return np.stack([self.gram(int(c)) for c in codes]).astype(np.float32)
        for code in codes.tolist():
            if code not in self.rows:
                self.vectors[len(self.rows)] = self.gram(code)
                self.rows[code] = len(self.rows)
        return self.vectors[[self.rows[c] for c in codes.tolist()]]


_TABLE: list[np.ndarray] = []


def gram_codes(text: str, n: int = N) -> Iterator[np.ndarray]:
    """Codes of the n-grams of a text, piece by piece; n-grams without letters are left out."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    tail = np.zeros(1, dtype=np.uint64)  # a gap before the first letter
    for at in range(0, len(text), PIECE_CHARS):
        points = np.frombuffer(
            text[at : at + PIECE_CHARS].encode("utf-32-le", "surrogatepass"), dtype=np.uint32
        )
        letters = np.concatenate([tail, _TABLE[0][points].astype(np.uint64)])
        if at + PIECE_CHARS >= len(text):
            letters = np.append(letters, np.uint64(0))
        keep = np.ones(len(letters), dtype=bool)
        keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)  # one gap between words
        letters = letters[keep]
        codes = np.zeros(max(0, len(letters) - n + 1), dtype=np.uint64)
        for place in range(n):
            codes = (codes << np.uint64(21)) | letters[place : place + len(codes)]
        yield codes[codes != 0]
        tail = letters[-(n - 1) :] if n > 1 else letters[:0]


def text_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) of some texts."""
    owners, grams, counts = [], [], []
    for i, text in enumerate(texts):
        parts = [np.unique(c, return_counts=True) for c in gram_codes(text or "")]
        if len(parts) > 1:
            codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            weights = np.concatenate([p[1] for p in parts])
            parts = [(codes, np.bincount(back, weights, len(codes)).astype(np.int64))]
        for codes, n in parts:
            owners.append(np.full(len(codes), i))
            grams.append(codes)
            counts.append(n)
    if not grams:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none
    return np.concatenate(owners), np.concatenate(grams), np.concatenate(counts)


def bundles(texts: list[str], encoder: Encoder) -> np.ndarray:
    """A row for each text: the sum of its n-grams' vectors; zero without a letter."""
    out = np.zeros((len(texts), encoder.size), dtype=np.float32)
    for low in range(0, len(texts), 64):
        some = texts[low : low + 64]
        owners, grams, counts = text_counts(some)
        if not len(grams):
            continue
        codes, column = np.unique(grams, return_inverse=True)
        for part in range(0, len(codes), 8192):
            inside = (column >= part) & (column < part + 8192)
            matrix = encoder.matrix(codes[part : part + 8192])
            weights = np.zeros((len(some), len(matrix)), dtype=np.float32)
            weights[owners[inside], column[inside] - part] = counts[inside]
            out[low : low + len(some)] += weights @ matrix
    return out


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit vectors), from all rows of ``docs``.

    Rows with a null language or without a letter teach nothing. One row per language
    comes to the driver.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder(), {}
        for batch in batches:
            for some in slices(batch, "text"):
                langs = some.column("lang").to_pylist()
                rows = bundles(some.column("text").to_pylist(), encoder).astype(np.float64)
                rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
                for name in set(langs):
                    mine = rows[[x == name for x in langs]].sum(axis=0)
                    total[name] = total.get(name, 0) + mine
        if total:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(total), "profile": [v.tolist() for v in total.values()]}
            )

    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null"
    )
    partial = known.mapInArrow(sums, "lang string, profile array<double>")
    added = partial.select("lang", F.posexplode("profile").alias("place", "value"))
    added = added.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = (
        added.groupBy("lang")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]))
        .collect()
    )
    rows = sorted((r for r in rows if np.any(r[1])), key=lambda r: r[0])
    if not rows:
        return [], np.zeros((0, SIZE))
    return [r[0] for r in rows], np.array([r[1] for r in rows])


def centred(profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit prototypes without what they share, and that shared direction."""
    unit = profiles / np.linalg.norm(profiles, axis=1, keepdims=True)
    shared = unit.mean(axis=0) if len(unit) > 1 else np.zeros(unit.shape[1])
    apart = unit - shared
    return apart / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12), shared


def identify(
    docs: DataFrame,
    languages: list[str],
    profiles: np.ndarray,
    id: str = "doc_id",
    text: str = "text",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """The id, ``lang_pred`` and ``score`` of every row.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    The score is 0.5 + half the cosine to the nearest prototype; a tie goes to the smaller
    name. ``keep`` adds columns computed from the row. Other columns are not carried, and
    the input's names don't matter beyond those given.
    """
    keep = keep or {}
    prototypes, shared = centred(profiles) if len(languages) else (profiles, np.zeros(SIZE))
    names = np.array(languages, dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            for some in slices(batch, "_text"):
                rows = bundles(some.column("_text").to_pylist(), encoder).astype(np.float64)
                length = np.linalg.norm(rows, axis=1)
                lang = np.full(len(rows), "und", dtype=object)
                score = np.zeros(len(rows))
                known = (length > 0) & (len(names) > 0)
                if known.any():
                    unit = rows[known] / length[known, None] - shared
                    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
                    near = unit @ prototypes.T
                    best = near.argmax(axis=1)
                    lang[known] = names[best]
                    score[known] = np.clip(0.5 + 0.5 * near[np.arange(len(best)), best], 0, 1)
                out = [some.column(i) for i in range(some.num_columns) if some.schema.names[i] != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(lang, pa.string()), pa.array(score)],
                    names=[*[c for c in some.schema.names if c != "_text"], "lang_pred", "score"],
                )

    source = docs.select(
        F.col(id), *[c.alias(k) for k, c in keep.items()], F.col(text).alias("_text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(predict, ", ".join([*fields, "lang_pred string", "score double"]))
