"""Token counts of whole texts under a public byte-level BPE vocabulary.

A text is split into pre-tokens as the vocabulary's library splits it. The distinct pre-tokens
of a batch are held together as one ragged array of symbols. A round merges, in each pre-token
at once, every occurrence of its lowest-ranked pair, from the left; rounds go on until no pair
has a rank, and the symbols that are left are the tokens. Merging all occurrences at once is the
library's order exactly, because in these vocabularies no pair's parts are made by a later merge
and no symbol by two merges; other files are refused. A pre-token of many symbols is merged rank
by rank over linked positions, so that it costs no more per symbol than a short one.

Null and empty texts have no tokens. The vocabulary's special strings inside a text are one token
each, as the library counts by default. Repeated rows are counted one by one; an empty table gives
an empty one. A text of any length is split piece by piece at places where a pre-token surely
begins, so that its list of pre-tokens never stands in memory whole. Only the id and the text are read,
so that other columns' names don't matter.

The vocabulary (some 50,000 pairs, under 2 MB) goes to the tasks with the function. Counts of short
pre-tokens are remembered, up to ``KNOWN`` of them in a task.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tagloom.llm.words import slices

PIECE_CHARS = 1 << 18  # of a text are split at once
KNOWN = 1 << 18  # pre-tokens whose counts a task remembers
SHORT = 64  # symbols; longer pre-tokens are merged one by one and not remembered

_NO_RANK = np.iinfo(np.int32).max

# The byte-level pre-tokens, by what counts as letter, number and other character.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in such vocabularies: itself where it can be
    printed, else the next of those from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Merges as arrays: pairs of symbols in the order of their keys, with rank and product."""

    byte_symbols: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray  # by rank
    symbols: int
    specials: list[str]
    newer: str  # letters and numbers that the splitting library knows and the vocabulary's doesn't
    patterns: dict[bool, regex.Pattern] = field(default_factory=dict, repr=False)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NO_RANK).astype(np.int32)


def _unshared_letters(path: str) -> str:
    """Characters that ``regex`` takes for letters or numbers and the vocabulary's library doesn't.
    Only such as this Python doesn't know can differ, for both know at least as many."""
    from tokenizers import Tokenizer

    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    unsure = [c for c in regex.findall(r"[\p{L}\p{N}]", everything) if unicodedata.category(c) == "Cn"]
    if not unsure:
        return ""
    # Between a letter, a number and a full stop a character joins the one that is of its kind.
    probe = "".join(f"a{c}1{c}.\n" for c in unsure)
    starts = {at for _, (at, _) in Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str(probe)}
    return "".join(c for i, c in enumerate(unsure) if 6 * i + 4 not in starts)


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a ``tokenizers`` file. Only plain byte-level BPE is understood."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model, split, added = parts["model"], parts["pre_tokenizer"] or {}, parts["added_tokens"]
    known = (
        model["type"] == "BPE"
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not parts["normalizer"]
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word"))
    )
    if not known:
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = {left + right: rank for rank, (left, right) in enumerate(pairs)}
    late = any(made.get(part, -1) >= rank for rank, pair in enumerate(pairs) for part in pair)
    if late or len(made) < len(pairs):
        raise ValueError(f"{path}: merges of this vocabulary can't be applied side by side")
    symbols = max(vocab.values()) + 1
    bytes_at = np.zeros(256, dtype=np.int32)
    for letter, byte in _byte_letters().items():
        bytes_at[byte] = vocab[letter]
    keys = np.array([vocab[left] * symbols + vocab[right] for left, right in pairs], dtype=np.int64)
    order = np.argsort(keys)
    return Vocabulary(
        byte_symbols=bytes_at,
        keys=keys[order],
        ranks=order.astype(np.int32),
        products=np.array([vocab[left + right] for left, right in pairs], dtype=np.int32),
        symbols=symbols,
        specials=[t["content"] for t in added],
        newer=_unshared_letters(path),
    )


def _not_overlapping(chosen: np.ndarray) -> np.ndarray:
    """Of places that follow one another directly, every other one from the left."""
    places = np.flatnonzero(chosen)
    first = np.ones(len(places), dtype=bool)
    first[1:] = np.diff(places) > 1
    run_start = places[np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))]
    return places[(places - run_start) % 2 == 0]


def merged_counts(vocabulary: Vocabulary, pieces: list[bytes]) -> np.ndarray:
    """How many symbols of each pre-token survive all merges."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    counts = lengths.copy()
    symbols = vocabulary.byte_symbols[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    ranks = np.full(len(symbols), _NO_RANK, dtype=np.int32)
    inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else owner
    ranks[inside] = vocabulary.rank_of(symbols[inside], symbols[inside + 1])
    while len(symbols):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(starts, append=len(owner))
        lowest = np.minimum.reduceat(ranks, starts)
        counts[owner[starts]] = sizes
        lowest = np.repeat(lowest, sizes)
        going = lowest < _NO_RANK
        if not going.all():  # finished pre-tokens leave the array
            symbols, owner, ranks, lowest = symbols[going], owner[going], ranks[going], lowest[going]
            if not len(symbols):
                break
        # The last symbol of a pre-token has no rank, so that no run crosses to the next one.
        left = _not_overlapping(ranks == lowest)
        symbols[left] = vocabulary.products[ranks[left]]
        stays = np.ones(len(symbols), dtype=bool)
        stays[left + 1] = False
        now = np.cumsum(stays) - 1
        symbols, owner, ranks = symbols[stays], owner[stays], ranks[stays]
        ranks[now[left]] = _NO_RANK
        touched = np.union1d(now[left], np.maximum(now[left] - 1, 0))
        touched = touched[touched < len(symbols) - 1]
        touched = touched[owner[touched] == owner[touched + 1]]
        ranks[touched] = vocabulary.rank_of(symbols[touched], symbols[touched + 1])
    return counts


def merged_count_of_long(vocabulary: Vocabulary, piece: bytes) -> int:
    """The same for one long pre-token: its ranks in rising order, each at all its places."""
    symbols = vocabulary.byte_symbols[np.frombuffer(piece, dtype=np.uint8)]
    n = count = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ranks = np.full(n, _NO_RANK, dtype=np.int32)
    waiting: dict[int, list[np.ndarray]] = {}
    ahead: list[int] = []

    def look_up(places: np.ndarray) -> None:
        ranks[places] = _NO_RANK
        places = places[after[places] < n]
        ranks[places] = vocabulary.rank_of(symbols[places], symbols[after[places]])
        places = places[ranks[places] < _NO_RANK]
        order = places[np.argsort(ranks[places], kind="stable")]
        for group in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1) if len(order) else []:
            rank = int(ranks[group[0]])
            if rank not in waiting:
                heapq.heappush(ahead, rank)
            waiting.setdefault(rank, []).append(group)

    look_up(np.arange(n))
    while ahead:
        rank = heapq.heappop(ahead)
        places = np.unique(np.concatenate(waiting.pop(rank)))
        places = places[ranks[places] == rank]
        joined = np.zeros(len(places), dtype=bool)  # shares its first symbol with the place before
        joined[1:] = after[places[:-1]] == places[1:]
        begin = np.maximum.accumulate(np.where(joined, 0, np.arange(len(places))))
        places = places[(np.arange(len(places)) - begin) % 2 == 0]
        gone = after[places]
        ranks[gone] = _NO_RANK
        symbols[places] = vocabulary.products[rank]
        after[places] = after[gone]
        before[after[places][after[places] < n]] = places[after[places] < n]
        count -= len(places)
        earlier = before[places]
        look_up(np.union1d(places, earlier[earlier >= 0]))
    return count


def _ranges(characters: str) -> str:
    """Characters as the inside of a class, runs of them as ranges."""
    codes = np.array([ord(c) for c in characters], dtype=np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


class Counter:
    """Counts tokens of texts; remembers short pre-tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.known = vocabulary, {}
        newer = _ranges(vocabulary.newer)
        self.newer = regex.compile(f"[{newer}]") if newer else None
        letter, number, other = r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"
        self.plain = regex.compile(_PRE_TOKENS.format(letter=letter, number=number, other=other))
        if newer:
            letter, number = (f"(?:(?![{newer}]){kind})" for kind in (letter, number))
            other = f"(?:{other}|[{newer}])"
            self.exact = regex.compile(_PRE_TOKENS.format(letter=letter, number=number, other=other))
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def tokens(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        counts = np.zeros(len(texts), dtype=np.int64)
        held: list[tuple[int, list[str]]] = []
        chars = 0
        for i, text in enumerate(texts):
            parts = [text or ""]
            if text and self.special and self.special.search(text):
                parts = self.special.split(text)
                counts[i] = len(parts) - 1
            for piece in (p for part in parts for p in _bounded(part)):
                exact = self.newer is not None and not piece.isascii() and self.newer.search(piece)
                held.append((i, (self.exact if exact else self.plain).findall(piece)))
                chars += len(piece)
                if chars >= PIECE_CHARS:
                    self._add(held, counts)
                    held, chars = [], 0
        self._add(held, counts)
        return counts

    def _add(self, held: list[tuple[int, list[str]]], counts: np.ndarray) -> None:
        everything = set().union(*(pieces for _, pieces in held))
        missing = everything.difference(self.known)
        if len(self.known) + len(missing) > KNOWN:
            self.known.clear()
            missing = everything
        data = {p: p.encode() for p in missing}
        short = [p for p, d in data.items() if len(d) <= SHORT]
        found = merged_counts(self.vocabulary, [data[p] for p in short])
        self.known.update(zip(short, found.tolist(), strict=True))
        long = {p: merged_count_of_long(self.vocabulary, d) for p, d in data.items() if len(d) > SHORT}
        self.known.update(long)
        for i, pieces in held:
            counts[i] += sum(map(self.known.__getitem__, pieces))
        for piece in long:
            del self.known[piece]


def _bounded(text: str) -> Iterator[str]:
    """The text in parts of some ``PIECE_CHARS``, cut where a pre-token surely begins."""
    at = 0
    while len(text) - at > PIECE_CHARS and (cut := _CUT.search(text, at + PIECE_CHARS)):
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:] if at else text


def token_counts(docs: DataFrame, vocabulary: Vocabulary, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text")
                tokens = counter.tokens(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pc.binary_length(texts).fill_null(0).cast(pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(tokens > limit, pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(count, schema)
