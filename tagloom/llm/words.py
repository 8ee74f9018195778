"""Words of whole text columns as 64-bit hashes, without a Python object per word.

A word is a longest run of bytes other than space and ``\\t``..``\\r``, or than other bytes
that a caller names as gaps (a space must be among them). Its hash is a
polynomial over its bytes, read off running sums over the text, and then mixed;
two different words share one with a chance of about 2**-62. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20  # so much text is hashed at once, or one word if that is longer

_STEP = 0x9E3779B97F4A7C15 | 5  # odd, and 5 modulo 8
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        m = min(done, n - done)
        out[done : done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
        done += m
    return out


class _Powers:
    """Powers of a number, computed once for each length that is needed."""

    def __init__(self, base: int) -> None:
        self.base, self.known = base, _powers(base, 1)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            self.known = _powers(self.base, max(n, 2 * len(self.known)))
        return self.known[:n]


_up, _down = _Powers(_STEP), _Powers(_STEP_INVERSE)


def _byte_values(fold_case: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if fold_case:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}


def _hash_piece(
    data: np.ndarray, fold_case: bool, gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~gaps[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[fold_case][data] * _up(len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _down(len(data) + 1)[starts]
    return mixed(hashes), starts, ends


def word_hashes(
    data: np.ndarray, fold_case: bool = False, gaps: np.ndarray = _SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in some UTF-8 bytes, and where each begins and ends."""
    found, at = [], 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        if end < len(data):  # back to the last space; on to the next if a word fills the piece
            cuts = np.flatnonzero(gaps[data[at:end]])
            if len(cuts):
                end = at + int(cuts[-1]) + 1
            else:
                while end < len(data) and not gaps[data[end]]:
                    end += 1
        hashes, starts, ends = _hash_piece(data[at:end], fold_case, gaps)
        found.append((hashes, starts + at, ends + at))
        at = end
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


@dataclass
class Words:
    """The words of some texts: those of text i are ``at[i]`` to ``at[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray  # in data
    ends: np.ndarray
    at: np.ndarray
    data: np.ndarray  # the texts' bytes, one space between them

    def __len__(self) -> int:
        return len(self.at) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def owners(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self)), self.counts())


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts with a space after each, and where each text begins."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    spaced = np.insert(raw, offsets[1:], 32)
    return spaced, offsets + np.arange(len(offsets))


def words_of(column: pa.Array, fold_case: bool = False, gaps: np.ndarray = _SPACES) -> Words:
    data, begins = _bytes_of(column)
    hashes, starts, ends = word_hashes(data, fold_case, gaps)
    return Words(hashes, starts, ends, np.searchsorted(starts, begins), data)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts come to about ``most_bytes``, or of one row."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes.astype(np.int64)) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1), batch.num_rows]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if high > low:
            yield batch.slice(low, high - low)


def runs(values: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` values that lie within one text, the text
    of each and the place of its first value in ``values``. Texts begin at ``at``."""
    n = len(values) - length + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _up(len(values)), out=sums[1:])
    hashes = (sums[length:] - sums[:n]) * _down(n)
    owners = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = np.flatnonzero(owners[:n] == owners[length - 1 :])
    return mixed(hashes[first]), owners[first], first
