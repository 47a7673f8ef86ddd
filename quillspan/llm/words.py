"""Words of many texts at once, as numpy arrays: where they are and what they hash to.

A batch of texts is cut into chunks of about ``CHUNK`` bytes (at least one whole text each). All positions
inside a chunk are found by array operations over its bytes, so no loop runs over words. Hashes are 64-bit
polynomials followed by a mixing step; the same words give the same hash in every chunk, task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 4 << 20
CHUNK_ROWS = 1 << 16
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def _table(keep, fold: bool) -> np.ndarray:
    """For each byte 0 where it ends a word, else its code plus one, A-Z lower-cased on demand."""
    table = np.zeros(256, np.uint16)
    for b in range(256):
        c = b + 32 if fold and 65 <= b <= 90 else b
        if keep(c):
            table[b] = c + 1
    return table


def _not_space(b: int) -> bool:
    return b != 0x20 and not 0x09 <= b <= 0x0D


#: Words between white space (tab to carriage return, blank), unchanged or with A-Z lower-cased.
SPACED = _table(_not_space, fold=False)
SPACED_FOLDED = _table(_not_space, fold=True)
#: Words of lower-cased letters, digits and all that is not ASCII.
ALNUM_FOLDED = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A, fold=True)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as they have been needed."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span, wherever it lies."""
    up, down = powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of ``n_rows`` texts: byte spans in ``data`` and, for each text, its first word."""

    data: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of n_rows + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        return _spans(self.codes, self.starts, self.ends, _BYTES)

    def grams(self, n: int) -> np.ndarray:
        """The hash of the ``n`` words from each word on; spans that leave their text are not marked here."""
        count = max(0, len(self.starts) - n + 1)
        at = np.arange(count)
        return _spans(self.hashes, at, at + n, _WORDS)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of the words from ``starts`` up to ``ends``."""
        return _spans(self.hashes, starts, ends, _WORDS)

    def inside(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each word on belong to one text."""
        count = max(0, len(self.starts) - n + 1)
        return self.rows[:count] == self.rows[n - 1 : n - 1 + count]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def of_bytes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    codes = table[data]
    inside = codes != 0
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside & (border[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (border[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return Words(data, codes, starts, ends, np.searchsorted(starts, offsets))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; null is the empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(texts: pa.Array, table: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int, Words]]:
    """``(from, to, words)`` for runs of at most CHUNK_ROWS texts and ``most`` bytes; a longer text is a run of its own."""
    data, offsets = buffers(texts)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, at + CHUNK_ROWS)
        yield at, to, of_bytes(data, offsets[at : to + 1], table)
        at = to


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` neighbours (the first of equal ones), by its upper 36 bits."""
    low = np.uint64((1 << 28) - 1)
    keys = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    if span < width:
        keys = np.minimum(keys[: -(width - span)], keys[width - span :])
    return (keys & low).astype(np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64) if h.dtype == np.uint64 else h


def ragged(values: pa.Array, rows: np.ndarray, n_rows: int) -> pa.ListArray:
    """One list for each row out of values whose rows ascend."""
    offsets = np.searchsorted(rows, np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
