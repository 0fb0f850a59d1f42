"""Whole texts as bytes inside Arrow tasks: bounded chunks, word spans and fingerprints of any span.

A fingerprint is a polynomial hash modulo 2^64 over random byte codes, taken from running sums, so every span of a
chunk costs a subtraction and two products. Spans are equal with equal bytes; unequal ones collide with odds of about
2^-54.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in chunks of about this many bytes; only a single longer text makes a longer chunk.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers, kept in the worker and doubled when a longer text comes."""
    have = _powers[base]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        if len(have) <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


class Chunk:
    """Some rows of a batch: their bytes laid end to end, `starts` with one more entry than rows."""

    def __init__(self, first: int, data: np.ndarray, starts: np.ndarray):
        self.first, self.data, self.starts = first, data, starts
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts) - 1

    def lower(self) -> None:
        """A-Z to a-z."""
        self.data = np.where((self.data >= 65) & (self.data <= 90), self.data + np.uint8(32), self.data)
        self._sums = None

    def fingerprints(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_CODES[self.data] * powers(_BASE, len(self.data)), out=self._sums[1:])
        raw = (self._sums[end] - self._sums[begin]) * powers(_INVERSE, len(self.data) + 1)[begin]
        return raw + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def words(self, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each word, and the number of words before each row. `in_word`: a flag for each byte."""
        inside = in_word[self.data]
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.starts), np.int64)
        cut = np.zeros(len(inside) + 1, bool)
        cut[self.starts] = True
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1] | cut[1:-1]
        closes[:-1] &= ~inside[1:] | cut[1:-1]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return begin, end, np.searchsorted(begin, self.starts)


def flags(kept: str, among: bool = True) -> np.ndarray:
    """A flag for each byte value: `among` for the ASCII characters given, else the contrary."""
    out = np.full(256, not among)
    out[np.frombuffer(kept.encode("ascii"), np.uint8)] = among
    return out


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[Chunk]:
    """All rows of a string column in order; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        to = min(to, len(texts), row + rows)
        yield Chunk(row, raw[at[row]:at[to]], at[row:to + 1] - at[row])
        row = to


def _weights(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which n words of one text follow each other, and the fingerprint of these words."""
    if len(words) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k, w in enumerate(_weights(n)):
        total += words[k:len(words) - n + 1 + k] * w
    text = rows_of(first)
    places = np.flatnonzero(text[:len(words) - n + 1] == text[n - 1:])
    return places, mix(total[places] + np.uint64(n))


def rows_of(counts_before: np.ndarray) -> np.ndarray:
    """The row of each item, from the number of items before each row."""
    return np.repeat(np.arange(len(counts_before) - 1), np.diff(counts_before))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
