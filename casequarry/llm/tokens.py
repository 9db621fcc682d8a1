"""Words of whole text columns as 64-bit hashes, a few numpy passes per column of a batch.

A word is a run of bytes outside a set of separators. All separators are ASCII and a UTF-8
sequence above ASCII has no ASCII byte, so runs of bytes are runs of characters. ``A-Z`` is
lower-cased, nothing else. Two different words of one job share a hash with a probability of
about ``n * n / 2**64``, the only inexactness of what is built on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes worked on at a time; a longer text is cut at a separator and put together again.
WINDOW = 1 << 20

_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[65:91] += 32

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[65:91] = True
_ALNUM[128:] = True
NOT_ALNUM = ~_ALNUM

_rng = np.random.default_rng(20_240_501)
_OF_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors)
    return _POWERS["up"], _POWERS["down"]


@dataclass(frozen=True)
class Words:
    """Word hashes of the texts of a batch; text ``i`` has ``hashes[offsets[i]:offsets[i + 1]]``."""

    offsets: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i] : self.offsets[i + 1]]

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts())


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes; a null text has no bytes."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def _cuts(data: np.ndarray, starts: np.ndarray, separators: np.ndarray) -> Iterator[tuple]:
    """Windows that begin at the start of a text or at a separator."""
    low = 0
    while low < len(data):
        high = min(low + WINDOW, len(data))
        if high < len(data):
            text = np.searchsorted(starts, high, "right") - 1
            if starts[text] > low:
                high = int(starts[text])
            else:
                while high < len(data):
                    stop = min(high + WINDOW, len(data))
                    if text + 1 < len(starts):
                        stop = min(stop, int(starts[text + 1]))
                    found = np.flatnonzero(separators[data[high:stop]])
                    if len(found) or (text + 1 < len(starts) and stop == starts[text + 1]):
                        high = high + int(found[0]) if len(found) else stop
                        break
                    high = stop
        yield low, high
        low = high


def words(texts: pa.Array, separators: np.ndarray = SPACES) -> Words:
    """Hash every word of every text; null and blank texts have none."""
    at, data = _text_bytes(texts)
    hashes, begins = [], []
    for low, high in _cuts(data, at[:-1], separators):
        piece = _UPPER_TO_LOWER[data[low:high]]
        inside = ~separators[piece]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        new_text = at[np.searchsorted(at, low) : np.searchsorted(at, high)] - low
        first[new_text] = inside[new_text]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends_text = new_text[new_text > 0] - 1
        last[ends_text] = inside[ends_text]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _powers(max(WINDOW, len(piece)))
        running = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_OF_BYTE[piece] * up[: len(piece)], out=running[1:])
        hashes.append(mix((running[end] - running[begin]) * down[begin]))
        begins.append(begin + low)
    if not hashes:
        return Words(np.zeros(len(at), np.int64), np.zeros(0, np.uint64))
    starts = np.concatenate(begins)
    return Words(np.searchsorted(starts, at).astype(np.int64), np.concatenate(hashes))


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``size`` consecutive words from every place, and whether they lie in one text.

    The values at places without ``size`` words left in their text are not meaningful.
    """
    n = len(found.hashes)
    left = np.repeat(found.offsets[1:], found.counts()) - np.arange(n)
    total = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        factor = np.uint64(pow(int(_BASE), 3 * k + 1, 2**64))
        total[: n - k] += found.hashes[k:] * factor
    return mix(total), left >= size


def whole(sequence: np.ndarray) -> np.uint64:
    """Hash of one short sequence of words, different for every length."""
    total = np.full(1, len(sequence) + 1, np.uint64)
    for k in range(len(sequence)):
        total += sequence[k : k + 1] * np.uint64(pow(int(_BASE), 3 * k + 1, 2**64))
    return mix(total)[0]


def distinct(sorted_values: np.ndarray) -> np.ndarray:
    """First places of equal runs in a sorted array."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values with how often each occurs, or the sum of its weights."""
    if weights is None:
        values = np.sort(values)
        begin = distinct(values)
        return values[begin], np.diff(np.concatenate([begin, [len(values)]])).astype(np.int64)
    order = np.argsort(values, kind="stable")
    values = values[order]
    begin = distinct(values)
    sums = np.add.reduceat(weights[order], begin) if len(begin) else weights[:0]
    return values[begin], sums


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20):
    """Parts of a batch with about ``limit`` bytes of text, one row at least."""
    at, _ = _text_bytes(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(at, at[low] + limit, "right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high
