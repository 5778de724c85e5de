"""Word and shingle hashes of whole Arrow string columns, computed on their UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D (the pattern ``[^\\x20\\x09-\\x0D]+``;
no byte of a longer UTF-8 sequence is among those). Sums of powers modulo 2^64 give every word,
and every run of words, a 64-bit hash without a Python step per word.
"""

from __future__ import annotations

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15)  # odd: has an inverse modulo 2^64
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer: close inputs give unrelated outputs."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64; kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _powers[int(base)] = have
    return have[:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte of every word, words per text)."""
    texts = len(offsets) - 1
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    is_word = ~space[data]
    edge = np.ones(len(data) + 1, dtype=bool)  # True where a word cannot continue from the byte before
    edge[1:-1] = ~is_word[:-1]
    edge[offsets] = True
    first = np.nonzero(is_word & edge[:-1])[0]
    if not len(first):
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, np.zeros(texts, np.int64)
    stops = is_word.copy()
    stops[:-1] &= ~is_word[1:] | edge[1:-1]
    end = np.nonzero(stops)[0] + 1
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    length = end - first
    at = np.nonzero(is_word)[0] if len(first) else first
    inside = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    sums = np.add.reduceat(_BYTE[data[at]] * powers(_R, int(length.max()))[inside], np.cumsum(length) - length)
    per_text = np.diff(np.searchsorted(first, offsets))
    return mix(sums + length.astype(np.uint64) * _R), first, end, per_text


class Runs:
    """Hashes of runs of consecutive words, from prefix sums over all words of a batch."""

    def __init__(self, word: np.ndarray):
        self._sum = np.zeros(len(word) + 1, dtype=np.uint64)
        np.cumsum(word * powers(_R, len(word)), out=self._sum[1:])

    def hash(self, start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        """Hash of the ``count`` words from each ``start`` on."""
        run = (self._sum[start + count] - self._sum[start]) * powers(_R_INV, len(self._sum))[start]
        return mix(run + np.uint64(1) + np.asarray(count).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least of each ``width`` neighbouring values."""
    best = np.arange(len(values))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        have += step
    return best
