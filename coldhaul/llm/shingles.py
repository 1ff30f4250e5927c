"""Hashes of word n-grams, vectorised over a batch of texts with numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEPS = _RNG.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
#: Bytes hashed at once; a longer text is hashed alone.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, as the finaliser of splitmix64 does."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = _powers(_BASE, 1 << 10)
    down = _powers(_INVERSE, 1 << 10)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            cls.up, cls.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        return cls.up, cls.down


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts, in order, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    up, down = _Powers.of(len(data))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * down[starts])
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.concatenate(([0], np.cumsum(lengths + 1)))
    return hashes, np.diff(np.searchsorted(starts, first))


def shingle_hashes(texts: list[bytes], n: int) -> list[np.ndarray]:
    """For each text, the hashes of its word n-grams with repeats.

    A text of fewer than n words, but at least one, has one shingle of all its words; one without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    width = len(words) - n + 1
    if width > 0:
        grams = words[:width] * _STEPS[0]
        for k in range(1, n):
            grams += words[k:k + width] * _STEPS[k]
        grams = mixed(grams)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= n:
            out.append(grams[end - count:end - n + 1])
        elif count:
            short = words[end - count:end]
            out.append(mixed(np.array([(short * _STEPS[:count]).sum(dtype=np.uint64) + np.uint64(count)])))
        else:
            out.append(words[:0])
    return out


def chunks(texts: list[bytes]) -> list[tuple[int, int]]:
    """Ranges of texts of at most ``CHUNK`` bytes together, or of one text."""
    out, begin, size = [], 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            out.append((begin, i))
            begin, size = i, 0
        size += len(text) + 1
    if texts:
        out.append((begin, len(texts)))
    return out
