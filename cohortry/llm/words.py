"""Words, word hashes and shingles of whole batches of text, as numpy array operations.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text. Hashes are
64-bit polynomials over a fixed random table of byte values, taken from prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        size = 1 << int(n - 1).bit_length()
        for key, b in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    up, down = _powers["up"][:n], _powers["down"][:n]
    if n > 1 << 22:  # keep no tables for a rare giant text
        _powers.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (one entry more than texts)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; A-Z counts as a-z with ``lower``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(data))
    table = _VALUES[_LOWER] if lower else _VALUES
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up, out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` consecutive entries (by doubling), for all starts with room for it."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, at, done = np.zeros(n, np.uint64), words, 0
    span, factor = 1, int(_BASE)
    while True:
        if size & span:
            total = total * np.uint64(factor) + at[done : done + n]
            done += span
        if span * 2 > size:
            return mix(total + np.uint64(size))
        at = at[: len(at) - span] * np.uint64(factor) + at[span:]
        factor = factor * factor % 2**64
        span *= 2
