"""Hashes of words and word shingles, vectorised over the bytes of a text."""

from __future__ import annotations

import numpy as np

from .common import LOWER_ASCII

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BLOCK = 2 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _block_words(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, dtype=np.uint8)
    word = np.zeros(len(b) + 2, dtype=np.int8)
    word[1:-1] = ~SPACE[b]
    edges = np.diff(word)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(b))
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: what ASCII white space separates, A-Z in lower case."""
    raw = text.translate(LOWER_ASCII)
    if len(raw) <= _BLOCK:
        return _block_words(raw)
    parts, at = [], 0
    while at < len(raw):
        end = at + _BLOCK
        while end < len(raw) and not SPACE[raw[end]]:
            end += 1
        parts.append(_block_words(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words as sorted hashes; fewer words are one shingle."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(size, len(w))
    acc = w[: len(w) - n + 1] + np.uint64(n if n < size else 0)
    for k in range(1, n):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + w[k : len(w) - n + 1 + k]
    return np.unique(mix(acc))
