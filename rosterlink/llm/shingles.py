"""Vectorised 64-bit hashes of words and word n-grams over Arrow text buffers."""

from __future__ import annotations

import numpy as np

_SEP = np.zeros(256, bool)
_SEP[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers that a worker keeps; longer tables live as long as the text that needs them.
_KEPT = 1 << 22
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept up to a bound."""
    have = _powers.get(base)
    if have is None:
        have = np.array([1], np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _powers[base] = have[:_KEPT].copy() if len(have) > _KEPT else have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit mixing generator: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and for each text the index of its first word (one more at the end).

    A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.
    """
    return word_spans(data, offsets, seed)[:2]


def word_spans(data: np.ndarray, offsets: np.ndarray, seed: int = 0, breaks: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes`` and each word's first byte and the byte after its last; ``breaks`` says which bytes are in no word.

    Span hashes come from prefix sums of a polynomial modulo 2**64.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    sep = breaks[data]
    before = np.empty(n, bool)
    before[0], before[1:] = True, sep[:-1]
    firsts = offsets[:-1]
    before[firsts[firsts < n]] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, sep[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = True
    word = ~sep
    start, end = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * _power(_BASE, n), out=prefix[1:])
    h = (prefix[end] - prefix[start]) * _power(_INVERSE, n)[start]
    return mix(h + np.uint64(seed)), np.searchsorted(start, offsets), start, end


def ngram_sets(words: np.ndarray, first: np.ndarray, size: int):
    """Yield for each text the sorted distinct hashes of its word n-grams; fewer words make one n-gram, none no set."""
    h = words.copy()
    for k in range(1, min(size, len(h))):
        rest = h[: len(h) - k]
        h[: len(h) - k] = (rest ^ (rest >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + words[k:]
    h = mix(h)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(h[a : b - size + 1])
        elif b > a:
            x = np.array([b - a], np.uint64)
            for k in range(a, b):
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + words[k : k + 1]
            yield mix(x)
        else:
            yield np.zeros(0, np.uint64)
