"""Words, word hashes and shingles of many texts at once, in numpy.

A word is a maximal run of ASCII letters and digits and of characters beyond ASCII, in lower case. A word's hash is a
function of its bytes alone, the same in any process.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit numbers (the splitmix64 finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 19)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, where each text's words begin: len(texts) + 1 positions)."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
    inside = _WORD_BYTE[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
    hashes = mix64((total[ends] - total[starts]) * inverse[starts], 1)
    return hashes, np.searchsorted(starts, begins)


def in_chunks(texts: Sequence[str], chars: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about so many characters together; a longer text is a range of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def shingle_sets(texts: Sequence[str], width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's runs of ``width`` words.

    A text of fewer words has one shingle of all its words; a text without a word has one of the raw text.
    """
    words, at = word_hashes(texts)
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        grams = grams * _BASE + words[k : k + len(grams)]
    grams = mix64(grams, 2)
    sets = []
    for i, text in enumerate(texts):
        a, b = at[i], at[i + 1]
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
            continue
        h = np.zeros(1, np.uint64)
        for w in words[a:b] if b > a else np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint64):
            h = h * _BASE + w + np.uint64(1)
        sets.append(mix64(h, 3 + int(b - a)))
    return sets
