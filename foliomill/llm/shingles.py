"""Sets of word shingles as 64-bit hashes, computed for a block of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, M3 | np.uint64(1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (a maximal run of bytes that aren't ASCII white space, A-Z lower-cased) and the number of its text."""
    data = np.frombuffer(b"".join([(t or b"") + b"\n" for t in texts]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    letters = LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    sums = np.append(np.uint64(0), np.cumsum(letters * _powers(int(lengths.max(initial=0)) + 1)[place]))
    hashes = mix((sums[first + lengths] - sums[first]) ^ (lengths.astype(np.uint64) * M2))
    limits = np.cumsum([len(t or b"") + 1 for t in texts])
    return hashes, np.searchsorted(limits, starts, side="right")


def shingle_sets(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, ordered by both.

    A text of fewer than width words has its whole sequence as one shingle; one
    without words has none.
    """
    words, of = word_hashes(texts)
    n = len(words) - width + 1
    if n > 0:
        whole = np.flatnonzero(of[:n] == of[width - 1 :])
        sums = np.zeros(len(whole), np.uint64)
        for i in range(width):
            sums = mix(sums * M3 + words[whole + i])
        owner = of[whole]
    else:
        sums, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    counts = np.bincount(of, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i in range(width - 1):
            at = np.minimum(starts[short] + i, len(words) - 1)
            extra = np.where(i < counts[short], mix(extra * M3 + words[at]), extra)
        sums, owner = np.append(sums, mix(extra ^ M1 ^ counts[short].astype(np.uint64))), np.append(owner, short)
    order = np.lexsort((sums, owner))
    sums, owner = sums[order], owner[order]
    new = np.ones(len(sums), bool)
    new[1:] = (sums[1:] != sums[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], sums[new]


def blocks(texts: list[bytes | None] | list[str | None], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most about ``most`` bytes (or characters), to bound memory."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or b"") > most:
            yield start, i
            start, size = i, 0
        size += len(t or b"")
    if start < len(texts):
        yield start, len(texts)
