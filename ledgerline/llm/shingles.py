"""Word shingles of whole texts as sets of 64-bit hashes, computed over arrays of bytes.

Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z; in UTF-8 these
bytes never occur inside a character.  A word's hash is a difference of prefix sums of a
polynomial, finished with a strong mixer; a shingle's hash is a sum of its words' hashes, each
multiplied by a constant of its place, mixed again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_PLACE = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    np.uint64,
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _LOWER.astype(np.uint64) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finisher)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(1 << n.bit_length(), 1 << 16)
        up, down = np.full(size, _P), np.full(size, _P_INV)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, last byte + 1) of every word of the joined texts, and word counts' bounds.

    Text i has the words bounds[i] to bounds[i + 1]; byte places count within its own text.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, last = edges[::2], edges[1::2]
    up, down = _power_tables(raw.size + 1)
    sums = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(_VALUE[raw] * up[: raw.size], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * down[first])
    bounds = np.searchsorted(first, np.append(begins, raw.size + 1))
    shift = np.repeat(begins, np.diff(bounds))
    return hashes, first - shift, last - shift, bounds


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """One text's shingles in order: five words each, or the whole of a shorter text."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < WIDTH:
        return mix((hashes * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    out = hashes[: n - WIDTH + 1] * _PLACE[0]
    for j in range(1, WIDTH):
        out = out + hashes[j : n - WIDTH + 1 + j] * _PLACE[j]
    return mix(out + np.uint64(WIDTH))


def groups_of(texts: list[bytes], most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of texts of some 4 MB together; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def word_lists(texts: list[bytes], most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, first bytes, ends) of the words of each text."""
    for a, b in groups_of(texts, most):
        hashes, first, last, bounds = words(texts[a:b])
        for i in range(b - a):
            part = slice(bounds[i], bounds[i + 1])
            yield hashes[part], first[part], last[part]


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    for hashes, _, _ in word_lists(texts):
        yield np.unique(shingle_hashes(hashes))
