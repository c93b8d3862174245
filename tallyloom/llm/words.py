"""Word and shingle hashes of many texts at once, for use inside Arrow tasks.

Words are maximal runs of anything but ASCII white space, with A-Z lower-cased. A word's hash is a polynomial in its
bytes modulo 2**64, read off running sums, so the cost per byte is a handful of array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NOT_WORD = np.ones(256, bool)  # for words without ASCII punctuation
_NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=U64)
_BYTE[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse. Those for a chunk are kept; a longer table, for a single longer word, is not."""
    if _powers and n <= len(_powers[0]):
        return _powers[0], _powers[1]
    tables = []
    for base in (_BASE, _INVERSE):
        table = np.full(max(n, CHUNK_BYTES + 1), base, U64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=U64))
    if n <= CHUNK_BYTES + 1:
        _powers[:] = tables
    return tables[0], tables[1]


def _word_hashes(joined: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the words at ``first`` to ``last``, over slices of at most ``CHUNK_BYTES`` (or one longer word)."""
    out, i = np.empty(len(first), U64), 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + CHUNK_BYTES, side="right")))
        piece, lo, hi = joined[first[i] : last[j - 1]], first[i:j] - first[i], last[i:j] - first[i]
        up, down = _power_tables(len(piece))
        sums = np.cumsum(_BYTE[piece] * up[: len(piece)], dtype=U64)
        before = np.where(lo > 0, sums[lo - 1], U64(0))
        out[i:j] = mix((sums[hi - 1] - before) * down[lo] + (hi - lo).astype(U64))
        i = j
    return out


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` bytes; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def words(texts: list[bytes], punctuation: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the bounds of each text's words (one more than texts), and the words' first and past-the-last byte
    in the joined buffer (each text followed by one space). Without ``punctuation``, ASCII signs separate words."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    space = (_SPACE if punctuation else _NOT_WORD)[joined]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    first, last = edges[0::2], edges[1::2]
    hashes = _word_hashes(joined, first, last)
    bounds = np.searchsorted(first, np.concatenate(([0], np.cumsum(lengths))))
    return hashes, bounds, first, last


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words beginning at each word; the last ``n - 1`` places are missing."""
    size = max(0, len(hashes) - n + 1)
    out = np.full(size, n, U64)
    for k in range(n):
        out = (out ^ hashes[k : k + size]) * U64(0xD6E8FEB86659FD93)
        out ^= out >> U64(32)
    return out


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles; the whole sequence when there are fewer words."""
    hashes, bounds, _, _ = words(texts)
    all_grams = grams(hashes, n)
    out = []
    for i in range(len(texts)):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        if hi - lo >= n:
            out.append(np.unique(all_grams[lo : hi - n + 1]))
        elif hi > lo:
            out.append(grams(hashes[lo:hi], hi - lo))
        else:
            out.append(np.empty(0, U64))
    return out
