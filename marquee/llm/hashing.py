"""Hashes of words and of runs of words, computed for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

A = np.uint64(0x9E3779B97F4A7C15)
B = np.uint64(0xBF58476D1CE4E5B9)
C = np.uint64(0x94D049BB133111EB)

#: The white space that separates words: space and the code points 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(A), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x)])) for x in (A, inverse))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, at least n of each."""
    return _powers(max(1 << 18, 1 << (max(n, 1) - 1).bit_length()))


def running_hashes(codes: np.ndarray) -> np.ndarray:
    """Sums S so that (S[e] - S[s]) * inverse[s] is the polynomial hash of codes[s:e]."""
    powers, _ = power_tables(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)], out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of texts data[bounds[i]:bounds[i + 1]], and the words' bounds by text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = ~SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = running_hashes(data)
    _, inverse = power_tables(len(data))
    return mixed((sums[ends] - sums[starts]) * inverse[starts]), np.searchsorted(starts, bounds)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words. A text with
    fewer words has one run, all its words; a text without words has none."""
    words, of = word_hashes(data, bounds)
    runs = np.zeros(0, np.uint64)
    if len(words) >= width:
        runs = words[: len(words) - width + 1].copy()
        for j in range(1, width):
            runs *= A
            runs += words[j : len(words) - width + 1 + j]
        runs = mixed(runs)
    out = []
    for first, last in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if last - first >= width:
            some = np.sort(runs[first : last - width + 1])
            out.append(some[np.concatenate([[True], some[1:] != some[:-1]])])
        elif last > first:
            whole = np.uint64(last - first)
            for w in words[first:last]:
                whole = np.uint64((int(whole) * int(A) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
