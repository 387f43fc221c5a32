"""Hashes of the word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_GAP = np.uint64(0xD1B54A32D192ED03)  # stands for the words that a short text lacks
_BLANK = np.zeros(0x110000, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Scrambled numbers as reals in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words of each text."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    blank = np.concatenate([[True], _BLANK[codes], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers = np.full(len(codes), _P, np.uint64)
    inverse = np.full(len(codes), _P_INVERSE, np.uint64)
    if len(codes):
        powers[0] = inverse[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64)) * powers, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, np.diff(np.searchsorted(starts, bounds))


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, hash, times in the text; sorted by row, then hash.

    A text of fewer words than a shingle is one shingle; a text without words has none.
    """
    words, n = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    rows = np.repeat(np.arange(len(texts)), count)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    at, end = first[rows] + within, (first + n)[rows]
    hashes = np.zeros(len(rows), np.uint64)
    for k in range(size):
        there = at + k < end
        word = np.where(there, words[np.minimum(at + k, max(len(words) - 1, 0))], _GAP)
        hashes = mixed(hashes * np.uint64(_P) + word)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    places = np.flatnonzero(new)
    return rows[places], hashes[places], np.diff([*places, len(rows)])


def chunks(texts: list[str], chars: int = 1 << 18, most: int = 256):
    """Consecutive parts of a list of texts, of about so many characters and texts at most."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars or i + 1 - at == most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
