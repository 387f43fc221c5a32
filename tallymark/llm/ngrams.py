"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallymark.llm.shingles import chunks

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins and the last ends."""
    joined = "".join(texts).encode("utf-32-le", "replace")
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(joined, "<u4").astype(np.uint32), bounds


def gram_bins(numbers: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bin of the n-gram that begins at each place (the last n - 1 places have none)."""
    size = max(len(numbers) - n + 1, 0)
    total = np.full(size, n * 0x165667B1 & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        total += (numbers[k : k + size] + np.uint32(1)) * _FACTORS[k]
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x2C1B3C6D)
    return (total >> np.uint32(32 - bits)).astype(np.int32)


def gram_counts(numbers: np.ndarray, bounds: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each text the number of n-grams in each of 2**bits bins; texts do not run together."""
    bins = {n: gram_bins(numbers, n, bits) for n in orders}
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        mine = [bins[n][a : max(b - n + 1, a)] for n in orders]
        yield np.bincount(np.concatenate(mine), minlength=1 << bits)


def text_gram_counts(texts: list[str], orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    for a, b in chunks(texts):
        yield from gram_counts(*codes(texts[a:b]), orders, bits)
