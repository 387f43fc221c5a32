"""Work done once per distinct word, laid out again for whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Texts whose distinct words are looked up together.
TEXTS = 1024


#: Bytes of words and values that a memory keeps, twice at most.
KEPT = 64 << 20


class Remembered:
    """Values of a function over words; those asked for lately are kept, within bounds of number and bytes."""

    def __init__(self, compute: Callable[[list[bytes]], list[bytes]], most: int, most_bytes: int = KEPT):
        self.compute, self.most, self.most_bytes = compute, most, most_bytes
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.bytes = 0

    def __call__(self, words: list[bytes]) -> list[bytes]:
        if len(self.new) > self.most or self.bytes > self.most_bytes:
            self.old, self.new, self.bytes = self.new, {}, 0
        found = list(map(self.new.get, words))
        unknown = []
        for i in [i for i, value in enumerate(found) if value is None]:
            found[i] = self.old.get(words[i])
            if found[i] is None:
                unknown.append(i)
            else:
                self._keep(words[i], found[i])
        for i, value in zip(unknown, self.compute([words[i] for i in unknown]), strict=True):
            found[i] = value
            self._keep(words[i], value)
        return found

    def _keep(self, word: bytes, value: bytes) -> None:
        size = len(word) + len(value)
        if size <= self.most_bytes >> 10:  # a very long word is not worth many short ones
            self.new[word] = value
            self.bytes += size


def spread(lists: pa.Array, values: Callable[[list[bytes]], list[bytes]], kind: str) -> Iterator[np.ndarray]:
    """For each list of words, the values of its words in a row, as numbers of a type."""
    words = lists.flatten().dictionary_encode()
    found = values(words.dictionary.cast(pa.binary()).to_pylist())
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(b"".join(found), kind)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) // size
    starts = np.cumsum(lengths) - lengths
    each = words.indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths[each])])
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0] if len(bounds) else 0
    for at in range(0, len(lists), 256):
        to = min(at + 256, len(lists))
        mine = slice(bounds[at], bounds[to])
        # Where each number stands in `flat`: the start of its word, and on from there.
        shift = np.repeat(starts[each[mine]] - ends[mine], lengths[each[mine]])
        low, high = ends[bounds[at]], ends[bounds[to]]
        numbers = flat[shift + np.arange(low, high)]
        cuts = ends[bounds[at : to + 1]] - low
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield numbers[a:b]
