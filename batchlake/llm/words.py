"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

#: Bytes looked at together; a word longer than that makes its block longer.
BLOCK = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: A random number for each byte value, so that sums of them tell bytes apart.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def byte_class(members: bytes, inverse: bool = False) -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return ~table if inverse else table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


class WordHasher:
    """64-bit hashes of the maximal runs of ``word`` bytes, after mapping bytes by ``fold``."""

    def __init__(self, word: np.ndarray, fold: np.ndarray):
        assert not word[10]
        self.word, self.values = word, _BYTE[fold]
        self.powers = np.ones(1, np.uint64)

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = self.word[data]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            return starts, np.empty(0, np.uint64)
        sizes = ends - starts
        while len(self.powers) < sizes.max():
            self.powers = np.cumprod(np.full(2 * int(sizes.max()), _ODD))
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
        terms = self.values[data[inside]] * self.powers[place]
        return starts, mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and for text i the range offsets[i]:offsets[i + 1]."""
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        found, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
        while at < len(data):
            end = min(at + BLOCK, len(data))
            while end < len(data) and self.word[data[end]]:
                gap = np.flatnonzero(~self.word[data[end : end + BLOCK]])
                end = end + int(gap[0]) if len(gap) else min(end + BLOCK, len(data))
            starts, values = self._block(data[at:end])
            found.append(starts + at)
            hashes.append(values)
            at = end
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return np.concatenate(hashes), np.searchsorted(np.concatenate(found), begins)
