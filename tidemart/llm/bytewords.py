"""Words of many texts at once, as ranges of one array of bytes, and hashes of words and phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text that is cut into words at once; one longer text is a lot of its own.
LOT_BYTES = 1_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multipliers, so that their powers have inverses modulo 2^64: two independent hashes of a word.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEPS = np.random.default_rng(12).integers(1, 1 << 63, (2, 64), np.uint64) * np.uint64(2) + np.uint64(1)
_FINISH = np.uint64(0x7FB5D329728EA185)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """True at the bytes within the given ranges, both ends included."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low:high + 1] = True
    return found


@dataclass
class Lot:
    """Texts first to last - 1 of a batch, lower-cased (A-Z), each followed by a line feed."""

    first: int
    last: int
    data: np.ndarray
    sizes: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        """Where the next text begins."""
        return np.cumsum(self.sizes + 1)


def lots(column: pa.Array) -> Iterator[Lot]:
    sizes = np.array([0 if not v.is_valid else len(v.as_buffer()) for v in column], np.int64)
    upto, at = np.cumsum(sizes + 1), 0
    while at < len(sizes):
        before = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, before + LOT_BYTES, "right")))
        raw = b"\n".join([b"" if not v.is_valid else v.as_buffer() for v in column[at:to]] + [b""])
        yield Lot(at, to, LOWER[np.frombuffer(raw, np.uint8)], sizes[at:to])
        at = to


@dataclass
class Words:
    """start, end and text (its number in the lot) of each word of a lot."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def words_of(lot: Lot, breaks: np.ndarray) -> Words:
    """Maximal runs of bytes that are not in `breaks`, which must hold the line feed."""
    inside = np.concatenate([[False], ~breaks[lot.data]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[::2], turn[1::2]
    return Words(start, end, np.searchsorted(lot.ends, start, "right"))


class Hasher:
    """64-bit hashes of ranges of bytes, each by a difference of two sums over the lot."""

    def __init__(self) -> None:
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
        n = len(data)
        if lane not in self.powers or len(self.powers[lane][0]) < n:
            rows = []
            for step in (_BASES[lane], pow(_BASES[lane], -1, 1 << 64)):
                row = np.full(max(n, LOT_BYTES + 1), step, np.uint64)
                row[0] = 1
                rows.append(np.multiply.accumulate(row))
            self.powers[lane] = rows[0], rows[1]
        up, down = self.powers[lane]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        return finished((sums[end] - sums[start]) * down[start])


def finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FINISH
    h = (h ^ (h >> np.uint64(29))) * _FINISH
    return h ^ (h >> np.uint64(32))


def phrase_hash(words: np.ndarray, at: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hashes of the phrases of `length` words that start at the words `at`."""
    total = words[at] * _STEPS[lane, length]
    for i in range(1, length):
        total = total + words[at + i] * _STEPS[lane, 8 * i + length]
    return finished(total)


def counted(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct pair of hashes, and how often it occurs."""
    order = np.argsort(one)
    a, b = one[order], two[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return order[new], np.diff(np.append(new, len(a)))


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The ranges of `data` as strings."""
    return ranges(data, start, end, pa.string())


def ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The ranges of `data` as bytes, or as another `kind` of like layout."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    taken = data[np.repeat(start - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(kind or pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(taken)])
