"""Words of many texts at once: bounds and hashes from the bytes of an Arrow column, without a loop over words.

Words are maximal runs without ASCII white space, unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of texts that are hashed together; a longer text is alone.
SLICE_BYTES = 1 << 21
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Polynomial:
    """Hashes of stretches, ``sum(value[i] * base ** (i - start))`` modulo 2**64, from one running sum."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # Three more than a multiple of eight: powers of it differ in as many low bits as odd numbers can.
        self.base = int(rng.integers(1 << 60, 1 << 61)) * 8 + 3 & (1 << 64) - 1
        self.powers, self.inverses = (np.ones(1, dtype=np.uint64) for _ in range(2))

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, min(2 * len(self.powers), SLICE_BYTES))
            one = np.ones(1, dtype=np.uint64)
            self.powers, self.inverses = (
                np.cumprod(np.concatenate([one, np.full(size - 1, b, dtype=np.uint64)]))
                for b in (self.base, pow(self.base, -1, 1 << 64)))

    def stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._reach(len(values) + 1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * self.powers[: len(values)], dtype=np.uint64)])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of a number spread over all others, with the finaliser of SplitMix64."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_ONE, _TWO, _LONG = _Polynomial(11), _Polynomial(23), _Polynomial(37)


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, offsets`` of neighbouring texts, about ``most`` bytes at a time. Nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


@dataclass(frozen=True)
class Words:
    """Bounds in bytes of all words of a slice, the text each is in, and the number of each text's first word."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, offsets: np.ndarray) -> Words:
        space = _SPACE[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        before = edge[:-1].copy()
        before[1:] |= space[:-1]
        behind = edge[1:].copy()
        behind[:-1] |= space[1:]
        solid = ~space
        starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & behind) + 1
        owner = np.searchsorted(offsets, starts, side="right") - 1
        counts = np.bincount(owner, minlength=len(offsets) - 1)
        return cls(raw, starts, ends, owner, np.cumsum(counts) - counts, counts)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each word."""
        out = np.empty((2, len(self.starts)), dtype=np.uint64)
        at = 0
        while at < len(self.starts):  # a long text in blocks
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + SLICE_BYTES, side="right")))
            block = self.raw[base : self.ends[to - 1]]
            bounds = self.starts[at:to] - base, self.ends[at:to] - base
            for row, kind in zip(out, (_ONE, _TWO)):
                row[at:to] = kind.stretches(kind.table[block], *bounds)
            at = to
        return out[0], out[1]


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` consecutive words, by the first of them."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for at in range(size):
        out = out * np.uint64(_LONG.base) + hashes[at : at + n]
    return mixed(out)


def stretch_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of words."""
    return _LONG.stretches(hashes, starts, ends)
