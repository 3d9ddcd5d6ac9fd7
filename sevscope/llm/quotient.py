"""Counting quotient filters over packed word-id n-grams, for use inside Spark tasks.

An n-gram of word ids (each of ``bits`` bits) is packed into two halves, which Feistel rounds
permute. The permutation can be undone, so a fingerprint is the n-gram itself and counts are exact.
Of a fingerprint, the leading ``quotient`` bits say where it stands, all other bits are stored as
its remainder. A filter keeps its entries in order of (quotient, remainder), each with a counter;
quotients are stored as gaps and small numbers in one byte, so an entry takes few bytes. Filters
in order merge into one without any loss, and a range of quotients (a slice) is a filter as well.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Leading bits of a fingerprint that make its quotient: as many flags has an occupancy map.
QUOTIENT = 26

_U = np.uint64
_ONE = _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (multiply and shift)."""
    x = (x + _U(0x9E3779B97F4A7C15)) * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(29)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _top(x: np.ndarray, bits: int) -> np.ndarray:
    return x >> _U(64 - bits)


@dataclass(frozen=True)
class Layout:
    """How n-grams of ``size`` word ids below ``2 ** bits`` are laid out; at most 4 ids of 32 bits."""
    size: int
    bits: int

    def __post_init__(self):
        if not (2 <= self.size <= 4 and 1 <= self.bits <= 32):
            raise ValueError("2 to 4 word ids of 1 to 32 bits")

    @property
    def left(self) -> int:
        return (self.size + 1) // 2 * self.bits

    @property
    def right(self) -> int:
        return self.size // 2 * self.bits

    @property
    def quotient(self) -> int:
        return min(QUOTIENT, self.left + self.right)

    @property
    def left_rest(self) -> int:
        """Bits of the left half that belong to the remainder."""
        return max(self.left - self.quotient, 0)

    @property
    def right_rest(self) -> int:
        return self.right - max(self.quotient - self.left, 0)

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Permuted halves of n-grams; ``ids`` has one array per word."""
        h = (self.size + 1) // 2
        a, b = ids[0].astype(_U), ids[h].astype(_U)
        if h == 2:
            a = (a << _U(self.bits)) | ids[1].astype(_U)
        if self.size == 4:
            b = (b << _U(self.bits)) | ids[3].astype(_U)
        for _ in range(2):
            a ^= _top(_mix(b), self.left)
            b ^= _top(_mix(a), self.right)
        return a, b

    def unpack(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The n-grams of permuted halves, one row each."""
        for _ in range(2):
            b = b ^ _top(_mix(a), self.right)
            a = a ^ _top(_mix(b), self.left)
        low = _U((1 << self.bits) - 1)
        out = [a >> _U(self.bits), a & low] if self.size > 2 else [a]
        out += [b >> _U(self.bits), b & low] if self.size == 4 else [b]
        return np.stack(out, axis=1).astype(np.int64)

    def quotients(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.quotient <= self.left:
            return a >> _U(self.left - self.quotient)
        return (a << _U(self.quotient - self.left)) | (b >> _U(self.right_rest))


def order(lay: Layout, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The order of fingerprints; a stable sort, which merges runs that are in order."""
    if lay.left + lay.right <= 64:
        return np.argsort((a << _U(lay.right)) | b, kind="stable")
    return np.lexsort((b, a))


@dataclass
class Filter:
    """Distinct fingerprints (halves ``a``, ``b``) in order, with their counts."""
    lay: Layout
    a: np.ndarray
    b: np.ndarray
    n: np.ndarray

    def __len__(self) -> int:
        return len(self.n)

    @classmethod
    def of(cls, lay: Layout, ids: list[np.ndarray]) -> Filter:
        """Counts of n-grams as they stand in a text."""
        a, b = lay.pack(ids)
        return cls.merge(lay, [cls(lay, a, b, np.ones(len(a), np.int64))])

    @classmethod
    def merge(cls, lay: Layout, parts: list[Filter]) -> Filter:
        """One filter of many: equal fingerprints become one entry of their summed counts."""
        a, b, n = (np.concatenate([np.empty(0, t), *(getattr(p, k) for p in parts)]) for k, t in (("a", _U), ("b", _U), ("n", np.int64)))
        at = order(lay, a, b)
        a, b, n = a[at], b[at], n[at]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        starts = np.flatnonzero(new)
        return cls(lay, a[starts], b[starts], np.add.reduceat(n, starts) if len(n) else n)

    def where(self, keep: np.ndarray) -> Filter:
        return Filter(self.lay, self.a[keep], self.b[keep], self.n[keep])

    def slices(self, bits: int) -> list[tuple[int, Filter]]:
        """The non-empty slices by the leading ``bits`` bits of the quotient."""
        q = self.lay.quotients(self.a, self.b) >> _U(self.lay.quotient - bits)
        cuts = np.flatnonzero(np.diff(q.astype(np.int64), prepend=-1))
        return [(int(q[i]), self.where(slice(i, j))) for i, j in zip(cuts, [*cuts[1:], len(q)])]

    def occupied(self, bits: int, number: int) -> bytes:
        """One flag per quotient of slice ``number``: whether an entry has it."""
        flags = np.zeros(1 << (self.lay.quotient - bits), bool)
        flags[(self.lay.quotients(self.a, self.b) - _U(number << (self.lay.quotient - bits))).astype(np.int64)] = True
        return np.packbits(flags).tobytes()

    def to_bytes(self) -> bytes:
        """Gaps of quotients, remainders and counters."""
        lay = self.lay
        gaps = np.diff(self.lay.quotients(self.a, self.b), prepend=_U(0))
        low_a = self.a & _U((1 << lay.left_rest) - 1)
        low_b = self.b & _U((1 << lay.right_rest) - 1)
        return (np.uint64(len(self)).tobytes() + _small(gaps, np.uint32) + _fixed(low_a, lay.left_rest) + _fixed(low_b, lay.right_rest)
                + _small(self.n.astype(_U), np.uint64))

    @classmethod
    def from_bytes(cls, lay: Layout, data: bytes) -> Filter:
        raw = np.frombuffer(data, np.uint8)
        size, at = int(raw[:8].view(_U)[0]), 8
        gaps, at = _read_small(raw, at, size, np.uint32)
        low_a, at = _read_fixed(raw, at, size, lay.left_rest)
        low_b, at = _read_fixed(raw, at, size, lay.right_rest)
        n, at = _read_small(raw, at, size, np.uint64)
        q = np.cumsum(gaps, dtype=_U)
        if lay.quotient <= lay.left:
            a, b = (q << _U(lay.left_rest)) | low_a, low_b
        else:
            spill = _U(lay.quotient - lay.left)
            a, b = q >> spill, ((q & ((_ONE << spill) - _ONE)) << _U(lay.right_rest)) | low_b
        return cls(lay, a, b, n.astype(np.int64))


def _small(x: np.ndarray, wide: type) -> bytes:
    """Numbers in one byte each; 255 stands for the next of the wide numbers that follow."""
    big = x[x >= 255]
    return np.uint64(len(big)).tobytes() + np.minimum(x, _U(255)).astype(np.uint8).tobytes() + big.astype(wide).tobytes()


def _read_small(raw: np.ndarray, at: int, size: int, wide: type) -> tuple[np.ndarray, int]:
    n_big, width = int(raw[at:at + 8].copy().view(_U)[0]), np.dtype(wide).itemsize
    at += 8
    x = raw[at:at + size].astype(_U)
    at += size
    x[x == 255] = raw[at:at + width * n_big].copy().view(wide)
    return x, at + width * n_big


def _fixed(x: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return x.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _read_fixed(raw: np.ndarray, at: int, size: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    x = np.zeros((size, 8), np.uint8)
    x[:, :width] = raw[at:at + size * width].reshape(size, width)
    return x.reshape(-1).view(_U), at + size * width
