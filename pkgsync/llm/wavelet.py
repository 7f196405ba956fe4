"""Wavelet matrix over numpy: bit planes with rank samples; access, rank, select and a whole decode, vectorised.

Plane ``b`` (from the highest bit) holds that bit of every symbol in the plane's order; symbols with bit 0 then go
before those with bit 1, each kept in order.  A rank sample stands every ``STEP`` bits, so a rank costs one
sample and at most ``STEP`` bits, counted by bytes.
"""

from __future__ import annotations

import numpy as np

STEP = 64
#: Symbols moved at a time when planes are built or merged: their positions stay in the processor's cache.
BLOCK = 1 << 15
ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class BitVector:
    """Bits packed big-endian, with the number of ones before every word of 64 bits."""

    def __init__(self, packed: np.ndarray, n: int):
        self.n = n
        pad = -len(packed) % 8
        words = np.concatenate([packed, np.zeros(pad + 8, np.uint8)])
        self.words = words.view(">u8").astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        r = (i & 63).astype(np.uint64)
        # the r highest bits of the word; a shift by 64 is undefined, so split it in two
        part = (self.words[w] >> np.uint64(1)) >> (np.uint64(63) - r)
        return self.before[w] + np.bitwise_count(part)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (np.uint64(63) - (i & 63).astype(np.uint64))) & np.uint64(1)

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) such bit, by binary search over ranks."""
        lo, hi = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while len(k) and (hi - lo).max() > 1:
            mid = (lo + hi) // 2
            ones = self.rank1(mid)
            take = (ones if bit else mid - ones) <= k
            lo, hi = np.where(take, mid, lo), np.where(take, hi, mid)
        return lo


class WaveletMatrix:
    """Succinct sequence of symbols below 2**bits."""

    def __init__(self, planes: list[BitVector], zeros: list[int], n: int):
        self.planes, self.zeros, self.n, self.bits = planes, zeros, n, len(planes)

    @staticmethod
    def pack(symbols: np.ndarray, bits: int) -> tuple[list[bytes], list[int]]:
        """The planes' bytes and each plane's number of zeros."""
        a, out, zeros = symbols, [], []
        for b in range(bits - 1, -1, -1):
            bit = (a & a.dtype.type(1 << b)) != 0
            out.append(np.packbits(bit).tobytes())
            zeros.append(len(a) - int(np.count_nonzero(bit)))
            moved, ends = np.empty_like(a), [0, zeros[-1]]
            for s in range(0, len(a), BLOCK):
                own, one = a[s:s + BLOCK], bit[s:s + BLOCK]
                for k, at in enumerate((np.flatnonzero(~one), np.flatnonzero(one))):  # positions cost less than a mask
                    moved[ends[k]:ends[k] + len(at)] = own.take(at)
                    ends[k] += len(at)
            a = moved
        return out, zeros

    @classmethod
    def unpack(cls, planes: list[bytes], zeros: list[int], n: int) -> WaveletMatrix:
        return cls([BitVector(np.frombuffer(p, np.uint8), n) for p in planes], zeros, n)

    @classmethod
    def of(cls, symbols: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = cls.pack(symbols, bits)
        return cls.unpack(planes, zeros, len(symbols))

    def access(self, i: np.ndarray) -> np.ndarray:
        i, out = i.astype(np.int64), np.zeros(len(i), np.int64)
        for v, z in zip(self.planes, self.zeros, strict=True):
            bit, ones = v.get(i).astype(np.int64), v.rank1(i)
            out = out << 1 | bit
            i = np.where(bit == 1, z + ones, i - ones)
        return out

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo, i = np.zeros(len(i), np.int64), i.astype(np.int64)
        for b, (v, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - b)) & 1 == 1
            rl, ri = v.rank1(lo), v.rank1(i)
            lo, i = np.where(one, z + rl, lo - rl), np.where(one, z + ri, i - ri)
        return i - lo

    def rank_pair(self, symbol: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the last order of two bounds: both bounds' ranks, counted from the first of all symbols."""
        for b, (v, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - b)) & 1 == 1
            ri, rj = v.rank1(i), v.rank1(j)
            i, j = np.where(one, z + ri, i - ri), np.where(one, z + rj, j - rj)
        return i, j

    def count(self, symbol: int) -> int:
        return int(self.rank(np.array([symbol]), np.array([self.n]))[0])

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) occurrence of one symbol: occurrence lookup."""
        start = np.zeros(1, np.int64)
        for b, (v, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            r = v.rank1(start)
            start = z + r if (symbol >> (self.bits - 1 - b)) & 1 else start - r
        at = start + np.asarray(k, np.int64)
        for b in range(self.bits - 1, -1, -1):
            v, z = self.planes[b], self.zeros[b]
            bit = (symbol >> (self.bits - 1 - b)) & 1
            at = v.select(bit, at - z if bit else at)
        return at

    @staticmethod
    def decode(planes: list[bytes], zeros: list[int], n: int) -> np.ndarray:
        """All symbols in order, by merging each plane's two halves from the lowest bit up."""
        dtype = np.uint16 if len(planes) <= 16 else np.uint32
        a = np.zeros(n, dtype)
        for b, (p, z) in enumerate(zip(planes[::-1], zeros[::-1], strict=True)):
            bit = np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(bool)
            a[z:] |= dtype(1 << b)
            up, ends = np.empty(n, dtype), [0, z]
            for s in range(0, n, BLOCK):
                to, one = up[s:s + BLOCK], bit[s:s + BLOCK]
                for k, at in enumerate((np.flatnonzero(~one), np.flatnonzero(one))):
                    to[at] = a[ends[k]:ends[k] + len(at)]
                    ends[k] += len(at)
            a = up
        return a
