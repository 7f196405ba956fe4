"""Largest eigenvalues and eigenvectors of a symmetric positive semidefinite integer matrix, without rounding errors.

The characteristic polynomial is found modulo many primes (Hessenberg reduction, all primes of a batch in step) and put
together by Chinese remaindering.  All its roots are real and none is negative, so the sign changes in the coefficients
of p(x + a) count the roots above a exactly, with multiplicity (Budan-Fourier); bisection on integers isolates and
refines them.  Eigenvectors come from inverse iteration in fixed-point arithmetic of BITS bits.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, isqrt

import numpy as np

#: Relative precision of a root and bits of the fixed-point arithmetic.
PRECISION, BITS = 120, 384


# --- characteristic polynomial ---------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2**32."""
    if any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_for(matrix: list[list[int]]) -> list[int]:
    """Primes below 2**31 whose product exceeds twice any coefficient (Maclaurin's bound from the trace)."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    mean = -(-trace // d)
    bound, product, primes, n = 2 * max(comb(d, k) * mean**k for k in range(d + 1)) + 1, 1, [], 2**31 - 1
    while product <= bound:
        if is_prime(n):
            primes.append(n)
            product *= n
        n -= 2
    return primes


def inverse_mod(a: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """a ** (p - 2) for each prime: the inverse, and 0 for 0."""
    out, power, e = np.ones_like(a), a % primes, primes - 2
    for bit in range(31):
        out = np.where(e >> bit & 1, out * power % primes, out)
        power = power * power % primes
    return out


def polynomials_mod(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(xI - matrix), highest first, modulo each prime."""
    d, p = len(matrix), np.array(primes, np.int64)
    big = np.array(matrix, dtype=object).reshape(d, d)
    h = np.stack([(big % q).astype(np.int64) for q in primes])
    p2, p3, each = p[:, None], p[:, None, None], np.arange(len(p))
    for k in range(1, d - 1):
        pivot = k + np.argmax(h[:, k:, k - 1] != 0, 1)  # without one the column is in form already
        rows, swap = h[each, k].copy(), h[each, pivot].copy()
        h[each, k], h[each, pivot] = swap, rows
        columns, swap = h[each, :, k].copy(), h[each, :, pivot].copy()
        h[each, :, k], h[each, :, pivot] = swap, columns
        factor = h[:, k + 1:, k - 1] * inverse_mod(h[:, k, k - 1], p)[:, None] % p2
        h[:, k + 1:, :] = (h[:, k + 1:, :] - factor[:, :, None] * h[:, k, None, :] % p3) % p3
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1:] * factor[:, None, :] % p3).sum(2)) % p2
    known = [np.zeros((len(p), d + 1), np.int64)]  # polynomials of the leading blocks, lowest coefficient first
    known[0][:, 0] = 1
    for k in range(d):
        new = np.zeros_like(known[0])
        new[:, 1:] = known[k][:, :-1]
        new = (new - h[:, k, k, None] * known[k]) % p2
        below = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            new = (new - (h[:, i, k] * below % p)[:, None] * known[i]) % p2
        known.append(new)
    return known[d][:, ::-1]


def remaindered(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integers of least absolute value with these residues (one row for each prime)."""
    product = 1
    for q in primes:
        product *= q
    weights = [(product // q) * pow(product // q, -1, q) for q in primes]
    out = []
    for column in residues.T.tolist():
        c = sum(r * w for r, w in zip(column, weights, strict=True)) % product
        out.append(c - product if 2 * c > product else c)
    return out


# --- roots --------------------------------------------------------------------------------

class RealRooted:
    """A polynomial with positive roots only; roots as (numerator, shift): numerator / 2**shift."""

    def __init__(self, coefficients: list[int]):
        self.coefficients, self.degree = coefficients, len(coefficients) - 1
        self.scaled = lru_cache(maxsize=None)(self.scaled)
        self.above = lru_cache(maxsize=None)(self.above)

    def scaled(self, shift: int) -> list[int]:
        return [c << shift * i for i, c in enumerate(self.coefficients)]

    def above(self, a: int, shift: int) -> int:
        """How many roots exceed a / 2**shift, with multiplicity: sign changes of the shifted polynomial."""
        c = list(self.scaled(shift))
        for end in range(self.degree, 0, -1):
            run = 0
            for i in range(end + 1):
                run = c[i] = c[i] + run * a
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, a: int, shift: int) -> int:
        run = 0
        for c in self.scaled(shift):
            run = run * a + c
        return (run > 0) - (run < 0)

    def root(self, k: int, precision: int = PRECISION) -> tuple[int, int]:
        """The k-th largest root, counted from 1, at most 2**-precision of itself too high."""
        shift, low, high = 0, 0, 1
        while self.above(high, 0) >= k:
            low, high = high, high * 2
        while True:
            while high - low > 1:
                middle = (low + high) // 2
                n_low, n_high = self.above(low, shift), self.above(high, shift)
                if n_low - n_high == 1:  # isolated: the sign decides
                    return self.refined(low, high, shift, -1 if n_high % 2 else 1, precision)
                low, high = (middle, high) if self.above(middle, shift) >= k else (low, middle)
            if low >> precision:
                return high, shift
            shift, low, high = shift + 64, low << 64, high << 64

    def refined(self, low: int, high: int, shift: int, above: int, precision: int) -> tuple[int, int]:
        """A single root in (low, high]; ``above`` is the sign between it and the next larger one."""
        while True:
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if self.sign(middle, shift) in (0, above) else (middle, high)
            if low >> precision:
                return high, shift
            shift, low, high = shift + 64, low << 64, high << 64


def largest_roots(coefficients: list[int], k: int) -> list[tuple[int, int]]:
    """The k largest positive roots of a characteristic polynomial without negative ones (fewer where there are fewer)."""
    rank = max(i for i, c in enumerate(coefficients) if c)
    p = RealRooted(coefficients[:rank + 1])
    return [p.root(i) for i in range(1, min(k, rank) + 1)]


# --- eigenvectors ---------------------------------------------------------------------------

def eigenvectors(matrix: list[list[int]], root: tuple[int, int], count: int) -> list[list[float]]:
    """``count`` orthonormal vectors (as doubles) of the null space of matrix - root, ``count`` being its multiplicity."""
    numerator, shift = root
    d = len(matrix)
    b = np.array(matrix, dtype=object).reshape(d, d) << shift
    size = max(int(abs(b).max()), numerator, 1).bit_length()
    b[np.arange(d), np.arange(d)] -= numerator
    scale = BITS - size
    b = b << scale if scale >= 0 else b >> -scale  # norms near 2**BITS stand for one
    order, lower = decomposed(b)
    block = [np.array([(1 << BITS) // (1 + (i * (j + 2) + j) % (d + 1 + j)) for i in range(d)], dtype=object) for j in range(count)]
    block = orthonormal(block)
    for _ in range(30):
        new = orthonormal([solved(b, order, lower, v) for v in block])
        # settled when the new block lies in the span of the old one
        apart = max(int(max(abs(v - sum(((int((v * u).sum()) >> BITS) * u) >> BITS for u in block)))) for v in new)
        block = new
        if apart >> (BITS - 100) == 0:
            break
    return [[float(x / 2**64) for x in (v >> BITS - 64).tolist()] for v in block]


def decomposed(b: np.ndarray) -> tuple[list[int], np.ndarray]:
    """LU with row pivots, in place (upper part in ``b``): the order of rows and the factors below."""
    d = len(b)
    order, lower = list(range(d)), np.zeros((d, d), dtype=object)
    for k in range(d):
        pivot = k + int(np.argmax([abs(x) for x in b[k:, k]]))
        if pivot != k:
            b[[k, pivot]], lower[[k, pivot]] = b[[pivot, k]], lower[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if b[k, k] == 0:
            b[k, k] = 1  # the null space itself: one unit in the last place
        for i in range(k + 1, d):
            if b[i, k]:
                lower[i, k] = (int(b[i, k]) << BITS) // int(b[k, k])
                b[i, k:] -= (lower[i, k] * b[k, k:]) >> BITS
    return order, lower


def solved(upper: np.ndarray, order: list[int], lower: np.ndarray, v: np.ndarray) -> np.ndarray:
    x = v[order]
    d = len(x)
    for i in range(1, d):
        x[i] -= int((lower[i, :i] * x[:i]).sum()) >> BITS
    for i in range(d - 1, -1, -1):
        rest = int((upper[i, i + 1:] * x[i + 1:]).sum()) >> BITS if i < d - 1 else 0
        x[i] = ((int(x[i]) - rest) << BITS) // int(upper[i, i])
    return x


def orthonormal(block: list[np.ndarray]) -> list[np.ndarray]:
    """Gram-Schmidt (twice) on fixed-point vectors of any size."""
    out: list[np.ndarray] = []
    for v in block:
        for _ in range(2):
            norm = max(isqrt(int((v * v).sum())), 1)
            v = np.array([(int(x) << BITS) // norm for x in v], dtype=object)
            for u in out:
                v = v - ((int((v * u).sum()) >> BITS) * u >> BITS)
        norm = max(isqrt(int((v * v).sum())), 1)
        out.append(np.array([(int(x) << BITS) // norm for x in v], dtype=object))
    return out
