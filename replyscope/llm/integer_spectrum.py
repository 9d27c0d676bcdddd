"""Exact characteristic polynomials of integer matrices, their real roots and null vectors.

Everything here works on one matrix of the dimension of the vectors, never on their rows.
"""

import decimal
from fractions import Fraction
from math import comb, isqrt

import numpy as np

PRIME_BITS = 31


def primes_below(top: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``top`` (at most 2**31)."""
    found, n = [], top - 1 if top % 2 == 0 else top - 2
    while len(found) < count:
        if _is_prime(n):
            found.append(n)
        n -= 2
    return found


def _is_prime(n: int) -> bool:
    """Miller-Rabin with the bases 2, 3, 5 and 7, which decide all numbers below 3,215,031,751."""
    if n < 11 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar upper Hessenberg matrix modulo the prime ``p`` < 2**31, by elimination with row and column steps."""
    h, d = matrix.copy() % p, len(matrix)
    for m in range(1, d - 1):
        filled = np.nonzero(h[m:, m - 1])[0]
        if not len(filled):
            continue
        i = m + int(filled[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t I - matrix) modulo ``p``, constant first, by the recurrence over leading Hessenberg minors."""
    h, d = hessenberg(matrix, p), len(matrix)
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)
    minors[0, 0] = 1
    for k in range(d):
        weights = np.zeros(k + 1, dtype=np.int64)
        below = 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - (weights[:, None] * minors[: k + 1] % p).sum(axis=0)) % p
    return minors[d].tolist()


def coefficient_bits(trace: int, d: int) -> int:
    """Bits that hold every coefficient of the polynomial of a positive semidefinite matrix: the k-th elementary symmetric
    function of d roots >= 0 is at most C(d, k) (trace / d)**k."""
    return max((comb(d, k) * (trace + d) ** k // d**k).bit_length() for k in range(d + 1)) + 2


def chinese(residues: list[list[int]], primes: list[int]) -> list[int]:
    """Numbers of least size with the given residues: ``residues[i][k]`` modulo ``primes[i]``."""
    whole = 1
    for p in primes:
        whole *= p
    out = [0] * len(residues[0])
    for row, p in zip(residues, primes):
        rest = whole // p
        lift = rest * pow(rest % p, -1, p)
        for k, r in enumerate(row):
            out[k] += r * lift
    return [x % whole - whole if 2 * (x % whole) > whole else x % whole for x in out]


def _trimmed(f: list[int]) -> list[int]:
    while f and f[-1] == 0:
        f = f[:-1]
    return f


def divided(f: list[int], g: list[int]) -> list[int] | None:
    """f / g for monic g, or None if there is a rest."""
    rest, out = list(f), [0] * max(0, len(f) - len(g) + 1)
    for k in range(len(out) - 1, -1, -1):
        q = out[k] = rest[k + len(g) - 1]
        if q:
            for i, c in enumerate(g):
                rest[k + i] -= q * c
    return out if not any(rest) else None


def _gcd_mod(f: list[int], g: list[int], p: int) -> list[int]:
    a, b = ([x % p for x in h] for h in (f, g))
    a, b = _trimmed(a), _trimmed(b)
    while b:
        lift = pow(b[-1], -1, p)
        top, rest = np.array([x * lift % p for x in b], dtype=np.int64), np.array(a, dtype=np.int64)
        for k in range(len(rest) - len(top), -1, -1):
            rest[k : k + len(top)] = (rest[k : k + len(top)] - rest[k + len(top) - 1] * top) % p
        a, b = top.tolist(), _trimmed(rest[: len(top) - 1].tolist())
    return a


def common_factor(f: list[int], g: list[int]) -> list[int]:
    """The monic greatest common divisor of monic f and g: images modulo primes, joined until they divide both."""
    if not _trimmed(g):
        return f
    images: list[list[int]] = []
    used: list[int] = []
    for p in _prime_stream():
        image = _gcd_mod(f, g, p)
        if len(image) == 1:
            return [1]
        if images and len(image) > len(images[0]):
            continue  # an unlucky prime
        if images and len(image) < len(images[0]):
            images, used = [], []
        images.append(image)
        used.append(p)
        if len(used) & (len(used) - 1) == 0:
            whole = chinese(images, used)
            if divided(f, whole) is not None and _divides(whole, g):
                return whole
    raise AssertionError


def _prime_stream():
    n = (1 << PRIME_BITS) - 1
    while True:
        if _is_prime(n):
            yield n
        n -= 2


def _divides(g: list[int], f: list[int]) -> bool:
    return len(_trimmed(f)) >= len(g) and divided(_trimmed(f), g) is not None


def _slope(f: list[int]) -> list[int]:
    return [k * c for k, c in enumerate(f)][1:]


def by_multiplicity(f: list[int]) -> list[tuple[list[int], int]]:
    """Monic f as factors without repeated roots, with the multiplicity of their roots (Yun's scheme)."""
    shared = common_factor(f, _slope(f))
    b, c = divided(f, shared), divided(_slope(f), shared)
    out, k = [], 1
    while len(b) > 1:
        d = _trimmed([x - y for x, y in zip([*c, *[0] * len(b)], [*_slope(b), *[0] * len(b)])])
        a = common_factor(b, d)
        if len(a) > 1:
            out.append((a, k))
        b = divided(b, a)
        c = divided(d, a) if d else []
        k += 1
    return out


def _at(f: list[int], num: int, bits: int) -> int:
    """f(num / 2**bits) times 2**(bits * degree)."""
    out, shift = 0, 0
    for c in reversed(f):
        out = out * num + (c << shift)
        shift += bits
    return out


def roots_above(f: list[int], num: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only exceed num / 2**bits: the sign changes of its Taylor coefficients
    there (Budan and Fourier, exact for real roots)."""
    d = len(f) - 1
    c = [x << (bits * (d - k)) for k, x in enumerate(f)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += num * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


class Root:
    """One root of a factor, between low and low + 1 in units of 2**-bits (above low, not above low + 1)."""

    def __init__(self, factor: list[int], multiplicity: int, low: int, bits: int):
        self.factor, self.multiplicity, self.low, self.bits = factor, multiplicity, low, bits
        # the only root in the interval changes the sign; above it the sign is that beyond the interval's end
        top = _at(factor, low + 1, bits)
        self.above = (top > 0) if top else None

    def halve(self) -> None:
        middle, bits = 2 * self.low + 1, self.bits + 1
        value = _at(self.factor, middle, bits)
        if self.above is None:  # the root is the upper end itself
            right = True
        else:
            right = value != 0 and (value > 0) != self.above
        self.low, self.bits = (middle if right else 2 * self.low), bits
        if not right:
            self.above = (value > 0) if value else None

    def between(self) -> tuple[Fraction, Fraction]:
        return Fraction(self.low, 1 << self.bits), Fraction(self.low + 1, 1 << self.bits)


def isolated(f: list[int], multiplicity: int, top: int, wanted: int) -> list[Root]:
    """The ``wanted`` largest roots of a squarefree f whose roots are real, above 0 and not above 2**top, falling."""
    out: list[Root] = []
    # (low, bits, roots above low, roots above the upper end): intervals of width 2**-bits, rightmost last
    open_ = [(0, -top, roots_above(f, 0, 0), 0)]
    while open_ and len(out) < wanted:
        low, bits, n_low, n_high = open_.pop()
        if n_low == n_high:
            continue
        if n_low - n_high == 1 and bits >= 0:
            out.append(Root(f, multiplicity, low, bits))
            continue
        middle = 2 * low + 1
        n_middle = roots_above(f, middle, bits + 1) if bits + 1 >= 0 else roots_above(f, middle << -(bits + 1), 0)
        open_ += [(2 * low, bits + 1, n_low, n_middle), (middle, bits + 1, n_middle, n_high)]
    return out


def largest_roots(f: list[int], wanted: int, extra_bits: int = 110) -> list[tuple[Fraction, int, Fraction]]:
    """Falling positive roots of monic f, whose roots are real and >= 0: (value, multiplicity, distance to the others), as many as
    have ``wanted`` roots between them. A value's error is below its size and its distance to the next root, over 2**extra_bits."""
    while f and f[0] == 0 and len(f) > 1:
        f = f[1:]
    if len(f) < 2:
        return []
    top = max(1, -f[-2]).bit_length()
    every = [r for factor, m in by_multiplicity(f) for r in isolated(factor, m, top, wanted + 1)]
    while True:  # order the roots of different factors by intervals that do not meet
        every.sort(key=lambda r: Fraction(r.low, 1 << r.bits), reverse=True)
        meet = [k for k in range(len(every) - 1) if every[k].between()[0] < every[k + 1].between()[1]]
        if not meet:
            break
        for k in {i for k in meet for i in (k, k + 1)}:
            every[k].halve()
    out, n = [], 0
    for k, root in enumerate(every):
        if n >= wanted:
            break
        n += root.multiplicity
        while True:
            low, high = root.between()
            near = [low] if low else []
            near += [every[k - 1].between()[0] - high] if k else []
            near += [low - every[k + 1].between()[1]] if k + 1 < len(every) else []
            if low and min(near) > (high - low) * (1 << extra_bits):
                break
            root.halve()
            for other in (k - 1, k + 1):  # a neighbour's width must not hide the distance
                if 0 <= other < len(every) and every[other].bits < root.bits:
                    every[other].halve()
        out.append(((low + high) / 2, root.multiplicity, min(near)))
    return out


def null_vectors(matrix: list[list[int]], root: Fraction, multiplicity: int, gap: Fraction) -> list[list[decimal.Decimal]]:
    """Orthonormal vectors of the null space of matrix - root I, by inverse iteration with more digits than its condition takes."""
    d = len(matrix)
    norm = max(sum(abs(x) for x in row) for row in matrix)
    digits = 50 + len(str(int(norm / gap) + 1)) + 34
    with decimal.localcontext() as context:
        context.prec = digits
        shift = decimal.Decimal(root.numerator) / decimal.Decimal(root.denominator)
        rows = np.array([[decimal.Decimal(x) for x in row] for row in matrix], dtype=object)
        rows[np.arange(d), np.arange(d)] -= shift
        least = decimal.Decimal(norm).scaleb(-digits)
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(rows[i, k]))
            rows[[k, pivot]] = rows[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
            if abs(rows[k, k]) < least:
                rows[k, k] = least
            rows[k + 1 :, k] /= rows[k, k]
            rows[k + 1 :, k + 1 :] -= np.outer(rows[k + 1 :, k], rows[k, k + 1 :])
        found: list[np.ndarray] = []
        for start in range(multiplicity):
            v = np.array([decimal.Decimal((i + 1) * (start + 2) * 7919 % 1009 + 1) for i in range(d)], dtype=object)
            for _ in range(3):
                v = _unit(v, found)
                v = v[order]
                for k in range(d):
                    v[k] -= rows[k, :k].dot(v[:k]) if k else 0
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (rows[k, k + 1 :].dot(v[k + 1 :]) if k + 1 < d else 0)) / rows[k, k]
            v = _unit(v, found)
            found.append(v if max(v, key=abs) > 0 else -v)
        return [v.tolist() for v in found]


def _unit(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    v = v / max(abs(x) for x in v)
    for _ in range(2):
        for other in others:
            v = v - other * other.dot(v)
    return v / v.dot(v).sqrt()


def square_root(x: Fraction) -> float:
    """The square root to double precision, of any size."""
    bits = 2 * max(0, 64 - (x.numerator.bit_length() - x.denominator.bit_length()) // 2)
    return float(Fraction(isqrt((x.numerator << (2 * bits)) // x.denominator), 1 << bits))
