"""Scale functions as Column expressions.

Each returns a Column, so scales compose inside one projection; lists of
thresholds become sums of comparisons, which code generation compiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# SI prefix symbols from 10^-24 to 10^24 in steps of 10^3.
SI_SYMBOLS = ["y", "z", "a", "f", "p", "n", "µ", "m", "", "k", "M", "G", "T", "P", "E", "Z", "Y"]


def linear(x: Column, d0, d1, r0: float, r1: float, clamp: bool = False) -> Column:
    """Linear map [d0, d1] -> [r0, r1]; a zero-width domain maps to r0."""
    d0, d1 = F.lit(d0) if not isinstance(d0, Column) else d0, F.lit(d1) if not isinstance(d1, Column) else d1
    t = (x - d0) / (d1 - d0)
    if clamp:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.when(d1 == d0, F.lit(float(r0))).otherwise(F.lit(float(r0)) + t * F.lit(float(r1 - r0)))


def invert(y: Column, d0, d1, r0: float, r1: float) -> Column:
    """Inverse of ``linear``."""
    d0, d1 = F.lit(d0) if not isinstance(d0, Column) else d0, F.lit(d1) if not isinstance(d1, Column) else d1
    return d0 + (y - F.lit(float(r0))) / F.lit(float(r1 - r0)) * (d1 - d0)


def piecewise(x: Column, domain: Sequence[float], rng: Sequence[float], clamp: bool = False) -> Column:
    """Multi-segment linear scale; the segment is chosen by the inner
    domain points (bisect right), then mapped linearly."""
    seg = F.least(F.lit(len(domain) - 2), threshold(x, domain[1:-1]))
    out = None
    for i in range(len(domain) - 1):
        piece = linear(x, float(domain[i]), float(domain[i + 1]), rng[i], rng[i + 1], clamp=False)
        out = F.when(seg == i, piece) if out is None else out.when(seg == i, piece)
    if clamp:
        lo, hi = min(rng[0], rng[-1]), max(rng[0], rng[-1])
        out = F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), out))
    return out


def log_scale(x: Column, d0, d1, r0: float, r1: float, base: float = 10.0) -> Column:
    """Linear on log(x)."""
    lg = lambda c: F.log(float(base), c)
    d0, d1 = F.lit(d0) if not isinstance(d0, Column) else d0, F.lit(d1) if not isinstance(d1, Column) else d1
    return linear(lg(x), lg(d0), lg(d1), r0, r1)


def pow_scale(x: Column, d0, d1, r0: float, r1: float, exponent: float = 0.5) -> Column:
    """Linear on sign(x) * |x| ^ exponent (``sqrt`` for 0.5)."""
    p = lambda c: F.signum(c) * F.pow(F.abs(c), F.lit(float(exponent)))
    d0, d1 = F.lit(d0) if not isinstance(d0, Column) else d0, F.lit(d1) if not isinstance(d1, Column) else d1
    return linear(p(x), p(d0), p(d1), r0, r1)


def threshold(x: Column, thresholds: Sequence[float]) -> Column:
    """bucket = number of thresholds <= x."""
    return sum((F.when(x >= float(t), 1).otherwise(0) for t in thresholds), F.lit(0))


def bucket_bounds(bucket: Column, thresholds: Sequence[float]) -> tuple[Column, Column]:
    """[lower, upper) bound of a threshold bucket; open ends are null."""
    arr = F.array(*[F.lit(float(t)) for t in thresholds])
    n = len(thresholds)
    lo = F.when(bucket > 0, F.element_at(arr, bucket.cast("int")))
    hi = F.when(bucket < n, F.element_at(arr, (bucket + 1).cast("int")))
    return lo, hi


def round_half_up(x: Column, digits: int) -> Column:
    """Round half up as the browser does (``-2.5`` -> ``-2``)."""
    k = F.lit(10.0 ** digits)
    return F.floor(x * k + 0.5) / k


def si_prefix(x: Column) -> tuple[Column, Column, Column]:
    """(exponent, symbol, scaled value) for |x| with the SI prefix of its
    thousands group, clamped to 10^-24 .. 10^24; 0 has exponent 0."""
    a = F.abs(x)
    i = F.lit(1) + F.floor(F.lit(1e-12) + F.log(a) / F.log(F.lit(10.0)))
    e = F.when(a == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(-24), F.least(F.lit(24), (F.floor((i - 1) / 3) * 3).cast("int"))))
    syms = F.array(*[F.lit(s) for s in SI_SYMBOLS])
    sym = F.element_at(syms, (e / 3 + 9).cast("int"))
    return e.cast("int"), sym, x * F.pow(F.lit(10.0), -e)


def ordinal_points(code: Column, n: Column, r0: float, r1: float, padding: float = 0.0) -> Column:
    """P21 ``rangePoints``: evenly spaced points with outer padding in steps."""
    step = F.when(n > 1, (F.lit(r1 - r0)) / (n - 1 + F.lit(padding)))
    start = F.when(n > 1, F.lit(float(r0)) + step * F.lit(padding / 2)).otherwise(F.lit((r0 + r1) / 2))
    return start + F.coalesce(step, F.lit(0.0)) * code


def ordinal_bands(code: Column, n: Column, r0: float, r1: float, padding: float = 0.0,
                  outer_padding: float = 0.0) -> tuple[Column, Column]:
    """P21 ``rangeBands``: (band start, band width)."""
    step = F.lit(float(r1 - r0)) / (n - F.lit(padding) + F.lit(2 * outer_padding))
    return F.lit(float(r0)) + step * F.lit(outer_padding) + step * code, step * F.lit(1 - padding)
