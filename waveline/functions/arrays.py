"""Sample arrays as column expressions, for windows that stay in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total(x: Column | str) -> Column:
    return F.aggregate(_col(x), F.lit(0.0), lambda a, v: a + v)


def mean(x: Column | str) -> Column:
    return F.try_divide(total(x), F.size(_col(x)))


def rms(x: Column | str) -> Column:
    """Root of the mean square; null for an empty array."""
    return F.sqrt(F.try_divide(F.aggregate(_col(x), F.lit(0.0), lambda a, v: a + v * v), F.size(_col(x))))


def once(value: Column, use) -> Column:
    """``use`` of a value computed once: inside a lambda it would be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def std_pop(x: Column | str) -> Column:
    return once(mean(x), lambda m: F.sqrt(F.try_divide(F.aggregate(_col(x), F.lit(0.0), lambda a, v: a + (v - m) * (v - m)), F.size(_col(x)))))


def asinh(x: Column) -> Column:
    """Sign-symmetric: the built-in loses digits for large negative numbers."""
    return F.signum(x) * F.asinh(F.abs(x))


def standardize_perwindow(x: Column | str) -> Column:
    """A window by its own mean and deviation (at least 1e-12)."""
    units = F.struct(mean(x).alias("m"), F.greatest(std_pop(x), F.lit(1e-12)).alias("s"))
    return once(units, lambda u: F.transform(_col(x), lambda v: (v - u["m"]) / u["s"]))


def standardize_by(x: Column | str, mu: Column, sigma: Column) -> Column:
    """A window in its station's units."""
    return F.transform(_col(x), lambda v: (v - mu) / sigma)


def detrend_linear(x: Column | str) -> Column:
    """A window less its least-squares line."""
    c = _col(x)
    n = F.size(c).cast("double")
    mid = (n - 1) / 2
    spread = n * (n * n - 1) / 12
    tilt = F.aggregate(F.zip_with(c, F.sequence(F.lit(0), F.size(c) - 1), lambda v, i: v * (i - mid)), F.lit(0.0), lambda a, v: a + v)
    line = F.struct(mean(c).alias("m"), F.coalesce(F.try_divide(tilt, spread), F.lit(0.0)).alias("slope"))
    return once(line, lambda u: F.transform(c, lambda v, i: v - u["m"] - u["slope"] * (i - mid)))


def taper_weights(n: int, share: float = 0.05) -> list[float]:
    """One for all but the ends, which follow a Hann half-wave of ``share`` of the window each."""
    k = int(n * share)
    ends = [0.5 - 0.5 * math.cos(2 * math.pi * i / (2 * k - 1)) for i in range(k)]
    return ends + [1.0] * (n - 2 * k) + ends[::-1]


def taper(x: Column | str, n: int, share: float = 0.05) -> Column:
    """A window of ``n`` samples times the taper."""
    weights = F.array(*[F.lit(w) for w in taper_weights(n, share)])
    return F.zip_with(_col(x), weights, lambda v, w: v * w)


def sigma_for(sigma: Column | str, sigma_trimmed: Column | str | None = None) -> Column:
    """The trimmed deviation, else the pooled one; at least 1e-12."""
    choices = ([] if sigma_trimmed is None else [_col(sigma_trimmed)]) + [_col(sigma)]
    return F.greatest(F.coalesce(*choices), F.lit(1e-12))
