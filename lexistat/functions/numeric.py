"""Numeric column expressions: hash draws, normal quantiles, histogram widths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 4294967296
HALF = 65536

# Fixed value: the factor of the multiplicative hash.
HASH_FACTOR = 2654435761

# Multiplier and increment of the reproducible draws, one pair per stream.
DRAW_STREAMS = ((1664525, 1013904223), (22695477, 12345))

# The published rational approximation of the normal quantile (AS 241, PPND16),
# numerator and denominator of the central part, the near tail and the far tail,
# constant term first.
CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3),
)
NEAR_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9),
)
FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15),
)


def hash_unit(key: Column) -> Column:
    """A number in [0, 1) fixed by an integer key; the same in every run and engine.

    It is ``key * HASH_FACTOR mod 2^32``, multiplied in two halves so that no key overflows.
    """
    low = F.pmod(key.cast("bigint"), F.lit(MODULUS))
    upper = F.pmod(F.shiftright(low, 16) * F.lit(HASH_FACTOR), F.lit(HALF)) * F.lit(HALF)
    product = upper + low.bitwiseAND(F.lit(HALF - 1)) * F.lit(HASH_FACTOR)
    return F.pmod(product, F.lit(MODULUS)) / F.lit(float(MODULUS))


def draw_unit(index: Column, stream: int) -> Column:
    """Reproducible draw number ``index`` of a stream, in [0, 1)."""
    factor, increment = DRAW_STREAMS[stream]
    return F.pmod(index * F.lit(factor) + F.lit(increment), F.lit(MODULUS)) / F.lit(float(MODULUS))


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(c)
    return value


def _ratio(x: Column, part: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    return _polynomial(x, part[0]) / _polynomial(x, part[1])


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution for 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1.0 - p)))
    tail = F.when(r <= 5.0, _ratio(r - 1.6, NEAR_TAIL)).otherwise(_ratio(r - 5.0, FAR_TAIL))
    return F.when(F.abs(q) <= 0.425, q * _ratio(0.180625 - q * q, CENTRE)).otherwise(
        F.signum(q) * tail
    )


def sturges(n: Column) -> Column:
    """Number of histogram classes for n values."""
    return F.ceil(F.log2(n.cast("double")) + 1)


def pretty_width(low: Column, high: Column, classes: Column) -> Column:
    """Class width 1, 2 or 5 times a power of ten that covers the range in about ``classes``."""
    size = F.greatest(F.abs(low), F.abs(high))
    flat = F.when(size == 0, F.lit(1.0)).otherwise(size)
    flat = F.when(flat > 10, 9 + flat / 10).otherwise(flat) * 0.75
    cell = F.when(high > low, (high - low) / classes).otherwise(flat)
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    return (
        F.when(10 * base - cell < 1.5 * (cell - 5 * base), 10 * base)
        .when(5 * base - cell < 2.75 * (cell - 2 * base), 5 * base)
        .when(2 * base - cell < 1.5 * (cell - base), 2 * base)
        .otherwise(base)
    )
