"""Numeric array expressions: everything stays in Catalyst, one row at a time, without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Length that every sequence feature is brought to.
SEQUENCE_LENGTH = 32
EPSILON = 1e-10


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside a lambda a plain reference is computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doubles(a) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def finite(a) -> Column:
    """NaN, infinities and nulls become 0."""
    return F.transform(a, lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x.cast("double")))


def null_if_not_finite(a) -> Column:
    """NaN and infinities become null, as in written documents."""
    return F.transform(a, lambda x: F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x.cast("double")))


def total(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a) -> Column:
    """0 for an empty array."""
    return total(a) / F.greatest(F.size(a), F.lit(1))


def central_moment(a, order: int) -> Column:
    power = lambda c: reduce(lambda p, _: p * c, range(order - 1), c)
    return let(mean(a), lambda m: mean(F.transform(a, lambda x: power(x - m))))


def std(a) -> Column:
    """Population standard deviation."""
    return F.sqrt(central_moment(a, 2))


def skewness(a) -> Column:
    """Population skewness; 0 for a constant series."""
    ratio = lambda v: F.when(v > 1e-16, central_moment(a, 3) / F.pow(v, F.lit(1.5))).otherwise(0.0)
    return let(central_moment(a, 2), ratio)


def kurtosis(a) -> Column:
    """Population excess kurtosis; 0 for a constant series."""
    ratio = lambda v: F.when(v > 1e-16, central_moment(a, 4) / (v * v) - 3.0).otherwise(0.0)
    return let(central_moment(a, 2), ratio)


def percentile(a, q: float) -> Column:
    """Linear interpolation between order statistics; null for an empty array."""

    def pick(s):
        at = (F.size(s) - 1) * F.lit(q)
        low = F.floor(at).cast("int")
        high = F.least(low + 1, F.size(s) - 1)
        return F.when(F.size(s) > 0, F.get(s, low) + (F.get(s, high) - F.get(s, low)) * (at - low))

    return let(F.array_sort(a), pick)


def entropy(a, uniform_if_empty: bool = False) -> Column:
    """Shannon entropy in bits of absolute values as weights. A sum below 1e-10 gives 0, or log2(n) if asked."""
    empty = F.log2(F.size(a).cast("double")) if uniform_if_empty else F.lit(0.0)

    def bits(s):
        share = lambda x: F.abs(x) / s
        return F.when(s < EPSILON, empty).otherwise(total(F.transform(a, lambda x: -share(x) * F.log2(share(x) + EPSILON))))

    return let(F.aggregate(a, F.lit(0.0), lambda t, x: t + F.abs(x)), bits)


def resample(a, n: int = SEQUENCE_LENGTH) -> Column:
    """Linear interpolation to n points, end points kept; an empty array gives zeros."""
    last = F.size(a) - 1

    def point(i):
        at = i.cast("double") * last / F.lit(float(n - 1))
        low = F.least(F.floor(at).cast("int"), last)
        high = F.least(low + 1, last)
        return F.get(a, low) + (F.get(a, high) - F.get(a, low)) * (at - low)

    return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)).otherwise(F.array_repeat(F.lit(0.0), n))


def deltas(a) -> Column:
    """Differences to the value before, the first one 0."""
    return F.transform(a, lambda x, i: F.when(i > 0, x - F.get(a, i - 1)).otherwise(x - x))


def argmax(a) -> Column:
    """Place of the first highest value, from 0."""
    return F.array_position(a, F.array_max(a)).cast("int") - 1


def frames(a, size: int) -> Column:
    """Consecutive slices of ``size``; a shorter rest is dropped."""
    n = F.floor(F.size(a) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(a, i * size + 1, size))).otherwise(
        F.filter(F.array(a), lambda x: F.lit(False))
    )


def dot(a, b) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def downmix(left, right) -> Column:
    """Mean of two channels."""
    return F.zip_with(left, right, lambda x, y: (x + y) / 2.0)


def energy(a) -> Column:
    return mean(F.transform(a, lambda x: x * x))


def peak(a) -> Column:
    return F.coalesce(F.array_max(F.transform(a, lambda x: F.abs(x))), F.lit(0.0))


def crest(a) -> Column:
    """Peak over root mean square; 0 for near silence."""
    r = F.sqrt(energy(a))
    return F.when(r < 1e-9, 0.0).otherwise(peak(a) / r)


def zero_crossing_rate(a) -> Column:
    """Share of neighbours with different signs, 0 counting as positive."""
    flips = F.aggregate(
        F.sequence(F.lit(1), F.size(a) - 1),
        F.lit(0.0),
        lambda s, i: s + ((F.get(a, i) >= 0) != (F.get(a, i - 1) >= 0)).cast("double"),
    )
    return F.when(F.size(a) > 1, flips / (F.size(a) - 1)).otherwise(0.0)


def autocorrelation(a, lag) -> Column:
    """Sum of a[i] * a[i + lag]."""
    n = F.size(a) - lag
    return dot(F.slice(a, F.lit(1), n), F.slice(a, lag + 1, n))


def normalised_autocorrelation_peak(a, low: int, high: int) -> Column:
    """Highest autocorrelation at lags [low, high) over that at lag 0, within [0, 1]."""
    zero = dot(a, a)
    best = F.array_max(F.transform(F.sequence(F.lit(low), F.lit(high - 1)), lambda k: autocorrelation(a, k)))
    return F.when(zero < 1e-9, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), best / zero)))
