"""Rounding, correlation, voting and hashing expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_round(value: Column, lo: float = 0, hi: float = 5) -> Column:
    """Clip to [lo, hi], then round halves to the even neighbour."""
    return F.rint(F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), value)))


def abs_pearson(a: Column, b: Column) -> Column:
    """|Pearson correlation| as an aggregate; NULL when either side is constant."""
    return F.abs(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.sum(a * a))


def mean_absolute_error(truth: Column, prediction: Column) -> Column:
    return F.avg(F.abs(truth - prediction))


def class_of_best(probability: Column) -> Column:
    """1-based position of the largest probability, the first one on ties."""
    return F.array_position(probability, F.array_max(probability)).cast("int")


def weighted_average(
    probabilities: Sequence[Column], weights: Sequence[float], n_classes: int = 5
) -> Column:
    """Weighted element-wise mean of probability arrays."""
    total = float(sum(weights))

    def one_class(c: int) -> Column:
        terms = [F.lit(float(w)) * F.get(p, F.lit(c)) for p, w in zip(probabilities, weights)]
        acc = terms[0]
        for term in terms[1:]:
            acc = acc + term
        return acc / F.lit(total)

    return F.array(*[one_class(c) for c in range(n_classes)])


def log_grid(lo: float, hi: float, n: int) -> list[float]:
    """``n`` values spaced evenly in log10 between 10**lo and 10**hi, ends included."""
    if n == 1:
        return [10.0**lo]
    return [10.0 ** (lo + i * (hi - lo) / (n - 1)) for i in range(n)]


def log_grid_value(step: Column, lo: float, hi: float, n: int) -> Column:
    """The ``step``-th (0-based) value of :func:`log_grid` as an expression."""
    return F.pow(F.lit(10.0), F.lit(float(lo)) + step * F.lit((hi - lo) / (n - 1)))


def seeded_fraction(key: Column, seed: int) -> Column:
    """Uniform value in [0, 1) that depends on key and seed only.

    Unlike ``rand`` it survives recomputation of a lost partition and does not
    change with the partitioning.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def seeded_draw(key: Column, seed: int) -> Column:
    """60 bits that depend on key and seed only; their order is a seeded order of the keys."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
