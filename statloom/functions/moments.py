"""Sample-adjusted moments from Spark's single-pass population aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skewness(g1: Column, n: Column, constant: Column) -> Column:
    """Adjusted Fisher-Pearson G1; 0 for a constant column, NULL below three values."""
    n = n.cast("double")
    return F.when(n < 3, None).when(constant, 0.0).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(g2: Column, n: Column, constant: Column) -> Column:
    """Adjusted excess kurtosis G2; 0 for a constant column, NULL below four values."""
    n = n.cast("double")
    return (
        F.when(n < 4, None)
        .when(constant, 0.0)
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def power_sums(c: Column, shift: float, tag: str) -> list[Column]:
    """Sums of the first four powers of ``c - shift``.

    With a shift near the mean they lose no precision, and plain sums keep the generated
    aggregation code small however many columns share the scan.
    """
    d = c - F.lit(float(shift))
    return [F.sum(x).alias(f"p{k}_{tag}") for k, x in enumerate([d, d * d, d * d * d, d * d * d * d], start=1)]


def central_moments(n: Column, tag: str) -> tuple[Column, Column, Column]:
    """Second, third and fourth central moments from shifted power sums."""
    a, b, c, d = (F.try_divide(F.col(f"p{k}_{tag}"), n) for k in (1, 2, 3, 4))
    m2 = F.greatest(F.lit(0.0), b - a * a)
    m3 = c - 3 * a * b + 2 * a * a * a
    m4 = d - 4 * a * c + 6 * a * a * b - 3 * a * a * a * a
    return m2, m3, m4
