"""Normality tests: Shapiro-Wilk up to 5000 values, D'Agostino-Pearson above."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions import tails
from statloom.functions.exprs import ALPHA, melt, rnd

SHAPIRO_MAX = 5000

# Polynomial coefficients of Royston's 1995 approximation (AS R94),
# lowest power first.
END_WEIGHT = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
NEXT_WEIGHT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_GAMMA = [-2.273, 0.459]
SMALL_MEAN = [0.5440, -0.39978, 0.025054, -0.6714e-3]
SMALL_LOG_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_LOG_SD = [-0.4803, -0.082676, 0.0030302]


def _poly(coefficients: list[float], x: Column) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + c
    return out


def shapiro_wilk(long: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys..., n, statistic, p_value)`` for groups of 3 to 5000 values."""
    order = Window.partitionBy(*keys).orderBy(value)
    whole = Window.partitionBy(*keys)  # at most SHAPIRO_MAX rows
    ranked = long.select(
        *keys,
        F.row_number().over(order).alias("r"),
        F.count("*").over(whole).alias("n"),
        (F.col(value) - F.avg(value).over(whole)).alias("x"),
    ).withColumn("m", tails.normal_quantile((F.col("r") - 0.375) / (F.col("n") + 0.25)))

    def at(position: Column, what: str) -> Column:
        return F.max(F.when(F.col("r") == position, F.col(what)))

    n = F.col("n")
    g = ranked.groupBy(*keys, "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum(F.col("m") * F.col("x")).alias("mx"),
        F.sum(F.col("x") * F.col("x")).alias("ss"),
        at(F.lit(1), "x").alias("x1"),
        at(F.lit(2), "x").alias("x2"),
        at(n - 1, "x").alias("xp"),
        at(n, "x").alias("xn"),
        at(n, "m").alias("mn"),
        at(n - 1, "m").alias("mp"),
    )
    u = 1 / F.sqrt("n")
    root = F.sqrt("mm")
    a_n = F.when(n == 3, math.sqrt(0.5)).otherwise(F.col("mn") / root + _poly(END_WEIGHT, u))
    a_p = F.col("mp") / root + _poly(NEXT_WEIGHT, u)
    g = g.withColumns({"an": a_n, "ap": a_p})
    two_ends = (F.col("mm") - 2 * F.col("mn") ** 2 - 2 * F.col("mp") ** 2) / (
        1 - 2 * F.col("an") ** 2 - 2 * F.col("ap") ** 2
    )
    one_end = F.try_divide(F.col("mm") - 2 * F.col("mn") ** 2, 1 - 2 * F.col("an") ** 2)
    ends = F.col("mn") * (F.col("xn") - F.col("x1"))
    nexts = F.col("mp") * (F.col("xp") - F.col("x2"))
    outer = F.col("an") * (F.col("xn") - F.col("x1"))
    weighted = (
        F.when(n == 3, outer)
        .when(n <= 5, outer + (F.col("mx") - ends) / F.sqrt(one_end))
        .otherwise(
            outer + F.col("ap") * (F.col("xp") - F.col("x2")) + (F.col("mx") - ends - nexts) / F.sqrt(two_ends)
        )
    )
    # all values equal: the statistic is 1 by convention
    w = F.when(F.col("ss") <= 0, 1.0).otherwise(F.least(F.lit(1.0), weighted * weighted / F.col("ss")))
    g = g.withColumn("statistic", w)
    rest = F.log(F.greatest(1 - F.col("statistic"), F.lit(1e-300)))
    size = n.cast("double")
    ln = F.log(size)
    gamma = _poly(SMALL_GAMMA, size)
    z_small = (-F.log(F.greatest(gamma - rest, F.lit(1e-300))) - _poly(SMALL_MEAN, size)) / F.exp(_poly(SMALL_LOG_SD, size))
    z_large = (rest - _poly(LARGE_MEAN, ln)) / F.exp(_poly(LARGE_LOG_SD, ln))
    z = F.when(n <= 11, z_small).otherwise(z_large)
    p3 = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt("statistic")) - math.asin(math.sqrt(0.75))))
    p = (
        F.when(F.col("ss") <= 0, 1.0)
        .when(n == 3, p3)
        .when((n <= 11) & (rest >= gamma), 0.0)
        .otherwise(tails.normal_upper(z))
    )
    return g.select(*keys, "n", "statistic", p.alias("p_value"))


def skewness_z(n: Column, g1: Column) -> Column:
    """Normal score of the population skewness."""
    n = n.cast("double")
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta2 - 1))
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    y = F.when(y == 0, 1.0).otherwise(y)  # convention for exact symmetry
    return delta * F.asinh(y / alpha)


def kurtosis_z(n: Column, g2: Column) -> Column:
    """Normal score of the population excess kurtosis."""
    n = n.cast("double")
    mean = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (g2 + 3 - mean) / F.sqrt(variance)
    beta1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / beta1 * (2 / beta1 + F.sqrt(1 + 4 / beta1**2))
    inner = F.try_divide(1 - 2 / a, 1 + x * F.sqrt(2 / (a - 4)))
    return (1 - 2 / (9 * a) - F.cbrt(inner)) / F.sqrt(2 / (9 * a))


def dagostino_pearson(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """(K squared, p) from population skewness and excess kurtosis."""
    k2 = skewness_z(n, g1) ** 2 + kurtosis_z(n, g2) ** 2
    return k2, F.exp(-k2 / 2)


def normality(df: DataFrame, names: list[str], keys: list[str] = (), min_n: int = 8) -> DataFrame:
    """``(keys..., feature, n, test, statistic, p_value)``; groups below ``min_n`` give NULLs.

    Sizes and moments come from one aggregate. Only groups of at most 5000 values are
    ranked, so no window ever holds more than that.
    """
    keys = list(keys)
    long = melt(df, names, "v", keep=keys)
    by = [*keys, "feature"]
    # constant data has no shape: no statistic, as for too few rows
    flat = F.min("v") == F.max("v")
    stats = long.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.when(~flat, F.skewness("v")).alias("g1"),
        F.when(~flat, F.kurtosis("v")).alias("g2"),
    )
    small = stats.filter((F.col("n") <= SHAPIRO_MAX) & (F.col("n") >= min_n)).select(*by)
    if not keys:
        small = F.broadcast(small)  # one row per column
    shapiro = shapiro_wilk(long.join(small, by, "left_semi"), by, "v")
    k2, p = dagostino_pearson(F.col("n"), F.col("g1"), F.col("g2"))
    none = F.lit(None).cast("double")
    big = stats.filter(F.col("n") > SHAPIRO_MAX).select(
        *by, "n", F.lit("D'Agostino-Pearson").alias("test"), k2.alias("statistic"), p.alias("p_value")
    )
    few = stats.filter(F.col("n") < min_n).select(
        *by, "n", F.lit("n/a").alias("test"), none.alias("statistic"), none.alias("p_value")
    )
    low = shapiro.select(*by, "n", F.lit("Shapiro-Wilk").alias("test"), "statistic", "p_value")
    return big.unionByName(few).unionByName(low)


def normality_report(df: DataFrame, names: list[str], alpha: float = ALPHA) -> DataFrame:
    """Normality per column with the decision and a short note."""
    tested = normality(df, names)
    return tested.select(
        "feature",
        "n",
        "test",
        rnd(F.col("statistic"), 4).alias("statistic"),
        "p_value",
        (F.col("p_value") >= alpha).alias("normal"),
        F.when(F.col("test") == "n/a", "too few observations (n < 8)")
        .when(F.col("p_value") >= alpha, "fails to reject normality")
        .otherwise("departs from normality")
        .alias("note"),
    )
