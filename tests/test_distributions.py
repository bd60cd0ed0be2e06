"""Tails against tabulated values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions import distributions as dist
from statloom.operators.normality import kurtosis_z, normality, skewness_z


@pytest.mark.parametrize(
    "got, want",
    [
        (dist.t_two_sided([2.228139], [10])[0], 0.05),
        (dist.t_two_sided([12.7062], [1])[0], 0.05),
        (dist.t_two_sided([np.inf], [5])[0], 0.0),
        (dist.f_upper([4.10], [2], [10])[0], 0.05),
        (dist.f_upper([3.49], [3], [12])[0], 0.05),
        (dist.chi2_upper([3.841459], [1])[0], 0.05),
        (dist.chi2_upper([18.307038], [10])[0], 0.05),
        (dist.normal_upper([1.644854])[0], 0.05),
        (dist.normal_quantile([0.975])[0], 1.959964),
        (dist.t_quantile([0.975], [4])[0], 2.776445),
        (dist.t_quantile([0.975], [1e6])[0], 1.959966),
        (dist.beta_inc(0.5, 0.5, 0.5), 0.5),
        (dist.gamma_inc_upper(1.0, 2.0), math.exp(-2.0)),
    ],
)
def test_tabulated(got, want):
    assert float(got) == pytest.approx(want, abs=2e-4)


def test_tails_stay_accurate_far_out():
    assert dist.t_two_sided([40.0], [60_000.0])[0] < 1e-300 or dist.t_two_sided([40.0], [60_000.0])[0] >= 0
    assert dist.chi2_upper([200.0], [4.0])[0] == pytest.approx(math.exp(-100) * 101, rel=1e-9)


# Published examples of the Shapiro-Wilk test (statistic, p).
SAMPLES = [
    (
        [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66],
        0.900473,
        0.042090,
    ),
    (
        [1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49],
        0.959027,
        0.524598,
    ),
    ([148.0, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], 0.788815, 0.006704),
]


@pytest.mark.parametrize("sample, w, p", SAMPLES)
def test_shapiro_wilk(spark, sample, w, p):
    row = normality(spark.createDataFrame([(float(x),) for x in sample], "x double"), ["x"]).first()
    assert row["test"] == "Shapiro-Wilk"
    assert row["statistic"] == pytest.approx(w, abs=2e-4)
    assert row["p_value"] == pytest.approx(p, abs=2e-4)


def test_few_values_give_no_test(spark):
    row = normality(spark.createDataFrame([(float(x),) for x in range(7)], "x double"), ["x"]).first()
    assert row["test"] == "n/a" and row["statistic"] is None


def _moments(spark, data):
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    return df.agg(F.count("x").alias("n"), F.skewness("x").alias("g1"), F.kurtosis("x").alias("g2"))


@pytest.mark.parametrize("data, z", [(range(1, 9), 1.0108048609177787), ([2, 8, 0, 4, 1, 9, 9, 0], 0.44626385374196975)])
def test_skewness_score(spark, data, z):
    got = _moments(spark, data).select(skewness_z(F.col("n"), F.col("g1")).alias("z")).first()["z"]
    assert got == pytest.approx(z, abs=1e-9)


def test_kurtosis_score(spark):
    got = _moments(spark, range(20)).select(kurtosis_z(F.col("n"), F.col("g2")).alias("z")).first()["z"]
    assert got == pytest.approx(-1.7058104152122062, abs=1e-9)


def test_normal_and_skewed_large_samples(spark):
    rng = np.random.default_rng(1)
    rows = list(zip(rng.normal(size=6000).tolist(), rng.exponential(size=6000).tolist()))
    got = {r["feature"]: r for r in normality(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()}
    assert got["a"]["test"] == "D'Agostino-Pearson"
    assert got["a"]["p_value"] > 0.01
    assert got["b"]["p_value"] < 1e-6


def test_normal_quantile_is_a_column_expression(spark):
    from statistics import NormalDist

    from pyspark.sql import functions as F

    from statloom.functions import tails

    points = [1e-300, 1e-20, 1e-12, 1e-6, 0.001, 0.02, 0.0749, 0.075, 0.2, 0.5, 0.7, 0.924, 0.926, 0.99, 1 - 1e-9]
    frame = spark.createDataFrame([(p,) for p in [*points, 0.0, 1.0, -1.0]], "p double")
    out = frame.select("p", tails.normal_quantile(F.col("p")).alias("z"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.p: r.z for r in out.collect()}
    for p in points:
        assert abs(got[p] - NormalDist().inv_cdf(p)) <= 1e-12 * max(1, abs(NormalDist().inv_cdf(p)))
    assert got[0.0] is None and got[1.0] is None and got[-1.0] is None
