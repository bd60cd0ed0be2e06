"""How training rows are laid out for fits: few rows in few tasks, many rows in equal ones."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from statloom.operators import models
from statloom.plans import bundles


@pytest.fixture(scope="module")
def ready(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 2))
    rows = [([float(a), float(b)], float(a + b > 0), 1.0) for a, b in x]
    df = spark.createDataFrame(rows, "x array<double>, _label double, _weight double")
    return df.select(array_to_vector("x").alias("features"), "_label", "_weight")


def _sizes(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]


def test_few_rows_are_one_task(ready):
    spread = ready.repartition(8)
    assert _sizes(models._dealt(spread, "Gradient Boosting", 600)) == [600]
    assert _sizes(models._dealt(spread, "Logistic Regression", 600)) == [600]
    assert len(_sizes(models._dealt(spread, "Random Forest", 600))) == 8  # its bootstrap stays as it is


def test_many_rows_in_one_partition_are_dealt_out(ready, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    for name in ("Random Forest", "Gradient Boosting"):
        sizes = _sizes(models._dealt(ready.coalesce(1), name, 600))
        assert sum(sizes) == 600 and len(sizes) > 1 and max(sizes) < 400


def test_boosting_does_not_depend_on_the_layout(ready):
    booster = models.make_estimator("Gradient Boosting", "classification", 2, {"trees": 5}, 600.0)
    one = booster.fit(models._dealt(ready.repartition(8), "Gradient Boosting", 600))
    other = booster.fit(ready.repartition(8))
    leaves = lambda m: [m.predict(r["features"]) for r in ready.collect()]
    assert leaves(one) == leaves(other) and one.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray())


def test_fits_side_by_side():
    assert models.side_by_side(20_000) == models.PARALLEL_FITS and models.side_by_side(960_000) == 1
    assert models.side_by_side(20_000, 3) == 3


@pytest.fixture
def watched(monkeypatch):
    """Partitions of every table that an estimator is fitted on."""
    seen, plain = [], models.make_estimator

    class Watched:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return self.estimator.fit(df)

    monkeypatch.setattr(models, "make_estimator", lambda *a: Watched(plain(*a)))
    return seen


def _rows(spark):
    return spark.range(400).select(*[F.rand(i).alias(f"x{i}") for i in range(2)], (F.col("id") % 2).alias("y")).repartition(8)


def test_a_boosters_levels_run_in_one_task(spark, watched):
    problem = models.frame_problem(_rows(spark), "y")
    models.fit_model(problem, problem.data, "Gradient Boosting", settings={"trees": 2})
    assert watched == [1]


def test_an_analysis_trains_boosters_in_one_task(spark, watched):
    name = "Gradient Boosting"
    found = bundles.analyze(_rows(spark), "y", models=[name], settings={name: {"trees": 2}}, cv_folds=2)
    assert "leaderboard" in found and watched == [1, 1, 1]
