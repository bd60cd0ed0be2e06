"""Many k-means fits at a time: MLlib's results, in a number of jobs that doesn't grow with the fits."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from statloom.functions import lloyd
from statloom.operators import unsupervised


def _points(spark, n, width, parts):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, width)).round(2) + 2 * rng.integers(0, 4, (n, 1))
    return spark.createDataFrame(spark.sparkContext.parallelize([([float(v) for v in r],) for r in x], parts), "x array<double>")


@pytest.mark.parametrize("n, width, parts", [(7, 2, 2), (900, 3, 3), (600, 12, 2)])
def test_fits_are_those_of_mllib(spark, n, width, parts):
    points = _points(spark, n, width, parts).persist()
    vectors = points.select(array_to_vector("x").alias("features")).persist()
    jobs = [(2, 42), (4, 42), (4, 43)]
    for (k, seed), fit in lloyd.fit_all(points, jobs).items():
        model = KMeans(k=k, seed=seed).fit(vectors)
        assert np.allclose(model.clusterCenters(), fit.centers)
        assert model.summary.trainingCost == pytest.approx(fit.cost)


def test_few_distinct_points_leave_fewer_centres(spark):
    points = spark.createDataFrame([([float(i % 2), 1.0],) for i in range(40)], "x array<double>").coalesce(1).persist()
    fit = lloyd.fit_all(points, [(5, 42)])[5, 42]
    assert sorted(map(tuple, fit.centers)) == [(0.0, 1.0), (1.0, 1.0)] and fit.cost == 0
    assert [int(n) for n in lloyd.cluster_sizes(points, [fit.centers])[0]] == [20, 20]


def test_infinite_vectors_are_refused(spark):
    with pytest.raises(ValueError):
        lloyd.fit_all(spark.createDataFrame([([1.0, float("inf")],), ([0.0, 1.0],)], "x array<double>"), [(2, 1)])


def test_jobs_do_not_grow_with_the_fits(spark):
    df = unsupervised.spread_array(_points(spark, 300, 2, 2), "x", 2, "e")

    def jobs(starts: int) -> int:
        spark.sparkContext.setJobGroup(f"starts-{starts}", "")
        try:
            unsupervised.run_clustering(df, k_max=3, starts=starts)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"starts-{starts}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(10) < 2 * jobs(2)
