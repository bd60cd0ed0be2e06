"""Principal components and k-means on standardised numeric columns."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import lloyd
from statloom.functions.exprs import SEED, name_col, number, rnd
from statloom.functions.roles import numeric_columns
from statloom.operators.preprocess import Preparation, fit_preparation


@dataclass(frozen=True)
class Matrix:
    """Standardised vectors next to the original columns."""

    df: DataFrame
    names: list[str]
    preparation: Preparation


def numeric_matrix(df: DataFrame, names: list[str] | None = None) -> Matrix:
    """Drop constant columns, fill medians, standardise; needs two columns that vary."""
    names = numeric_columns(df) if names is None else names
    spans = df.agg(*[(F.min(number(df, n)) < F.max(number(df, n))).alias(f"v{i}") for i, n in enumerate(names)]).first()
    varying = [n for i, n in enumerate(names) if spans[i]]
    if len(varying) < 2:
        raise ValueError("need at least 2 numeric columns with variance")
    preparation = fit_preparation(df, varying)
    return Matrix(preparation.transform(df), varying, preparation)


def spread_array(df: DataFrame, column: str, width: int, prefix: str) -> DataFrame:
    """Turn a fixed-width array column into one double column per position."""
    kept = [name_col(c) for c in df.columns if c != column]
    return df.select(*kept, *[name_col(column)[i].cast("double").alias(f"{prefix}{i}") for i in range(width)])


@dataclass(frozen=True)
class Components:
    variance: DataFrame
    loadings: DataFrame
    projection: DataFrame
    n_for_90pct: int


def run_pca(df: DataFrame, n_components: int | None = None, names: list[str] | None = None) -> Components:
    """Explained variance, loadings of the first two components, 2-D projection.

    The sign of a component is arbitrary; here its largest loading is positive.
    """
    matrix = numeric_matrix(df, names)
    spark, width = df.sparkSession, len(matrix.names)
    model = PCA(k=width, inputCol="features", outputCol="pc").fit(matrix.df.select("features"))
    share = model.explainedVariance.toArray()
    axes = model.pc.toArray()
    flip = np.sign(axes[np.abs(axes).argmax(axis=0), range(width)])
    axes = axes * np.where(flip == 0, 1.0, flip)
    total = np.cumsum(share)
    needed = int(np.searchsorted(total, 0.90) + 1)
    shown = n_components or width
    variance = spark.createDataFrame(
        [(i + 1, f"PC{i + 1}", float(share[i]), float(total[i])) for i in range(shown)],
        "position int, component string, explained_variance double, cumulative double",
    )
    variance = variance.select(
        "component", rnd(F.col("explained_variance"), 4).alias("explained_variance"), rnd(F.col("cumulative"), 4).alias("cumulative")
    )
    loadings = spark.createDataFrame(
        [(n, float(axes[i, 0]), float(axes[i, 1])) for i, n in enumerate(matrix.names)], "feature string, PC1 double, PC2 double"
    ).select("feature", rnd(F.col("PC1"), 4).alias("PC1"), rnd(F.col("PC2"), 4).alias("PC2"))
    return Components(variance, loadings, project(matrix, axes[:, :2]), needed)


def project(matrix: Matrix, axes: np.ndarray) -> DataFrame:
    """Add PC1 and PC2 as plain column expressions over the standardised values."""

    def scaled(n: str) -> Column:
        median, mean, sd = matrix.preparation.statistics[n]
        return (F.coalesce(number(matrix.df, n), F.lit(median)) - mean) / sd

    columns = {}
    for k in range(axes.shape[1]):
        terms = [scaled(n) * float(axes[i, k]) for i, n in enumerate(matrix.names)]
        columns[f"PC{k + 1}"] = sum(terms[1:], terms[0])
    return matrix.df.drop("features").withColumns(columns)


@dataclass(frozen=True)
class Clusters:
    k: int
    silhouette: float
    selection: DataFrame
    assignments: DataFrame
    profiles: DataFrame


def _model(vectors: DataFrame, centers: np.ndarray) -> KMeansModel:
    """MLlib's model with these centres."""
    sc = vectors.sparkSession.sparkContext
    parent = sc._jvm.org.apache.spark.mllib.clustering.KMeansModel(_py2java(sc, [Vectors.dense(c) for c in centers]))
    model = KMeansModel(sc._jvm.org.apache.spark.ml.clustering.KMeansModel(f"KMeans_{uuid.uuid4().hex[:12]}", parent))
    return model.setFeaturesCol("features").setPredictionCol("cluster")


def _fits(vectors: DataFrame, ks: list[int], starts: int) -> dict[int, lloyd.Fit]:
    """Per k the best of several seeded starts by training cost; all are fitted in the same passes."""
    fits = lloyd.fit_all(vectors, [(k, SEED + s) for k in ks for s in range(starts)])
    return {k: min((fits[k, SEED + s] for s in range(starts)), key=lambda fit: fit.cost) for k in ks}


def run_clustering(
    df: DataFrame,
    k: int | None = None,
    k_min: int = 2,
    k_max: int = 8,
    names: list[str] | None = None,
    starts: int = 10,
) -> Clusters:
    """K-means with the number of clusters chosen by silhouette.

    The silhouette uses squared Euclidean distance, which needs one pass and a point per
    cluster instead of all pairs of rows.
    """
    matrix = numeric_matrix(df, names)
    vectors = matrix.df.select("features").persist()
    arrays = vectors.select(vector_to_array("features").alias("x")).persist()
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")

    def quality(model: KMeansModel, sizes: np.ndarray) -> float:
        if np.count_nonzero(sizes) < 2:
            return 0.0
        return float(evaluator.evaluate(model.transform(vectors)))

    try:
        n = vectors.count()
        if n < 4:
            raise ValueError("need at least 4 rows to cluster")
        rows, best, best_quality = [], None, -1.0
        fits = _fits(arrays, [k] if k else list(range(k_min, min(k_max, n - 1) + 1)), starts)
        sizes = lloyd.cluster_sizes(arrays, [fit.centers for fit in fits.values()])
        for (kk, fit), own in zip(fits.items(), sizes):
            model = _model(vectors, fit.centers)
            q = quality(model, own)
            rows.append((kk, round(fit.cost, 2), round(q, 4)))
            if best is None or q > best_quality:
                best, best_quality, best_k = model, q, kk
    finally:
        arrays.unpersist()
        vectors.unpersist()
    assigned = best.transform(matrix.df).drop("features")
    selection = df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")
    return Clusters(best_k, round(best_quality, 4), selection, assigned, cluster_profiles(assigned, matrix.names))


def cluster_profiles(assigned: DataFrame, names: list[str], cluster: str = "cluster") -> DataFrame:
    """Size and column means per cluster in original units."""
    return assigned.groupBy(cluster).agg(
        F.count("*").alias("size"), *[rnd(F.avg(number(assigned, n)), 2).alias(n) for n in names]
    )


def embedding_columns(df: DataFrame, column: str, width: int, prefix: str = "e") -> DataFrame:
    """Embedding (array or vector) to numeric columns."""
    if df.schema[column].dataType.typeName() == "array":
        return spread_array(df, column, width, prefix)
    return spread_array(df.withColumn(column, vector_to_array(column)), column, width, prefix)
