"""Curves, tuning and learning curves for trained models."""

from __future__ import annotations

from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import SEED, name_col, rnd
from statloom.operators import metrics, models
from statloom.operators.models import cross_validate, fit_model, fold_count, frame_problem
from statloom.operators.preprocess import fit_preparation, split, unit_hash, with_folds

OVERFIT_GAP = 0.1

# The settings tried for every model.
GRIDS: dict[str, dict[str, list[Any]]] = {
    "Logistic Regression": {"C": [0.1, 1.0, 10.0]},
    "Random Forest": {"trees": [100, 200], "depth": [None, 5, 10]},
    "Gradient Boosting": {"rate": [0.05, 0.1], "trees": [100, 200], "depth": [2, 3]},
}


def roc_pr_curves(
    df: DataFrame, target: str, model: str, settings: dict[str, Any] | None = None, classes: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(points, areas) on the held-out rows; one curve per class, two classes share one.

    All classes are drawn unless ``classes`` names some.
    """
    problem = frame_problem(df, target)
    if problem.task != "classification":
        raise ValueError("curves need a classification target")
    train, test = split(problem.data, target)
    predicted = fit_model(problem, train, model, settings=settings).predict(test)
    long = metrics.class_scores(predicted, target, "scores", problem.labels)
    wanted = classes or (problem.labels[1:] if len(problem.labels) == 2 else problem.labels)
    long = long.filter(F.col("class").isin(wanted))
    areas = metrics.ranking_metrics(long, F.col("positive"), F.col("score"), ["class"]).filter("support > 0")
    points = metrics.curve_points(long, F.col("positive"), F.col("score"), ["class"])
    points = points.select("class", "threshold", *[rnd(F.col(c), 4).alias(c) for c in ("fpr", "tpr", "precision", "recall")])
    return points, areas.select("class", rnd(F.col("roc_auc"), 4).alias("auc"), rnd(F.col("pr_auc"), 4).alias("ap"))


def tune(
    df: DataFrame, target: str, model: str, grid: dict[str, list[Any]] | None = None, base: dict[str, Any] | None = None
) -> dict[str, Any]:
    """Grid search by cross-validation against the default settings.

    All combinations share the folds and each fold's preparation.
    """
    problem = frame_problem(df, target)
    scoring = "f1_weighted" if problem.task == "classification" else "r2"
    grid = GRIDS.get(model) if grid is None else grid
    if not grid:
        return {"model": model, "tunable": False, "scoring": scoring}
    combos = [{**(base or {}), **dict(zip(grid, values))} for values in product(*grid.values())]
    train, _ = split(problem.data, target if problem.task == "classification" else None)
    folds = fold_count(problem, train)
    cv = cross_validate(problem, train, [(model, base or {})] + [(model, c) for c in combos], folds)
    means = [models._mean([s for s, _ in cv[i]]) for i in range(len(cv))]
    best = max(range(1, len(means)), key=lambda i: means[i])
    return {
        "model": model,
        "tunable": True,
        "scoring": scoring,
        "default_cv": round(means[0], 4),
        "tuned_cv": round(means[best], 4),
        "improvement": round(means[best] - means[0], 4),
        "best_params": combos[best - 1],
        "n_combinations": len(combos),
    }


def learning_curve(
    df: DataFrame, target: str, model: str, settings: dict[str, Any] | None = None, steps: int = 5
) -> DataFrame:
    """Training and held-out score for nested samples of 20 % to 100 % of every fold's rows."""
    problem = frame_problem(df, target)
    by = target if problem.task == "classification" else None
    folds = fold_count(problem, problem.data)
    tagged = with_folds(problem.data, folds, by).withColumn("_order", unit_hash(problem.data.columns, SEED + 7)).persist()
    shares = [0.2 + 0.8 * i / (steps - 1) for i in range(steps)]

    def trial(job: tuple[float, int]) -> tuple[int, float, float]:
        share, k = job
        # the order is a hash, so smaller samples are subsets of larger ones
        inside = tagged.filter((F.col("fold") != k) & (F.col("_order") <= share))
        fitted = fit_model(problem, inside, model, fit_preparation(inside, problem.features), settings)
        own = models.score(problem, fitted.predict(inside))
        return inside.count(), own, models.score(problem, fitted.predict(tagged.filter(F.col("fold") == k)))

    jobs = [(share, k) for share in shares for k in range(folds)]
    try:
        with ThreadPool(max(1, min(models.PARALLEL_FITS, len(jobs)))) as pool:
            found = pool.map(inheritable_thread_target(df.sparkSession)(trial), jobs, chunksize=1)
    finally:
        tagged.unpersist()
    rows = []
    for i in range(steps):
        sizes, own, held = zip(*found[i * folds : (i + 1) * folds])
        rows.append((sum(sizes) // folds, round(models._mean(own), 4), round(models._mean(held), 4)))
    return df.sparkSession.createDataFrame(rows, "train_size long, train_score double, cv_score double")


def overfit_check(curve: DataFrame) -> DataFrame:
    """Gap between training and held-out score at the largest size, with a flag."""
    last = curve.agg(F.max_by(F.struct("train_score", "cv_score"), "train_size").alias("s"))
    gap = F.col("s.train_score") - F.col("s.cv_score")
    return last.select(rnd(gap, 4).alias("gap"), (gap > OVERFIT_GAP).alias("overfit"))


def prediction_table(df: DataFrame, target: str, model: str, settings: dict[str, Any] | None = None) -> DataFrame:
    """Held-out rows with their predictions."""
    problem = frame_problem(df, target)
    train, test = split(problem.data, target if problem.task == "classification" else None)
    fitted = fit_model(problem, train, model, settings=settings)
    return fitted.predict(test).select(*[name_col(c) for c in problem.data.columns], "prediction")
