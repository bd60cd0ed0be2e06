"""Feature ranking and the effect of selecting or adding features."""

from __future__ import annotations

from typing import Any

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions import tails
from statloom.functions.exprs import name_col, number, present, rnd, with_scalars
from statloom.functions.quantiles import column_quantiles
from statloom.functions.roles import numeric_columns
from statloom.operators import models
from statloom.operators.cleaning import interaction, text_modes
from statloom.operators.inference import group_stats, mean_tests
from statloom.operators.models import Problem, cross_validate, fold_count, frame_problem
from statloom.operators.preprocess import fit_preparation


def _imputed(problem: Problem) -> tuple[DataFrame, list[str], list[str]]:
    """Numbers with medians and levels with modes filled in, plus the target."""
    df = problem.data
    nums = [c for c in problem.features if c in numeric_columns(df)]
    cats = [c for c in problem.features if c not in nums]
    medians = column_quantiles(df, nums, [0.5])
    text = df.select(*[present(df, c).cast("string").alias(c) for c in cats]) if cats else None
    modes = text_modes(text, cats) if cats else {}
    cats = [c for c in cats if c in modes]
    cells = [F.coalesce(number(df, c), F.lit(medians[c][0] or 0.0)).alias(c) for c in nums]
    cells += [F.coalesce(present(df, c).cast("string"), F.lit(modes[c])).alias(c) for c in cats]
    return df.select(*cells, name_col(problem.target).alias("_y")), nums, cats


def _long(df: DataFrame, names: list[str], keep: str) -> DataFrame:
    cells = [F.struct(F.lit(n).alias("feature"), name_col(n).alias("value")) for n in names]
    return df.select(F.col(keep), F.inline(F.array(*cells)))


def f_scores(problem: Problem) -> DataFrame:
    """``(feature, slot, f_score, f_pvalue)`` for every number and every level.

    Levels are 0/1 indicators, whose group means and variances follow from counts, so no
    one-hot matrix is built: one group-by for the numbers and one for the levels.
    """
    df, nums, cats = _imputed(problem)
    parts = []
    if problem.task == "classification":
        df = df.withColumn("_y", F.col("_y").cast("string"))
        if nums:
            stats = group_stats(_long(df, nums, "_y"), ["feature", "_y"], "value")
            tested = mean_tests(stats, ["feature"], "_y", min_size=1, always_f=True)
            parts.append(tested.select("feature", F.col("feature").alias("slot"), F.col("statistic").alias("f_score"), F.col("p_value").alias("f_pvalue")))
        if cats:
            classes = df.groupBy("_y").agg(F.count("*").alias("n"))
            sizes = classes.agg(F.count("*").alias("k"), F.sum("n").alias("total"))
            cells = _long(df, cats, "_y").groupBy("feature", "value", "_y").agg(F.count("*").alias("c"))
            # a row per class, and more classes than max_classes have been refused
            counted = cells.join(F.broadcast(classes), "_y")
            # a class that a level never meets adds nothing to its sums
            c, n = F.col("c"), F.col("n")
            sums = counted.groupBy("feature", F.concat_ws("_", "feature", "value").alias("slot")).agg(
                F.sum("c").alias("s"), F.sum(c * c / n).alias("ss"), F.sum(c * (1 - c / n)).alias("ssw")
            )
            stats = sums.transform(with_scalars, sizes)  # one row
            tested = _level_tests(stats)
            parts.append(tested)
    else:
        y = F.col("_y").cast("double")
        n = F.col("n")
        r2_to_f = lambda r2: F.when(r2 >= 1, float("inf")).otherwise(r2 * (n - 2) / (1 - r2))
        if nums:
            long = _long(df.withColumn("_y", y), nums, "_y")
            r = long.groupBy("feature").agg(F.corr("value", "_y").alias("r"), F.count("*").alias("n"))
            parts.append(r.select("feature", F.col("feature").alias("slot"), r2_to_f(F.col("r") ** 2).alias("f_score"), n))
        if cats:
            whole = df.agg(F.avg(y).alias("my"), F.stddev_pop(y).alias("sy"), F.count("*").alias("n"))
            levels = _long(df.withColumn("_y", y), cats, "_y").groupBy("feature", "value").agg(
                F.count("*").alias("k"), F.avg("_y").alias("m")
            )
            joined = levels.transform(with_scalars, whole)  # one row
            p = F.col("k") / n
            r = F.try_divide(p * (F.col("m") - F.col("my")), F.sqrt(p * (1 - p)) * F.col("sy"))
            parts.append(
                joined.select("feature", F.concat_ws("_", "feature", "value").alias("slot"), r2_to_f(r * r).alias("f_score"), n)
            )
        parts = [
            q.select("feature", "slot", "f_score", tails.f_upper(F.col("f_score"), F.lit(1.0), n - 2.0).alias("f_pvalue"))
            for q in parts
        ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _level_tests(stats: DataFrame) -> DataFrame:
    """ANOVA per level from its sums: rows, squared rows by class size, and variation inside classes."""
    ssb = F.col("ss") - F.col("s") ** 2 / F.col("total")
    d1, d2 = F.col("k") - 1.0, (F.col("total") - F.col("k")).cast("double")
    f = F.when(F.col("ssw") > 0, (ssb / d1) / (F.col("ssw") / d2)).when(ssb > 0, float("inf"))
    return stats.withColumn("f_score", f).select(
        "feature", "slot", "f_score", tails.f_upper(F.col("f_score"), d1, d2).alias("f_pvalue")
    )


def elimination_ranks(problem: Problem) -> DataFrame:
    """Recursive elimination down to half the slots: rank 1 is kept, higher fell earlier.

    Each round refits a linear model on cached vectors and drops the smallest coefficient.
    """
    preparation = fit_preparation(problem.data, problem.features)
    ready = models._labelled(problem, preparation.transform(problem.data), {})
    columns = ["features", "_label"] + (["_weight"] if problem.task == "classification" else [])
    ready = ready.select(*columns).withColumnRenamed("features", "_all").persist()
    name = "Logistic Regression" if problem.task == "classification" else "Linear Regression"
    alive = list(range(preparation.width))
    keep = max(1, len(alive) // 2)
    fallen: list[int] = []
    try:
        rows = float(ready.count())
        while len(alive) > keep:
            sliced = VectorSlicer(inputCol="_all", outputCol="features", indices=alive).transform(ready)
            fitted = models.make_estimator(name, problem.task, len(problem.labels), {}, rows).fit(sliced)
            if problem.task == "classification":
                weight = (fitted.coefficientMatrix.toArray() ** 2).sum(axis=0)
            else:
                weight = fitted.coefficients.toArray() ** 2
            fallen.append(alive.pop(int(weight.argmin())))
    finally:
        ready.unpersist()
    rank = {i: 1 for i in alive}
    rank.update({i: len(fallen) - k + 1 for k, i in enumerate(fallen)})
    rows = [(preparation.slots[i], preparation.owners[i], r) for i, r in sorted(rank.items())]
    return problem.data.sparkSession.createDataFrame(rows, "slot string, feature string, rfe_rank int")


def feature_ranking(df: DataFrame, target: str) -> DataFrame:
    """One row per source feature: best F score, its p-value, best elimination rank."""
    problem = frame_problem(df, target)
    scores = f_scores(problem).groupBy("feature").agg(F.max("f_score").alias("f_score"), F.min("f_pvalue").alias("f_pvalue"))
    ranks = elimination_ranks(problem).groupBy("feature").agg(F.min("rfe_rank").alias("rfe_rank"))
    return (
        scores.join(F.broadcast(ranks), "feature", "left")  # one row per feature
        .select("feature", rnd(F.col("f_score"), 3).alias("f_score"), rnd(F.col("f_pvalue"), 5).alias("f_pvalue"), "rfe_rank")
        .orderBy(F.col("f_score").desc_nulls_last(), "feature")
    )


def _cv(problem: Problem, features: list[str], settings: dict[str, Any] | None) -> float:
    folds = fold_count(problem, problem.data)
    scores = cross_validate(problem, problem.data, [("Random Forest", settings or {})], folds, features=features)
    return models._mean([s for s, _ in scores[0]])


def _ranked_features(problem: Problem) -> list[str]:
    scores = f_scores(problem).groupBy("feature").agg(F.max("f_score").alias("f"))
    ordered = scores.orderBy(F.col("f").desc_nulls_last(), "feature").collect()  # one row per feature
    return [r["feature"] for r in ordered]


def selection_impact(df: DataFrame, target: str, k: int | None = None, settings: dict[str, Any] | None = None) -> dict[str, Any]:
    """Cross-validated forest on all features against the ``k`` best by F score."""
    problem = frame_problem(df, target)
    ranked = _ranked_features(problem)
    k = k or max(1, len(ranked) // 2)
    everything, best = _cv(problem, problem.features, settings), _cv(problem, ranked[:k], settings)
    return {
        "scoring": "f1_weighted" if problem.task == "classification" else "r2",
        "n_features_total": len(ranked),
        "k": k,
        "top_features": ranked[:k],
        "all_features_cv": round(everything, 4),
        "topk_cv": round(best, 4),
        "delta": round(best - everything, 4),
    }


def engineered_interaction(df: DataFrame, target: str, settings: dict[str, Any] | None = None) -> dict[str, Any]:
    """Cross-validated forest with and without the product of the two strongest numbers."""
    problem = frame_problem(df, target)
    nums = [f for f in _ranked_features(problem) if f in numeric_columns(df)]
    if len(nums) < 2:
        return {"available": False, "note": "need >= 2 numeric features for an interaction"}
    a, b = nums[:2]
    richer = Problem(
        interaction(problem.data, a, b), target, [*problem.features, f"{a}_x_{b}"], problem.dropped, problem.task, problem.labels, problem.rows
    )
    before, after = _cv(problem, problem.features, settings), _cv(richer, richer.features, settings)
    return {
        "available": True,
        "scoring": "f1_weighted" if problem.task == "classification" else "r2",
        "interaction": f"{a}_x_{b}",
        "baseline_cv": round(before, 4),
        "with_interaction_cv": round(after, 4),
        "delta": round(after - before, 4),
    }
