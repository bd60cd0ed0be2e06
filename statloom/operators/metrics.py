"""Scores of classifications and regressions, computed from counts and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import name_col, ratio, rnd, with_scalars
from statloom.functions.prefix import prefix_sums
from statloom.session import settle

MACHINE_EPSILON = 2.220446049250313e-16


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, count)``; a cell per pair that occurs."""
    return (
        df.select(name_col(label).cast("string").alias("label"), name_col(prediction).cast("string").alias("prediction"))
        .groupBy("label", "prediction")
        .agg(F.count("*").alias("count"))
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: list[str] | None = None) -> DataFrame:
    """Rows are true labels, one column per predicted label, zeros filled in."""
    cells = confusion_counts(df, label, prediction)
    if labels is None:
        labels = [r[0] for r in cells.select("label").distinct().orderBy("label").collect()]  # one per class
    wide = cells.groupBy("label").pivot("prediction", labels).agg(F.sum("count"))
    return wide.na.fill(0)


def classification_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """One row: accuracy, support-weighted precision / recall / F1, Matthews coefficient."""
    cells = confusion_counts(df, label, prediction)
    as_class = F.explode(
        F.array(
            F.struct(F.col("label").alias("k"), F.col("count").alias("t"), F.lit(0).cast("long").alias("p")),
            F.struct(F.col("prediction").alias("k"), F.lit(0).cast("long").alias("t"), F.col("count").alias("p")),
        )
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    # every cell feeds its true class and its predicted class; a hit counts once
    per_class = (
        cells.select(as_class.alias("c"), hit.alias("hit"))
        .groupBy("c.k")
        .agg(F.sum("c.t").alias("t"), F.sum("c.p").alias("p"), F.sum(F.when(F.col("c.t") > 0, F.col("hit")).otherwise(0)).alias("tp"))
    )
    t, p, tp = F.col("t").cast("double"), F.col("p").cast("double"), F.col("tp").cast("double")
    precision, recall = F.coalesce(ratio(tp, p), F.lit(0.0)), F.coalesce(ratio(tp, t), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    n, c = F.sum(t), F.sum(tp)
    mcc_den = F.sqrt((n * n - F.sum(p * p)) * (n * n - F.sum(t * t)))
    agg = per_class.agg(
        (c / n).alias("accuracy"),
        (F.sum(precision * t) / n).alias("precision"),
        (F.sum(recall * t) / n).alias("recall"),
        (F.sum(f1 * t) / n).alias("f1"),
        F.coalesce(F.try_divide(c * n - F.sum(p * t), mcc_den), F.lit(0.0)).alias("mcc"),
    )
    return agg.select(*[rnd(F.col(m), digits).alias(m) for m in agg.columns], rnd(F.col("f1"), digits).alias("f1_weighted"))


def score_counts(df: DataFrame, positive: Column, score: Column, keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Positives and negatives per distinct score with running totals, and the totals.

    The data is read once: everything after works on the stored counts per score.
    """
    keys = list(keys)
    rows = df.select(
        *[name_col(k) for k in keys], score.cast("double").alias("score"), positive.cast("int").alias("pos")
    )
    counts = settle(
        rows.groupBy(*keys, "score").agg(
            F.sum("pos").cast("double").alias("pos"), F.sum(1 - F.col("pos")).cast("double").alias("neg")
        ),
        "scores",
    )
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return prefix_sums(counts, "score", ["pos", "neg"], keys), totals


def ranking_metrics(df: DataFrame, positive: Column, score: Column, keys: list[str] = ()) -> DataFrame:
    """Exact ROC-AUC and average precision from the distinct scores."""
    s, totals = score_counts(df, positive, score, keys)
    joined = s.join(totals, list(keys)) if keys else s.transform(with_scalars, totals)
    neg_below = F.col("neg_upto") - F.col("neg")
    tp = F.col("P") - F.col("pos_upto") + F.col("pos")
    fp = F.col("N") - F.col("neg_upto") + F.col("neg")
    area = F.sum(F.col("pos") * (neg_below + F.col("neg") / 2))
    precision = F.sum(F.col("pos") * tp / (tp + fp))
    return joined.groupBy(*keys, "P", "N").agg(area.alias("a"), precision.alias("ap")).select(
        *keys,
        F.try_divide(F.col("a"), F.col("P") * F.col("N")).alias("roc_auc"),
        F.try_divide(F.col("ap"), F.col("P")).alias("pr_auc"),
        F.col("P").alias("support"),
    )


def class_scores(df: DataFrame, label: str, vector: str, labels: list[str]) -> DataFrame:
    """Long form ``(class, positive, score)`` of a per-class score vector."""
    from pyspark.ml.functions import vector_to_array

    scores = vector_to_array(name_col(vector))
    cells = [
        F.struct(F.lit(k).alias("class"), (name_col(label).cast("string") == k).alias("positive"), scores[i].alias("score"))
        for i, k in enumerate(labels)
    ]
    return df.select(F.inline(F.array(*cells)))


def weighted_ovr_auc(df: DataFrame, label: str, vector: str, labels: list[str]) -> DataFrame:
    """Support-weighted one-vs-rest ROC-AUC; NULL when a class is absent."""
    long = class_scores(df, label, vector, labels)
    per_class = ranking_metrics(long, F.col("positive"), F.col("score"), ["class"])
    complete = F.count("roc_auc") == len(labels)
    return per_class.agg(
        F.when(complete, F.sum(F.col("roc_auc") * F.col("support")) / F.sum("support")).alias("roc_auc")
    )


def curve_points(df: DataFrame, positive: Column, score: Column, keys: list[str] = ()) -> DataFrame:
    """ROC and precision-recall points, one per distinct score plus the empty start."""
    s, totals = score_counts(df, positive, score, keys)
    joined = s.join(totals, list(keys)) if keys else s.transform(with_scalars, totals)
    tp = F.col("P") - F.col("pos_upto") + F.col("pos")
    fp = F.col("N") - F.col("neg_upto") + F.col("neg")
    points = joined.select(
        *keys,
        F.col("score").alias("threshold"),
        F.try_divide(fp, F.col("N")).alias("fpr"),
        F.try_divide(tp, F.col("P")).alias("tpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, F.col("P")).alias("recall"),
    )
    start = totals.select(
        *keys,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(start)


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """One row: R squared, RMSE, MAE and MAPE (denominators kept above zero)."""
    y, p = name_col(label).cast("double"), name_col(prediction).cast("double")
    e = y - p
    total = F.var_pop(y) * F.count(y)
    agg = df.agg(
        F.when(total > 0, 1 - F.sum(e * e) / total).otherwise(F.when(F.sum(e * e) == 0, 1.0).otherwise(0.0)).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(MACHINE_EPSILON))).alias("mape"),
    )
    return agg.select(*[rnd(F.col(m), digits).alias(m) for m in agg.columns])
