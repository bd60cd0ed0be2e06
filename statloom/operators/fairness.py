"""Group fairness of predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import name_col, rnd, stack_rows, with_scalars
from statloom.operators.profile import distinct_counts
from statloom.session import settle

MIN_GROUP = 5
MAX_GROUPS = 10

# Name fragments of sensitive columns, and the limits of the criteria.
SENSITIVE_WORDS = [
    "sex",
    "gender",
    "race",
    "ethnicity",
    "age_group",
    "age_cat",
    "nationality",
    "religion",
    "marital",
    "education_level",
    "income_group",
]
GAP_LIMIT = 0.10
IMPACT_LIMIT = 0.80


def detect_sensitive_columns(df: DataFrame, words: list[str] = SENSITIVE_WORDS) -> list[str]:
    """Columns named like a protected attribute with at most ten values."""
    named = [c for c in df.columns if any(w in c.lower() for w in words)]
    if not named:
        return []
    row = distinct_counts(df, {f"d{i}": name_col(c) for i, c in enumerate(named)}).first()
    return [c for i, c in enumerate(named) if row[i] <= MAX_GROUPS]


def class_imbalance_report(df: DataFrame, target: str) -> DataFrame:
    """One row: classes, majority, minority, ratio and severity (ties by label)."""
    counts = (
        df.filter(name_col(target).isNotNull()).groupBy(name_col(target).cast("string").alias("y")).agg(F.count("*").alias("n"))
    )
    big = F.struct((-F.col("n")).alias("n"), "y")
    agg = counts.agg(
        F.count("*").alias("n_classes"),
        F.min_by("y", big).alias("majority_class"),
        F.max_by("y", big).alias("minority_class"),
        F.max("n").alias("majority_count"),
        F.min("n").alias("minority_count"),
    )
    one = F.col("n_classes") < 2
    ratio = rnd(F.col("majority_count") / F.col("minority_count"), 2)
    return agg.select(
        "*",
        F.when(~one, ratio).alias("imbalance_ratio"),
        F.when(one, "single class").when(ratio < 1.5, "balanced").when(ratio < 3, "moderate").otherwise("severe").alias("severity"),
        (one | (ratio < 1.5)).alias("balanced"),
    )


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def group_metrics(df: DataFrame, label: str, prediction: str, group: str, positive="1") -> DataFrame:
    """Selection rate, accuracy, TPR, FPR, precision, F1, disparate impact per group.

    Rates that need both classes are NULL in groups holding only one; groups below five
    rows are left out. Counts combine map-side, one row per group leaves each task.
    """
    y = name_col(label).cast("string") == F.lit(str(positive))
    p = name_col(prediction).cast("string") == F.lit(str(positive))
    rows = df.select(name_col(group).cast("string").alias("group"), name_col(label).cast("string").alias("l"), y.alias("y"), p.alias("p"),
                     (name_col(label).cast("string") == name_col(prediction).cast("string")).alias("ok"))
    tallied = rows.groupBy("group").agg(
        F.count("*").alias("n"),
        F.count_if("p").alias("selected"),
        F.count_if("ok").alias("correct"),
        F.count_if(F.col("y") & F.col("p")).alias("tp"),
        F.count_if(F.col("y") & ~F.col("p")).alias("fn"),
        F.count_if(~F.col("y") & F.col("p")).alias("fp"),
        F.count_if(~F.col("y") & ~F.col("p")).alias("tn"),
    )
    counts = settle(tallied, "groups")  # a row per group: the data is read once
    overall = counts.agg((F.sum("selected") / F.sum("n")).alias("overall"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    both = (tp + fn > 0) & (fp + tn > 0)
    rate = F.col("selected") / F.col("n")
    return (
        counts.filter((F.col("n") >= MIN_GROUP) & F.col("group").isNotNull())
        .transform(with_scalars, overall)  # one row
        .select(
            "group",
            "n",
            rnd(rate, 4).alias("selection_rate"),
            rnd(F.col("correct") / F.col("n"), 4).alias("accuracy"),
            F.when(both, rnd(_or_zero(tp, tp + fn), 4)).alias("tpr_recall"),
            F.when(both, rnd(_or_zero(fp, fp + tn), 4)).alias("fpr"),
            F.when(both, rnd(_or_zero(tp, tp + fp), 4)).alias("precision"),
            F.when(both, rnd(_or_zero(2 * tp, 2 * tp + fp + fn), 4)).alias("f1"),
            F.when(F.col("overall") > 0, rnd(rate / F.col("overall"), 4)).alias("disparate_impact"),
        )
    )


def fairness_verdict(groups: DataFrame) -> DataFrame:
    """One row per criterion that can be judged: value, limit and whether it passes."""
    agg = groups.agg(
        *[
            e.alias(f"{k}_{c}")
            for c in ("selection_rate", "tpr_recall", "precision", "disparate_impact")
            for k, e in (("n", F.count(c)), ("gap", F.max(c) - F.min(c)), ("low", F.min(c)))
        ]
    )

    def gap(name: str, metric: str, column: str) -> list[Column]:
        v = F.when(F.col(f"n_{column}") >= 2, F.col(f"gap_{column}"))
        return [F.lit(name), F.lit(metric), rnd(v, 4), F.lit(GAP_LIMIT), rnd(v, 9) <= GAP_LIMIT]

    low = F.when(F.col("n_disparate_impact") >= 1, F.col("low_disparate_impact"))
    rows = [
        gap("demographic_parity", "Selection rate gap", "selection_rate"),
        [F.lit("disparate_impact"), F.lit("Disparate impact (minimum)"), rnd(low, 4), F.lit(IMPACT_LIMIT), low >= IMPACT_LIMIT],
        gap("equal_opportunity", "True positive rate gap", "tpr_recall"),
        gap("predictive_parity", "Precision gap", "precision"),
    ]
    return stack_rows(agg, rows, ["criterion", "metric", "value", "threshold", "pass"]).filter(F.col("value").isNotNull())


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """One row: criteria passed, criteria judged, overall decision."""
    return verdicts.agg(
        F.count_if("pass").alias("n_criteria_pass"),
        F.count("*").alias("n_criteria_total"),
        F.coalesce(F.min("pass"), F.lit(True)).alias("overall_pass"),
    )


@dataclass(frozen=True)
class FairnessReport:
    imbalance: DataFrame
    sensitive_column: str | None
    groups: DataFrame | None
    verdicts: DataFrame | None
    summary: DataFrame | None


def run_fairness_analysis(
    features: DataFrame,
    predictions: DataFrame,
    key: list[str],
    label: str,
    prediction: str,
    sensitive: str | None = None,
    positive="1",
) -> FairnessReport:
    """Fairness of predictions whose groups live in another table.

    Rows are matched on ``key``, never by position.
    """
    imbalance = class_imbalance_report(predictions, label)
    if sensitive is None:
        found = detect_sensitive_columns(features)
        sensitive = found[0] if found else None
    if sensitive is None:
        return FairnessReport(imbalance, None, None, None, None)
    side = features.select(*[name_col(k) for k in key], name_col(sensitive).alias("_group"))
    joined = predictions.select(*[name_col(k) for k in key], name_col(label).alias("_y"), name_col(prediction).alias("_p")).join(side, key)
    groups = group_metrics(joined, "_y", "_p", "_group", positive)
    verdicts = fairness_verdict(groups)
    return FairnessReport(imbalance, sensitive, groups, verdicts, verdict_summary(verdicts))
