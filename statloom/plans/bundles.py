"""Composite analyses: each returns named DataFrames built from the operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import rnd, with_scalars
from statloom.operators import cleaning, correlation, describe, models, profile
from statloom.operators.target import column_facts, suggest_target
from statloom.session import settle

# How many relationships a bundle reports, and when skew is flagged.
ANALYSIS_TOP = 8
REPORT_TOP = 5
SKEW_LIMIT = 1.0

# What is known about three public study datasets.
CONTEXT_SCHEMA = "dataset string, title string, domain string, target_column string, sensitive_column string, positive_label int"
CONTEXTS = [
    ("cs_training", "Financial Risk Prediction Study", "Financial Services / Credit Risk", "SeriousDlqin2yrs", "age", 1),
    ("heart_disease", "Heart Disease Prediction Study", "Clinical / Healthcare", "target", "sex", 1),
    ("sample", "General Sample Dataset", "General", None, None, 1),
]
DEFAULT_CONTEXT = ("Data Science Analysis", "General", 1)


def statistics_bundle(df: DataFrame, top: int = ANALYSIS_TOP) -> dict[str, DataFrame]:
    """Profile, statistics with a skew flag, categories, outliers, significant pairs."""
    stats = describe.descriptive_stats(df)
    return {
        "profile": profile.profile_dataset(df),
        "descriptive": stats.withColumn("skewed", F.coalesce(F.abs("skewness") > SKEW_LIMIT, F.lit(False))),
        "categorical": profile.categorical_summary(df),
        "outliers": describe.outlier_summary(df),
        "correlations": correlation.correlation_significance(df).filter("significant = 'significant'").limit(top),
    }


def report_bundle(df: DataFrame) -> dict[str, DataFrame]:
    """Profile, statistics, missing values and the strongest significant pairs."""
    return {
        "profile": profile.profile_dataset(df),
        "descriptive": describe.descriptive_stats(df),
        "missing": profile.missing_analysis(df),
        "correlations": correlation.correlation_significance(df).filter("significant = 'significant'").limit(REPORT_TOP),
    }


def analyze(df: DataFrame, target: str | None = None, **training: Any) -> dict[str, DataFrame]:
    """Profile, clean, find the strongest relationship, train; findings as rows."""
    spark = df.sparkSession
    before = profile.profile_dataset(df)
    cleaned, audit = cleaning.clean(df)
    cleaned = cleaned.persist()
    out = {
        "profile": before,
        "audit": audit,
        "cleaned": cleaned,
        "profile_cleaned": profile.profile_dataset(cleaned),
        "correlations": correlation.correlation_significance(cleaned),
    }
    b, a = before.first(), out["profile_cleaned"].first()
    findings = [
        ("size", f"{b['n_rows']} rows, {b['n_cols']} columns ({b['n_numeric']} numeric, {b['n_categorical']} categorical)"),
        ("cleaning", f"filled {max(0, b['missing_cells'] - a['missing_cells'])} values, removed {b['duplicate_rows']} duplicates"),
    ]
    strongest = correlation.describe_strongest(out["correlations"]).first()
    if strongest:
        findings.append(
            (
                "relationship",
                f"{strongest['feature_a']} and {strongest['feature_b']} move {strongest['strength']}"
                f" {strongest['direction']} (r = {strongest['r']:.2f})",
            )
        )
    target = target or suggest_target(cleaned, column_facts(cleaned))
    try:
        trained = models.train_and_evaluate(cleaned, target, **training)
    except Exception as reason:  # noqa: BLE001 - an analysis goes on without a model, whatever failed
        findings.append(("model", f"no model: {reason}"))
    else:
        out["leaderboard"] = trained.leaderboard
        out["importance"] = trained.importance()
        best = trained.leaderboard.filter(F.col("model") == trained.best).first()
        if trained.problem.task == "classification":
            share = f"is correct for {round(100 * best['accuracy'])}% of rows (F1 {best['f1']:.2f})"
        else:
            share = f"explains {round(100 * max(0.0, best['r2']))}% of the variation"
        findings.append(("model", f"{trained.best} for {target} {share}"))
        drivers = [r["feature"] for r in out["importance"].limit(3).collect()]
        findings.append(("drivers", ", ".join(drivers)))
    cleaned.unpersist()  # what is returned is evaluated when it is used
    headline = {k: t for k, t in findings}
    out["headline"] = spark.createDataFrame(
        [("; ".join(headline[k] for k in ("size", "relationship", "model") if k in headline),)], "headline string"
    )
    rows = [(i + 1, k, t) for i, (k, t) in enumerate(findings)]
    out["findings"] = spark.createDataFrame(rows, "position int, topic string, finding string")
    return out


def run_stages(df: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> tuple[DataFrame, DataFrame]:
    """Chain stages; one that fails is noted and the next continues on the last good input.

    Each result is written once, so that failures surface at their own stage and later stages read it.
    """
    status, current = [], df
    for position, (name, stage) in enumerate(stages, start=1):
        try:
            result = settle(stage(current), "chain")
            rows = result.count()
        except Exception as reason:  # noqa: BLE001 - any failure degrades, none stops the chain
            status.append((position, name, "failed", None, str(reason)))
        else:
            status.append((position, name, "completed", rows, None))
            current = result
    schema = "position int, stage string, status string, rows long, error string"
    return current, df.sparkSession.createDataFrame(status, schema)


def contexts_for(datasets: DataFrame, contexts: DataFrame | None = None, name: str = "dataset") -> DataFrame:
    """Study context per dataset name (case, blanks and hyphens ignored), with a default."""
    if contexts is None:
        contexts = datasets.sparkSession.createDataFrame(CONTEXTS, CONTEXT_SCHEMA)
    key = F.regexp_replace(F.lower(F.col(name)), "[- ]", "_")
    joined = datasets.withColumn("_key", key).join(
        F.broadcast(contexts.withColumnRenamed("dataset", "_key")), "_key", "left"  # a row per known study
    )
    title, domain, positive = DEFAULT_CONTEXT
    return joined.drop("_key").withColumns(
        {
            "title": F.coalesce("title", F.lit(title)),
            "domain": F.coalesce("domain", F.lit(domain)),
            "positive_label": F.coalesce("positive_label", F.lit(positive)),
        }
    )


def dataset_scores(df: DataFrame) -> DataFrame:
    """Health score of one table from its profile, significant pairs and outliers."""
    n = profile.profile_dataset(df)
    pairs = correlation.correlation_significance(df).agg(F.count_if(F.col("significant") == "significant").alias("insight_count"))
    outliers = describe.outlier_summary(df).agg(F.coalesce(F.sum("iqr_outliers"), F.lit(0)).alias("anomaly_count"))
    facts = n.select(
        F.col("n_rows").alias("row_count"), rnd(1 - F.col("missing_pct") / 100, 3).alias("quality_score")
    )
    # three one-row tables
    return profile.health_score(facts.transform(with_scalars, pairs).transform(with_scalars, outliers))
