"""Descriptive statistics of numeric columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import name_col, number, ratio, rnd, stack_rows, with_scalars
from statloom.functions.moments import adjusted_kurtosis, adjusted_skewness, central_moments, power_sums
from statloom.functions.quantiles import QUARTILES, column_quantiles, group_quantiles, quantile_columns
from statloom.functions.roles import is_numeric, numeric_columns

def _moment_rows(df: DataFrame, names: list[str]) -> DataFrame | None:
    """Two scans for any number of columns: sizes, means and ranges; then shape and quartiles."""
    first = df.agg(
        F.count("*").alias("rows"),
        *[
            f(number(df, n)).alias(f"{label}{i}")
            for i, n in enumerate(names)
            for label, f in (("n", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))
        ],
        *[F.approx_count_distinct(number(df, n), 0.05).alias(f"d{i}") for i, n in enumerate(names)],
    ).first()
    filled = {i: n for i, n in enumerate(names) if first[f"n{i}"] > 0}
    if not filled:
        return None
    distinct = {n: first[f"d{i}"] for i, n in filled.items()}
    quartiles = quantile_columns(df, list(filled.values()), QUARTILES, distinct)
    second = df.agg(
        *[p for i, n in filled.items() for p in power_sums(number(df, n), first[f"m{i}"], str(i))],
        *[quartiles[n].alias(f"q{i}") for i, n in filled.items()],
    )
    rows = []
    for i, name in filled.items():
        count = F.lit(first[f"n{i}"])
        n = count.cast("double")
        m2, m3, m4 = central_moments(n, str(i))
        constant = F.lit(first[f"lo{i}"] == first[f"hi{i}"])
        variance = F.when(constant, 0.0).otherwise(m2 * n / (n - 1)) if first[f"n{i}"] > 1 else F.lit(None).cast("double")
        rows.append(
            [
                F.lit(name),
                count.cast("long"),
                F.lit(first["rows"] - first[f"n{i}"]).cast("long"),
                F.lit(float(first[f"m{i}"])),
                F.sqrt(variance),
                F.lit(float(first[f"lo{i}"])),
                F.lit(float(first[f"hi{i}"])),
                adjusted_skewness(F.try_divide(m3, m2 * F.sqrt(m2)), n, constant),
                adjusted_kurtosis(F.try_divide(m4, m2 * m2) - 3, n, constant),
                *[F.col(f"q{i}")[k] for k in range(3)],
            ]
        )
    return stack_rows(second, rows, MOMENT_COLUMNS)


MOMENT_COLUMNS = [
    "feature", "count", "missing", "mean", "std", "min", "max", "skewness", "kurtosis", "q1", "median", "q3",
]


def numeric_profile(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Unrounded statistics per numeric column; all-null columns are left out."""
    names = numeric_columns(df) if names is None else names
    rows = _moment_rows(df, names) if names else None
    if rows is None:
        kinds = ["string", "long", "long"] + ["double"] * 9
        rows = df.sparkSession.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in zip(MOMENT_COLUMNS, kinds)))
    return rows.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn("cv", ratio(F.col("std"), F.col("mean")))


# Result columns in reporting order.
STAT_COLUMNS = ["mean", "std", "min", "q1", "median", "q3", "max", "iqr", "cv", "skewness", "kurtosis"]


def descriptive_stats(df: DataFrame, names: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Count, missing, moments, quartiles, spread and shape for every numeric column."""
    stats = numeric_profile(df, names)
    return stats.select(
        "feature", "count", "missing", *[rnd(F.col(c), digits).alias(c) for c in STAT_COLUMNS]
    )


def statistical_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Statistics for chosen numeric columns (unknown names ignored) with null share."""
    names = numeric_columns(df)
    if columns:
        names = [c for c in columns if c in df.columns and is_numeric(df.schema[c].dataType)]
    if not names:
        raise ValueError("no numeric columns to summarise")
    s = numeric_profile(df, names)
    rows = F.col("count") + F.col("missing")
    return s.select(
        "feature",
        "count",
        "mean",
        "median",
        "std",
        "min",
        "max",
        F.col("q1").alias("q25"),
        F.col("q3").alias("q75"),
        "skewness",
        "kurtosis",
        rnd(100 * F.col("missing") / rows, 2).alias("null_pct"),
    )


def five_numbers(df: DataFrame, digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    s = numeric_profile(df)
    return s.select(
        "feature",
        "count",
        *[
            rnd(F.col(a), digits).alias(b)
            for a, b in [
                ("mean", "mean"),
                ("std", "std"),
                ("min", "min"),
                ("q1", "p25"),
                ("median", "p50"),
                ("q3", "p75"),
                ("max", "max"),
            ]
        ],
    )


def _bounds(df: DataFrame, names: list[str], z: float) -> dict[str, dict[str, float | None]]:
    """Per column: IQR fences, mean and sample deviation (a few numbers per column)."""
    row = df.agg(
        *[
            F.struct(
                F.avg(number(df, n)).alias("mean"),
                F.stddev_samp(number(df, n)).alias("std"),
                F.approx_count_distinct(number(df, n), 0.05).alias("distinct"),
            ).alias(f"s{i}")
            for i, n in enumerate(names)
        ]
    ).first()
    distinct = {n: row[i]["distinct"] for i, n in enumerate(names)}
    quartiles = column_quantiles(df, names, [0.25, 0.75], distinct=distinct)
    out = {}
    for i, n in enumerate(names):
        q1, q3 = quartiles[n]
        if q1 is None:
            continue
        spread = q3 - q1
        out[n] = {
            "low": q1 - 1.5 * spread,
            "high": q3 + 1.5 * spread,
            "mean": row[i]["mean"],
            "std": row[i]["std"],
            "zlow": None if row[i]["std"] is None else row[i]["mean"] - z * row[i]["std"],
            "zhigh": None if row[i]["std"] is None else row[i]["mean"] + z * row[i]["std"],
        }
    return out


def outlier_summary(df: DataFrame, z_thresh: float = 3.0) -> DataFrame:
    """IQR and z-score outlier counts per numeric column (bounds pass, then one count pass)."""
    names = numeric_columns(df)
    bounds = _bounds(df, names, z_thresh) if names else {}
    if not bounds:
        return df.sparkSession.createDataFrame(
            [],
            "feature string, iqr_outliers long, iqr_outlier_pct double, zscore_outliers long,"
            " lower_bound double, upper_bound double",
        )
    aggs = []
    for i, (n, b) in enumerate(bounds.items()):
        c = number(df, n)
        aggs.append(F.count_if((c < b["low"]) | (c > b["high"])).alias(f"o{i}"))
        aggs.append(F.count(c).alias(f"n{i}"))
        z = F.abs((c - b["mean"]) / b["std"]) > z_thresh if b["std"] else F.lit(False)
        aggs.append(F.count_if(z).alias(f"z{i}"))
    wide = df.agg(*aggs)
    rows = [
        [
            F.lit(n),
            F.col(f"o{i}"),
            rnd(100 * F.col(f"o{i}") / F.col(f"n{i}"), 2),
            F.col(f"z{i}"),
            rnd(F.lit(b["low"]), 4),
            rnd(F.lit(b["high"]), 4),
        ]
        for i, (n, b) in enumerate(bounds.items())
    ]
    return stack_rows(
        wide,
        rows,
        ["feature", "iqr_outliers", "iqr_outlier_pct", "zscore_outliers", "lower_bound", "upper_bound"],
    )


def detect_anomalies(df: DataFrame, column: str, order_by: list[str] | None = None) -> DataFrame:
    """One row: outlier counts by both rules, their bounds, share, severity, examples.

    ``examples`` holds the first five IQR outliers under ``order_by`` (the value itself
    when no order is given).
    """
    if column not in df.columns or not is_numeric(df.schema[column].dataType):
        raise ValueError(f"column '{column}' is missing or not numeric")
    c = number(df, column)
    b = _bounds(df, [column], 3.0).get(column)
    if b is None:
        raise ValueError(f"column '{column}' holds no values")
    outside = (c < b["low"]) | (c > b["high"])
    counts = df.agg(
        F.count_if(outside).alias("iqr_outliers_count"),
        F.count_if(F.abs(c - b["mean"]) > 3 * b["std"] if b["std"] else F.lit(False)).alias("zscore_outliers_count"),
        F.count(c).alias("n"),
    )
    order = [name_col(k) for k in (order_by or [column])]
    first = df.filter(outside).select(F.struct(*order, c.alias("_v")).alias("s")).orderBy("s").limit(5)
    examples = first.agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["_v"]).alias("example_anomalies"))
    share = F.col("iqr_outliers_count") / F.greatest(F.col("n"), F.lit(1))
    return counts.transform(with_scalars, examples).select(  # both sides are one row
        F.lit(column).alias("column"),
        "iqr_outliers_count",
        "zscore_outliers_count",
        F.lit(b["low"]).alias("iqr_lower"),
        F.lit(b["high"]).alias("iqr_upper"),
        F.lit(b["zlow"]).cast("double").alias("zscore_lower"),
        F.lit(b["zhigh"]).cast("double").alias("zscore_upper"),
        rnd(share * 100, 2).alias("anomaly_pct"),
        F.when(share > 0.1, "high").when(F.col("iqr_outliers_count") > 0, "medium").otherwise("none").alias("severity"),
        "example_anomalies",
    )


def group_comparison(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: count, mean, median, std, difference to the overall mean in percent, highest mean first.

    Rows without a group are left out of the groups but count for the overall mean.
    """
    c = number(df, value)
    overall = df.agg(F.avg(c).alias("overall_mean"))
    keyed = df.filter(name_col(group).isNotNull()).select(name_col(group).alias("group"), c.alias("v"))
    stats = keyed.groupBy("group").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")
    )
    medians = group_quantiles(keyed, ["group"], "v", [0.5]).select("group", F.col("q")[0].alias("median"))
    diff = rnd(100 * (F.col("mean") - F.col("overall_mean")) / F.col("overall_mean"), 2)
    return (
        stats.join(medians, "group", "left")
        .transform(with_scalars, overall)  # one row
        .select(
            F.col("group").cast("string").alias("group"),
            "count",
            "mean",
            "median",
            "std",
            F.when(F.col("overall_mean") == 0, 0.0).otherwise(diff).alias("vs_overall_pct"),
        )
        .orderBy(F.col("mean").desc_nulls_last(), "group")
    )


def group_extremes(comparison: DataFrame) -> DataFrame:
    """Highest and lowest group by mean, with the number of groups."""
    place = F.struct(F.coalesce("mean", F.lit(0.0)).alias("m"), "group")
    return comparison.agg(
        F.count("*").alias("group_count"),
        F.max_by("group", place).alias("highest_group"),
        F.max_by("mean", place).alias("highest_mean"),
        F.min_by("group", place).alias("lowest_group"),
        F.min_by("mean", place).alias("lowest_mean"),
    )
