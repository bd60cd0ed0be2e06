"""The numbers behind charts: bins, bars, points, boxes, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import SEED, name_col, number, present, rnd, with_scalars
from statloom.functions.quantiles import GROUP_BROADCAST_LIMIT, QUARTILES, group_quantiles
from statloom.functions.roles import categorical_columns, numeric_columns
from statloom.operators.correlation import correlation_matrix
from statloom.operators.profile import chart_column_picks, value_counts


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], empty bins included; the last bin is closed."""
    c = number(df, column)
    span = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    schema = "bin int, lower double, upper double, count long"
    if span["lo"] is None:
        return df.sparkSession.createDataFrame([], schema)
    lo, width = span["lo"], (span["hi"] - span["lo"]) / bins
    if width == 0:
        return df.agg(F.count(c).alias("count")).select(
            F.lit(0).alias("bin"), F.lit(lo).alias("lower"), F.lit(lo).alias("upper"), "count"
        )
    place = F.least(F.floor((c - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(c.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("count"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(F.broadcast(counts), "bin", "left").select(  # at most `bins` rows
        "bin",
        (lo + F.col("bin") * width).alias("lower"),
        (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def bar_counts(df: DataFrame, category: str, top_n: int = 15) -> DataFrame:
    """The ``top_n`` most frequent categories."""
    counts = value_counts(df, [category]).filter(F.col("value").isNotNull())
    return (
        counts.select(F.col("value").alias("category"), "count")
        .orderBy(F.col("count").desc(), "category")
        .limit(top_n)
    )


def bar_means(df: DataFrame, category: str, value: str, top_n: int = 15) -> DataFrame:
    """The ``top_n`` categories by mean of ``value``."""
    return (
        df.select(present(df, category).alias("category"), number(df, value).alias("v"))
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.avg("v").alias("mean"))
        .orderBy(F.col("mean").desc_nulls_last(), "category")
        .limit(top_n)
    )


def pie_shares(df: DataFrame, category: str) -> DataFrame:
    """Count and share of every category."""
    counts = value_counts(df, [category]).filter(F.col("value").isNotNull())
    total = df.agg(F.count(present(df, category)).alias("n"))
    return counts.transform(with_scalars, total).select(  # one row
        F.col("value").alias("category"), "count", rnd(100 * F.col("count") / F.col("n"), 2).alias("share_pct")
    )


def scatter_points(
    df: DataFrame, x: str, y: str, color: str | None = None, sample_size: int = 2000, key: list[str] | None = None
) -> DataFrame:
    """A repeatable sample of complete points: the smallest row hashes win.

    The hash covers ``key`` (all columns by default), so the choice does not depend on
    how the rows are partitioned.
    """
    cells = [number(df, x).alias(x), number(df, y).alias(y)]
    if color:
        cells.append(present(df, color).alias(color))
    place = F.xxhash64(*[name_col(k) for k in (key or df.columns)], F.lit(SEED))
    points = df.select(*cells, place.alias("_h")).dropna()
    return points.orderBy("_h", *points.columns[:-1]).limit(sample_size).drop("_h")


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line over all complete points and its ends; needs more than two."""
    points = df.select(number(df, x).alias("x"), number(df, y).alias("y")).dropna()
    fit = points.agg(
        F.count("*").alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.min("x").alias("x_start"),
        F.max("x").alias("x_end"),
    ).filter("n > 2")
    line = [(F.col("intercept") + F.col("slope") * F.col(p)).alias(o) for p, o in (("x_start", "y_start"), ("x_end", "y_end"))]
    return fit.select("*", *line)


def heatmap(df: DataFrame, digits: int = 3, limit: int | None = None) -> DataFrame:
    """Correlation matrix in long form over all numeric columns, or the first ``limit``."""
    names = numeric_columns(df)
    return correlation_matrix(df, digits=digits, names=names[:limit] if limit else names)


def box_stats(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Quartiles, whiskers (outermost values within 1.5 IQR), outliers, mean and sd."""
    g = present(df, group).cast("string") if group else F.lit("all")
    rows = df.select(g.alias("group"), number(df, value).alias("v")).dropna()
    q = group_quantiles(rows, ["group"], "v", QUARTILES).select(
        "group", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    q = q.withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    few = group is None or q.limit(GROUP_BROADCAST_LIMIT + 1).count() <= GROUP_BROADCAST_LIMIT
    joined = rows.join(F.broadcast(q) if few else q, "group")
    inside = (F.col("v") >= F.col("q1") - F.col("reach")) & (F.col("v") <= F.col("q3") + F.col("reach"))
    return joined.groupBy("group", "q1", "median", "q3").agg(
        F.count("v").alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("sd"),
    )


def auto_charts(df: DataFrame) -> dict[str, DataFrame]:
    """Chart tables picked from the columns: heatmap, histogram, counts, scatter."""
    nums, cats = numeric_columns(df), categorical_columns(df)
    picks = chart_column_picks(df).first()
    out: dict[str, DataFrame] = {}
    if len(nums) >= 2:
        out["heatmap"] = correlation_matrix(df, digits=2)
    if nums:
        out["histogram"] = histogram(df, picks["top_variance"])
        out["box"] = box_stats(df, picks["top_variance"])
    if cats:
        out["counts"] = pie_shares(df, picks["low_cardinality"]).drop("share_pct")
    if len(nums) >= 2:
        out["scatter"] = scatter_points(df, picks["top_variance"], picks["second_variance"], cats[0] if cats else None)
    return out
