"""Time series: resampling on a gap-free calendar, monthly trend, ordered series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import name_col, number, rnd
from statloom.functions.roles import is_datetime
from statloom.session import settle

UNITS = ["hour", "day", "week", "month", "quarter", "year"]


def resample(df: DataFrame, when: str, value: str, unit: str = "month", how: str = "mean") -> DataFrame:
    """``(position, period, value, n)`` with one row per period from first to last.

    Rows are reduced to one per period before the calendar is joined, so the calendar
    and the join only see as many rows as there are periods.
    """
    if unit not in UNITS or how not in ("mean", "sum", "min", "max"):
        raise ValueError(f"unknown unit '{unit}' or aggregate '{how}'")
    fn = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[how]
    periods = (
        df.select(F.date_trunc(unit, name_col(when).cast("timestamp")).alias("period"), number(df, value).alias("v"))
        .dropna()
        .groupBy("period")
        .agg(fn("v").alias("value"), F.count("v").alias("n"))
    )
    periods = settle(periods, "periods")
    steps = F.expr(f"timestampdiff({unit}, min(period), max(period)) + 1")
    span = periods.agg(steps.alias("steps"), F.min("period").cast("string").alias("first")).first()
    # the calendar is spread over tasks: one wrong date far off makes it long
    calendar = df.sparkSession.range(span["steps"] or 0).select(
        F.col("id").alias("position"),
        F.expr(f"timestampadd({unit}, CAST(id AS INT), TIMESTAMP'{span['first'] or '1970-01-01'}')").alias("period"),
    )
    return calendar.join(periods, "period", "left").select(
        F.col("position").cast("long").alias("position"), "period", "value", F.coalesce("n", F.lit(0)).alias("n")
    )


def monthly_averages(df: DataFrame, when: str, value: str) -> DataFrame:
    """Month-end label and mean per month, empty months included."""
    monthly = resample(df, when, value, "month")
    return monthly.select(
        "position", F.date_format(F.last_day("period"), "yyyy-MM-dd").alias("period"), "value"
    )


def trend_analysis(df: DataFrame, when: str, value: str) -> DataFrame:
    """One row: least-squares slope over the month index, direction, change, end points.

    No row comes back when the data spans fewer than two months.
    """
    m = monthly_averages(df, when, value)
    seen = F.col("value").isNotNull()
    place = F.when(seen, F.col("position"))
    a = m.agg(
        F.count("*").alias("period_count"),
        F.coalesce(F.regr_slope("value", "position"), F.lit(0.0)).alias("slope"),
        F.min_by("value", place).alias("start_value"),
        F.max_by("value", place).alias("end_value"),
    ).filter("period_count >= 2")
    slope, start, end = F.col("slope"), F.col("start_value"), F.col("end_value")
    change = F.when(start == 0, 0.0).otherwise(F.try_divide(100 * (end - start), F.abs(start)))
    return a.select(
        F.lit(when).alias("date_column"),
        F.lit(value).alias("value_column"),
        F.when(slope > 0, "upward").when(slope < 0, "downward").otherwise("flat").alias("trend_direction"),
        rnd(slope, 4).alias("slope"),
        rnd(change, 2).alias("pct_change_overall"),
        start,
        end,
        "period_count",
    )


def line_series(df: DataFrame, x: str, ys: list[str]) -> DataFrame:
    """Rows with an x value, ordered by x; dates shown as yyyy-MM-dd."""
    shown = F.date_format("_x", "yyyy-MM-dd") if is_datetime(df.schema[x].dataType) else F.col("_x")
    return (
        df.filter(name_col(x).isNotNull())
        .select(name_col(x).alias("_x"), *[number(df, y).alias(y) for y in ys])
        .orderBy("_x", *[name_col(y) for y in ys])
        .select(shown.alias(x), *[name_col(y) for y in ys])
    )
