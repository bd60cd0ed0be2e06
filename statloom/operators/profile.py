"""Table-level and column-level profiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.exprs import any_of, name_col, number, present, ratio, rnd, stack_rows, with_scalars
from statloom.functions.roles import (
    categorical_columns,
    datetime_columns,
    friendly_type,
    is_datetime,
    is_numeric,
    numeric_columns,
)

# Name fragments and limits of the column heuristics.
DATE_WORDS = ["date", "time", "timestamp"]
UPLOAD_DATE_WORDS = ["date", "time", "timestamp", "created", "updated"]
KEY_NAMES = ["id", "uuid", "key"]
KEY_SUFFIXES = ["_id", "_key", "uuid"]
CATEGORICAL_BELOW = 30
SAMPLE_VALUES = 5
HIGH_CARDINALITY = 50


def _text(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("string")


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, and copies beyond the first of each distinct row.

    Rows are told apart by two 64-bit hashes with different seeds: only these are shuffled, and
    copies combine map-side, so neither a wide row nor one repeated millions of times moves.
    """
    cells = [present(df, c) for c in df.columns]
    counts = df.groupBy(*hash_pair(*cells)).agg(F.count("*").alias("c"))
    return counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_rows")
    )


def hash_pair(*cells: Column) -> list[Column]:
    """128 bits of hash in two columns, ``_h`` and ``_g``; the hash passes over NULL, so its places count too."""
    known = [x for c in cells for x in (c.isNull(), c)]
    return [F.xxhash64(*known).alias("_h"), F.xxhash64(F.lit(1), *known).alias("_g")]


def distinct_counts(df: DataFrame, cells: dict[str, Column]) -> DataFrame:
    """One row with the number of distinct values of every expression, under its name.

    The hashes of the values are shuffled, once per distinct value and task, not the values, and
    not the row once per column.
    """
    empty = F.struct(F.lit(0).alias("_i"), *hash_pair(F.lit(0)))
    pairs = [F.when(c.isNotNull(), F.struct(F.lit(i).alias("_i"), *hash_pair(c))) for i, c in enumerate(cells.values())]
    found = df.select(F.inline(F.array_compact(F.array(*pairs or [F.when(F.lit(False), empty)]))))
    each = found.groupBy("_i", "_h", "_g").agg(F.lit(1).alias("one"))
    return each.agg(*[F.count(F.when(F.col("_i") == i, 1)).alias(name) for i, name in enumerate(cells)] or [F.lit(1).alias("_one")])


def profile_dataset(df: DataFrame) -> DataFrame:
    """One row: size, columns per role, missing cells and duplicate rows."""
    cols = len(df.columns)
    missing = df.agg(*[F.count_if(present(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    cells = sum((F.col(f"m{i}") for i in range(1, cols)), F.col("m0"))
    one = missing.select(cells.alias("missing_cells")).transform(with_scalars, duplicate_count(df))
    n = F.col("n_rows")
    return one.select(
        n,
        F.lit(cols).cast("long").alias("n_cols"),
        F.lit(len(numeric_columns(df))).cast("long").alias("n_numeric"),
        F.lit(len(categorical_columns(df))).cast("long").alias("n_categorical"),
        F.lit(len(datetime_columns(df))).cast("long").alias("n_datetime"),
        "missing_cells",
        F.coalesce(rnd(ratio(100 * F.col("missing_cells"), n * cols), 2), F.lit(0.0)).alias("missing_pct"),
        "duplicate_rows",
        F.coalesce(rnd(ratio(100 * F.col("duplicate_rows"), n), 2), F.lit(0.0)).alias("duplicate_pct"),
    )


def missing_analysis(df: DataFrame) -> DataFrame:
    """Columns with missing cells: count, share and type, worst first."""
    wide = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(present(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        [F.lit(f.name), F.col(f"m{i}"), rnd(ratio(100 * F.col(f"m{i}"), F.col("n")), 2), F.lit(friendly_type(f.dataType))]
        for i, f in enumerate(df.schema.fields)
    ]
    out = stack_rows(wide, rows, ["feature", "missing", "missing_pct", "dtype"])
    return out.filter("missing > 0").orderBy(F.col("missing").desc(), "feature")


def value_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """``(feature, value, count)`` for several columns in one job; NULL is its own value."""
    cells = [F.struct(F.lit(n).alias("feature"), _text(df, n).alias("value")) for n in names]
    return (
        df.select(F.inline(F.array(*cells))).groupBy("feature", "value").agg(F.count("*").alias("count"))
    )


def categorical_summary(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Cardinality, missing, mode (ties: smallest value), mode share and entropy in bits."""
    names = categorical_columns(df) if names is None else names
    if not names:
        return df.sparkSession.createDataFrame(
            [], "feature string, n_unique long, missing long, mode string, mode_freq long, mode_pct double, entropy_bits double"
        )
    seen = F.col("value").isNotNull()
    c = F.when(seen, F.col("count"))
    n = F.sum(c)
    best = F.min_by(F.struct("value", "count"), F.when(seen, F.struct((-F.col("count")).alias("c"), "value")))
    # H = log2(n) - sum(c log2 c) / n needs no second pass for the total
    entropy = F.log2(n) - F.sum(c * F.log2(c)) / n
    agg = value_counts(df, names).groupBy("feature").agg(
        F.count(c).alias("n_unique"),
        F.coalesce(F.sum(F.when(~seen, F.col("count"))), F.lit(0)).alias("missing"),
        best.alias("best"),
        n.alias("n"),
        entropy.alias("entropy"),
    )
    return agg.filter("n_unique > 0").select(
        "feature",
        "n_unique",
        "missing",
        F.col("best.value").alias("mode"),
        F.col("best.count").alias("mode_freq"),
        rnd(100 * F.col("best.count") / F.col("n"), 2).alias("mode_pct"),
        rnd(F.abs("entropy"), 3).alias("entropy_bits"),
    )


def frequency_distribution(df: DataFrame, column: str, top_n: int = 20) -> DataFrame:
    """Most frequent values with count and share of the non-null rows."""
    counts = value_counts(df, [column]).filter(F.col("value").isNotNull()).select("value", "count")
    total = df.agg(F.count(present(df, column)).alias("n"))
    return (
        counts.orderBy(F.col("count").desc(), "value")
        .limit(top_n)
        .transform(with_scalars, total)  # one row
        .select("value", "count", rnd(100 * F.col("count") / F.col("n"), 2).alias("pct"))
    )


def frequency_facts(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct and missing counts, cardinality flag, most and least common."""
    seen = F.col("value").isNotNull()
    return (
        value_counts(df, [column])
        .agg(
            F.count_if(seen).alias("unique_values"),
            F.coalesce(F.sum(F.when(seen, F.col("count"))), F.lit(0)).alias("total_non_null"),
            F.coalesce(F.sum(F.when(~seen, F.col("count"))), F.lit(0)).alias("null_count"),
            F.min_by("value", F.when(seen, F.struct((-F.col("count")).alias("c"), "value"))).alias("most_common"),
            F.max_by("value", F.when(seen, F.struct((-F.col("count")).alias("c"), "value"))).alias("least_common"),
        )
        .select(F.lit(column).alias("column"), "*", (F.col("unique_values") > HIGH_CARDINALITY).alias("is_high_cardinality"))
    )


def top_values(df: DataFrame, names: list[str] | None = None, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values of every categorical column."""
    names = categorical_columns(df) if names is None else names
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.col("count").desc(), "value"))
    counts = value_counts(df, names).filter(F.col("value").isNotNull())
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n).select(
        "feature", F.col("rank").cast("long").alias("rank"), "value", "count"
    )


def column_overview(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Type, missing, distinct count and one sample value (first under ``order_by``)."""
    place = F.struct(*[name_col(k) for k in order_by]) if order_by else None
    aggs = [F.count("*").alias("n")]
    for i, name in enumerate(df.columns):
        c = present(df, name)
        aggs += [
            F.count(c).alias(f"c{i}"),
            (F.min_by(_text(df, name), F.when(c.isNotNull(), place)) if order_by else F.min(c).cast("string")).alias(f"s{i}"),
        ]
    wide = df.agg(*aggs).transform(with_scalars, distinct_counts(df, {f"u{i}": present(df, c) for i, c in enumerate(df.columns)}))
    rows = [
        [
            F.lit(f.name),
            F.lit(friendly_type(f.dataType)),
            F.col("n") - F.col(f"c{i}"),
            rnd(ratio(100 * (F.col("n") - F.col(f"c{i}")), F.col("n")), 1),
            F.col(f"u{i}"),
            F.col(f"s{i}"),
        ]
        for i, f in enumerate(df.schema.fields)
    ]
    return stack_rows(wide, rows, ["feature", "dtype", "missing", "missing_pct", "n_unique", "sample"])


def column_schema(df: DataFrame) -> DataFrame:
    """Readable type, nullability, distinct count and up to five sample values.

    Rows carry no order, so the samples are the smallest distinct values as text.
    """
    counts = value_counts(df, df.columns)
    facts = counts.groupBy("feature").agg(
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("null_count"),
    )
    rank = F.row_number().over(Window.partitionBy("feature").orderBy("value"))
    samples = (
        counts.filter(F.col("value").isNotNull())
        .withColumn("r", rank)
        .filter(F.col("r") <= SAMPLE_VALUES)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list("value")).alias("sample_values"))
    )
    types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(friendly_type(f.dataType)))])
    return facts.join(samples, "feature", "left").select(
        "feature",
        F.element_at(types, F.col("feature")).alias("dtype"),
        (F.col("null_count") > 0).alias("nullable"),
        "unique_count",
        "null_count",
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
    )


def _distinct_counts(df: DataFrame) -> DataFrame:
    wide = distinct_counts(df, {f"u{i}": _text(df, c) for i, c in enumerate(df.columns)})
    return stack_rows(wide, [[F.lit(c), F.col(f"u{i}")] for i, c in enumerate(df.columns)], ["feature", "unique_count"])


def _range_statistics(df: DataFrame) -> DataFrame:
    aggs = [F.count("*").alias("n")]
    for i, f in enumerate(df.schema.fields):
        c = present(df, f.name)
        none = F.lit(None).cast("double")
        if is_numeric(f.dataType):
            num = number(df, f.name)
        elif isinstance(f.dataType, T.BooleanType):
            num = c.cast("int").cast("double")
        elif isinstance(f.dataType, T.StringType):
            num = F.nanvl(F.trim(c).try_cast("double"), none)
        else:
            num = none
        aggs += [
            F.count(c).alias(f"c{i}"),
            F.count(num).alias(f"k{i}"),
            F.min(num).alias(f"lo{i}"),
            F.max(num).alias(f"hi{i}"),
            F.avg(num).alias(f"m{i}"),
            F.coalesce(F.stddev_samp(num), F.when(F.count(num) == 1, 0.0)).alias(f"s{i}"),
        ]
        if not is_numeric(f.dataType):
            low, high = F.min(c), F.max(c)
            if is_datetime(f.dataType):
                low, high = (F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss") for x in (low, high))
            aggs += [low.cast("string").alias(f"tl{i}"), high.cast("string").alias(f"th{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(df.schema.fields):
        text = [F.lit(None).cast("string")] * 2
        if not is_numeric(f.dataType):
            text = [F.when(F.col(f"k{i}") == 0, F.col(f"{t}{i}")) for t in ("tl", "th")]
        rows.append(
            [
                F.lit(f.name),
                F.lit(friendly_type(f.dataType)),
                rnd(ratio(100 * (F.col("n") - F.col(f"c{i}")), F.col("n")), 2),
                F.col(f"lo{i}"),
                F.col(f"hi{i}"),
                rnd(F.col(f"m{i}"), 4),
                rnd(F.col(f"s{i}"), 4),
                *text,
            ]
        )
    return stack_rows(
        wide, rows, ["feature", "dtype", "null_pct", "min", "max", "mean", "std", "min_text", "max_text"]
    )


def column_statistics(df: DataFrame) -> DataFrame:
    """Null share, distinct count and min/max/mean/std.

    A column with any value that parses as a number is summarised over its parsed
    values; otherwise min and max are lexical (or typed for dates).
    """
    return _range_statistics(df).join(F.broadcast(_distinct_counts(df)), "feature")  # a row per column


def _contains(words: list[str]) -> Column:
    return any_of([F.lower("feature").contains(w) for w in words])


def table_summary(df: DataFrame) -> DataFrame:
    """Compact per-column summary with the categorical and date-like guesses."""
    stats = _range_statistics(df).select("feature", "null_pct", "min", "max", "mean", "std")
    return (
        column_schema(df)
        .join(F.broadcast(stats), "feature")  # one row per column
        .select(
            "feature",
            "dtype",
            "null_pct",
            "unique_count",
            "mean",
            "std",
            "min",
            "max",
            F.when(F.col("mean").isNull(), F.col("sample_values")).alias("sample_values"),
            ((F.col("unique_count") < CATEGORICAL_BELOW) & (F.col("dtype") == "string")).alias("likely_categorical"),
            _contains(DATE_WORDS).alias("likely_datetime"),
        )
    )


def upload_quality(df: DataFrame) -> DataFrame:
    """One row: overall null rate, quality score, date-like and key-like columns."""
    c = len(df.columns)
    aggs = [F.count("*").alias("row_count")]
    aggs += [F.count(present(df, name)).alias(f"c{i}") for i, name in enumerate(df.columns)]
    wide = df.agg(*aggs).transform(with_scalars, distinct_counts(df, {f"u{i}": present(df, c) for i, c in enumerate(df.columns)}))
    n = F.col("row_count")
    # whole missing cells per column, from the two-decimal share as shown to users
    missing = [
        F.floor(rnd(ratio(100 * (n - F.col(f"c{i}")), n), 2) / 100 * n).cast("long") for i in range(c)
    ]
    rate = F.coalesce(rnd(ratio(100 * sum(missing[1:], missing[0]), n * c), 2), F.lit(0.0))
    key_like = [
        F.when((F.col(f"u{i}") == n) & (n > 0), F.lit(name))
        for i, name in enumerate(df.columns)
        if name.lower() in KEY_NAMES or any(name.lower().endswith(s) for s in KEY_SUFFIXES)
    ]
    dates = [x for x in df.columns if any(w in x.lower() for w in UPLOAD_DATE_WORDS)]
    return wide.select(
        n,
        F.lit(c).cast("long").alias("column_count"),
        rate.alias("overall_null_rate_pct"),
        rnd(F.greatest(F.lit(0.0), (100.0 - rate) / 100.0), 3).alias("quality_score"),
        F.array(*[F.lit(d) for d in dates]).cast("array<string>").alias("likely_datetime_columns"),
        F.array_compact(F.array(*key_like).cast("array<string>")).alias("likely_id_columns"),
    )


def health_warnings(df: DataFrame) -> DataFrame:
    """Structural warnings ``(warning, detail)``; no rows when nothing is wrong."""
    names = df.columns
    unnamed = sum(1 for c in names if c.startswith("Unnamed"))
    repeated = sorted({c for c in names if names.count(c) > 1})
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    checks = [
        (F.lit(unnamed > 0), "unnamed_columns", F.lit(f"{unnamed} of {len(names)} columns have no header name")),
        (F.lit(bool(repeated)), "duplicate_names", F.lit("duplicate column names: " + ", ".join(repeated))),
        (
            F.lit(len(names) > 50) & (F.lit(len(names)) > n),
            "wide_table",
            F.format_string(f"{len(names)} columns vs %d rows", n),
        ),
        (n < 20, "few_rows", F.format_string("only %d rows; modeling needs at least 20", n)),
    ]
    found = F.array_compact(
        F.array(*[F.when(cond, F.struct(F.lit(w).alias("warning"), d.alias("detail"))) for cond, w, d in checks])
    )
    return rows.select(F.inline(found))


def chart_column_picks(df: DataFrame) -> DataFrame:
    """One row: two highest-variance numeric columns, lowest-cardinality categorical."""
    nums, cats = numeric_columns(df), categorical_columns(df)
    aggs = [F.struct(F.var_samp(number(df, n)).alias("v"), F.lit(n).alias("name")).alias(f"v{i}") for i, n in enumerate(nums)]
    wide = df.agg(*(aggs or [F.lit(1).alias("x")])).transform(
        with_scalars, distinct_counts(df, {f"d{i}": name_col(c) for i, c in enumerate(cats)})
    )
    by_var = F.array_sort(
        F.array(*[F.struct((-F.col(f"v{i}.v")).alias("v"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(nums)])
    )
    by_card = F.array_sort(
        F.array(*[F.struct(F.col(f"d{i}").alias("d"), F.lit(i).alias("i"), F.lit(c).alias("name")) for i, c in enumerate(cats)])
    )
    none = F.lit(None).cast("string")
    return wide.select(
        (by_var[0]["name"] if nums else none).alias("top_variance"),
        (by_var[1]["name"] if len(nums) > 1 else none).alias("second_variance"),
        (by_card[0]["name"] if cats else none).alias("low_cardinality"),
    )


def health_score(profiles: DataFrame) -> DataFrame:
    """Score and grade a table of dataset profiles.

    Needs ``quality_score, insight_count, anomaly_count, row_count``. Points: quality
    40, insights 30 (full at five), anomalies 15, size 15 (log scale, full at 10^4).
    """
    rows = F.greatest(F.col("row_count"), F.lit(1))
    quality = F.when(F.coalesce("quality_score", F.lit(0.0)) == 0, 0.5).otherwise(F.col("quality_score")) * 40
    insight = F.least(F.col("insight_count") / 5, F.lit(1.0)) * 30
    anomaly = F.greatest(F.lit(0.0), 15 - F.col("anomaly_count") / rows * 1000)
    size = F.least(F.log10(rows) / 4, F.lit(1.0)) * 15
    total = quality + insight + anomaly + size
    grade = F.when(total >= 80, "A").when(total >= 65, "B").when(total >= 50, "C").otherwise("D")
    label = (
        F.when(total >= 80, "Excellent").when(total >= 65, "Good").when(total >= 50, "Fair").otherwise("Needs Improvement")
    )
    return profiles.select(
        "*",
        rnd(total, 1).alias("overall_score"),
        grade.alias("grade"),
        label.alias("label"),
        rnd(quality, 1).alias("data_quality"),
        rnd(insight, 1).alias("insight_richness"),
        rnd(anomaly, 1).alias("anomaly_score"),
        rnd(size, 1).alias("dataset_size_score"),
    )


def key_takeaways(insights: DataFrame, keep: int = 5, keys: list[str] = ()) -> DataFrame:
    """Insights ranked by importance (high 3, medium 2, low 1) times confidence.

    Needs ``title, description, importance, confidence``; ranks per ``keys`` if given.
    """
    weight = F.when(F.col("importance") == "high", 3).when(F.col("importance") == "low", 1).otherwise(2)
    scored = insights.withColumn("score", weight * F.coalesce("confidence", F.lit(0.7)))
    order = [F.col("score").desc(), F.col("title")]
    takeaway = F.concat_ws(": ", F.coalesce("title", F.lit("Finding")), F.coalesce("description", F.lit("")))
    if keys:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        scored = scored.withColumn("_r", rank).filter(F.col("_r") <= keep)
    else:
        scored = scored.orderBy(*order).limit(keep)
    return scored.select(*keys, "score", takeaway.alias("takeaway"))


def text_summary(df: DataFrame) -> dict[str, DataFrame]:
    """Shape, types with missing counts, five-number rows and top values as tables."""
    from statloom.operators.describe import five_numbers

    return {
        "columns": column_overview(df),
        "numeric": five_numbers(df),
        "top_values": top_values(df, [c for c in categorical_columns(df) if isinstance(df.schema[c].dataType, T.StringType)]),
    }
