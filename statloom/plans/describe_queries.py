"""Registered queries: descriptive statistics and outliers."""

from __future__ import annotations

from statloom.operators import describe
from statloom.plans.registry import query, rnd
from statloom.sources.tables import table


def long_sql(table_name: str, columns: list[str], text: bool = False) -> str:
    cast = "VARCHAR" if text else "DOUBLE"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS v FROM {table_name}" for c in columns
    )


LINEITEM_NUM = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]
PART_NUM = ["p_partkey", "p_size", "p_retailprice"]


def stats_sql(src: str, columns: list[str]) -> str:
    parts = {
        "mean": "avg(v)",
        "std": "stddev_samp(v)",
        "min": "min(v)",
        "q1": "quantile_cont(v, 0.25)",
        "median": "quantile_cont(v, 0.5)",
        "q3": "quantile_cont(v, 0.75)",
        "max": "max(v)",
        "iqr": "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)",
        "cv": "stddev_samp(v) / nullif(avg(v), 0)",
        "skewness": "skewness(v)",
        "kurtosis": "kurtosis(v)",
    }
    cols = ", ".join(f"{rnd(e, 4)} AS {n}" for n, e in parts.items())
    return (
        f"SELECT feature, count(v) AS count, count(*) - count(v) AS missing, {cols} "
        f"FROM ({long_sql(src, columns)}) GROUP BY feature"
    )


@query("descriptive_stats", stats_sql("lineitem", LINEITEM_NUM))
def _descriptive(spark, sf):
    return describe.descriptive_stats(table(spark, sf, "lineitem"))


@query(
    "descriptive_stats_with_nulls",
    stats_sql(
        "(SELECT nullif(l_discount, 0.0) AS l_discount, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax FROM lineitem)",
        ["l_discount", "l_tax"],
    ),
)
def _descriptive_nulls(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(
        "nullif(l_discount, 0.0D) AS l_discount",
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax",
    )
    return describe.descriptive_stats(df)


@query(
    "statistical_summary",
    "SELECT feature, count(v) AS count, "
    + ", ".join(
        f"{rnd(e, 6)} AS {n}"
        for n, e in [
            ("mean", "avg(v)"),
            ("median", "quantile_cont(v, 0.5)"),
            ("std", "stddev_samp(v)"),
            ("min", "min(v)"),
            ("max", "max(v)"),
            ("q25", "quantile_cont(v, 0.25)"),
            ("q75", "quantile_cont(v, 0.75)"),
            ("skewness", "skewness(v)"),
            ("kurtosis", "kurtosis(v)"),
            ("null_pct", "100.0 * (count(*) - count(v)) / count(*)"),
        ]
    ).replace(
        rnd("100.0 * (count(*) - count(v)) / count(*)", 6), rnd("100.0 * (count(*) - count(v)) / count(*)", 2)
    )
    + f" FROM ({long_sql('part', ['p_size', 'p_retailprice'])}) GROUP BY feature",
)
def _summary(spark, sf):
    from pyspark.sql import functions as F

    from statloom.functions.exprs import rnd as round_to

    s = describe.statistical_summary(table(spark, sf, "part"), ["p_size", "p_retailprice", "not_there"])
    wide = ["mean", "median", "std", "min", "max", "q25", "q75", "skewness", "kurtosis"]
    return s.select("feature", "count", *[round_to(F.col(c), 6).alias(c) for c in wide], "null_pct")


@query(
    "five_numbers",
    "SELECT feature, count(v) AS count, "
    + ", ".join(
        f"{rnd(e, 2)} AS {n}"
        for n, e in [
            ("mean", "avg(v)"),
            ("std", "stddev_samp(v)"),
            ("min", "min(v)"),
            ("p25", "quantile_cont(v, 0.25)"),
            ("p50", "quantile_cont(v, 0.5)"),
            ("p75", "quantile_cont(v, 0.75)"),
            ("max", "max(v)"),
        ]
    )
    + f" FROM ({long_sql('customer', ['c_custkey', 'c_nationkey', 'c_acctbal'])}) GROUP BY feature",
)
def _five(spark, sf):
    return describe.five_numbers(table(spark, sf, "customer"))


def outliers_sql(src: str, columns: list[str]) -> str:
    return f"""
WITH long AS ({long_sql(src, columns)}),
q AS (SELECT feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(v) AS m, stddev_samp(v) AS s,
             count(v) AS n FROM long GROUP BY feature),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature,
       CAST(count(*) FILTER (v < lo OR v > hi) AS BIGINT) AS iqr_outliers,
       {rnd("100.0 * count(*) FILTER (v < lo OR v > hi) / any_value(n)", 2)} AS iqr_outlier_pct,
       CAST(count(*) FILTER (abs((v - m) / nullif(s, 0)) > 3) AS BIGINT) AS zscore_outliers,
       {rnd("any_value(lo)", 4)} AS lower_bound, {rnd("any_value(hi)", 4)} AS upper_bound
FROM long JOIN b USING (feature) GROUP BY feature"""


@query("outlier_summary", outliers_sql("lineitem", LINEITEM_NUM))
def _outliers(spark, sf):
    return describe.outlier_summary(table(spark, sf, "lineitem"))


@query("outlier_summary_documents", outliers_sql("documents", ["doc_id", "n_chars"]))
def _outliers_docs(spark, sf):
    return describe.outlier_summary(table(spark, sf, "documents").select("doc_id", "n_chars"))


@query(
    "detect_anomalies",
    f"""
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3, avg(n_chars) AS m,
                  stddev_samp(n_chars) AS s, count(n_chars) AS n FROM documents),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
c AS (SELECT count(*) FILTER (n_chars < lo OR n_chars > hi) AS k, count(*) FILTER (abs(n_chars - m) > 3 * s) AS z
      FROM documents, b),
e AS (SELECT string_agg(CAST(n_chars AS VARCHAR), ',' ORDER BY doc_id) AS ex FROM
      (SELECT doc_id, n_chars FROM documents, b WHERE n_chars < lo OR n_chars > hi ORDER BY doc_id LIMIT 5))
SELECT 'n_chars' AS "column", CAST(k AS BIGINT) AS iqr_outliers_count, CAST(z AS BIGINT) AS zscore_outliers_count,
       {rnd("lo", 4)} AS iqr_lower, {rnd("hi", 4)} AS iqr_upper, {rnd("m - 3 * s", 4)} AS zscore_lower,
       {rnd("m + 3 * s", 4)} AS zscore_upper, {rnd("100.0 * k / n", 2)} AS anomaly_pct,
       CASE WHEN k * 1.0 / n > 0.1 THEN 'high' WHEN k > 0 THEN 'medium' ELSE 'none' END AS severity, ex AS examples
FROM c, b, e""",
)
def _anomalies(spark, sf):
    from pyspark.sql import functions as F

    from statloom.functions.exprs import rnd as round_to

    a = describe.detect_anomalies(table(spark, sf, "documents"), "n_chars", order_by=["doc_id"])
    return a.select(
        "column",
        "iqr_outliers_count",
        "zscore_outliers_count",
        *[round_to(F.col(c), 4).alias(c) for c in ("iqr_lower", "iqr_upper", "zscore_lower", "zscore_upper")],
        "anomaly_pct",
        "severity",
        F.concat_ws(",", F.transform("example_anomalies", lambda v: v.cast("long").cast("string"))).alias("examples"),
    )


GROUPS = f"""
SELECT o_orderstatus AS "group", count(o_totalprice) AS count, {rnd("avg(o_totalprice)", 4)} AS mean,
       {rnd("quantile_cont(o_totalprice, 0.5)", 4)} AS median, {rnd("stddev_samp(o_totalprice)", 4)} AS std,
       {rnd("100 * (avg(o_totalprice) - (SELECT avg(o_totalprice) FROM orders)) / (SELECT avg(o_totalprice) FROM orders)", 2)}
       AS vs_overall_pct
FROM orders GROUP BY o_orderstatus"""


def _rounded_groups(spark, sf):
    from pyspark.sql import functions as F

    from statloom.functions.exprs import rnd as round_to

    g = describe.group_comparison(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice")
    return g.select(
        "group", "count", *[round_to(F.col(c), 4).alias(c) for c in ("mean", "median", "std")], "vs_overall_pct"
    )


@query("group_comparison", GROUPS)
def _groups(spark, sf):
    return _rounded_groups(spark, sf)


@query(
    "group_extremes",
    f"""
WITH g AS ({GROUPS})
SELECT CAST(count(*) AS BIGINT) AS group_count, arg_max("group", mean) AS highest_group, max(mean) AS highest_mean,
       arg_min("group", mean) AS lowest_group, min(mean) AS lowest_mean FROM g""",
)
def _extremes(spark, sf):
    return describe.group_extremes(_rounded_groups(spark, sf))
