"""Registered queries: cleaning steps on tables with planted defects."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.exprs import rnd as round_to
from statloom.operators import cleaning
from statloom.operators.cleaning import CleaningRun
from statloom.plans.profile_queries import DIRTY_SQL, dirty
from statloom.plans.registry import query, rnd
from statloom.sources.tables import table

# Row key, one column with gaps and one without.
GAPS_SPARK = ["l_orderkey", "l_linenumber", "l_partkey", "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price"]
GAPS_SQL = "(SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price FROM lineitem)"


def gaps(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(*GAPS_SPARK)


def _impute(strategy, fill_sql, **options):
    @query(
        f"impute_{strategy}",
        f"SELECT l_orderkey, l_linenumber, l_partkey, {rnd(f'coalesce(price, {fill_sql})', 4)} AS price FROM {GAPS_SQL}",
    )
    def run(spark, sf):
        r = CleaningRun(gaps(spark, sf))
        r.impute_missing("price", strategy, **options)
        return r.df.withColumn("price", round_to(F.col("price"), 4))

    return run


_impute("mean", f"(SELECT avg(price) FROM {GAPS_SQL})")
_impute("median", f"(SELECT quantile_cont(price, 0.5) FROM {GAPS_SQL})")
_impute(
    "mode",
    f"(SELECT price FROM (SELECT price, count(*) AS k FROM {GAPS_SQL} WHERE price IS NOT NULL GROUP BY price ORDER BY k DESC, price LIMIT 1))",
)
_impute("constant", "-1.0", value=-1.0)


@query("impute_drop", f"SELECT * FROM {GAPS_SQL} WHERE price IS NOT NULL")
def _impute_drop(spark, sf):
    r = CleaningRun(gaps(spark, sf))
    r.impute_missing("price", "drop")
    return r.df


def _fill(name, strategy, keys, fn, frame):
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""

    @query(
        name,
        f"""WITH e AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value, ts FROM events)
SELECT event_id, user_id, event_type,
{fn}(value IGNORE NULLS) OVER ({part}ORDER BY ts, event_id ROWS BETWEEN {frame}) AS value FROM e""",
    )
    def run(spark, sf):
        df = table(spark, sf, "events").selectExpr(
            "event_id", "user_id", "event_type", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value", "ts"
        )
        r = CleaningRun(df)
        r.impute_missing("value", strategy, order_by="ts", keys=keys, tie="event_id")
        return r.df.drop("ts")

    return run


_fill("impute_ffill", "ffill", [], "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
_fill("impute_bfill", "bfill", [], "first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")
_fill("impute_ffill_per_user", "ffill", ["user_id"], "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
_fill("impute_bfill_per_type", "bfill", ["event_type"], "first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")


@query("drop_duplicates_whole_row", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _dedup(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").select("o_custkey", "o_orderstatus"))
    r.drop_duplicates()
    return r.df


@query(
    "drop_duplicates_subset",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER
(PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _dedup_subset(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").drop("o_orderpriority"))
    r.drop_duplicates(["o_custkey", "o_orderstatus"], order_by=["o_orderdate", "o_orderkey"])
    return r.df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


CODE = "CASE WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 1, 1) WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE CAST(o_totalprice AS {t}) END"


@query(
    "fix_dtype_numeric",
    f"SELECT o_orderkey, TRY_CAST({CODE.format(t='VARCHAR')} AS DOUBLE) AS code FROM orders",
)
def _fix_numeric(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").selectExpr("o_orderkey", CODE.format(t="STRING") + " AS code"))
    r.fix_dtype("code", "numeric")
    return r.df


DATE_TEXT = "CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE substr(CAST(o_orderdate AS {t}), 1, 10) END"


@query(
    "fix_dtype_datetime",
    f"SELECT o_orderkey, strftime(TRY_CAST({DATE_TEXT.format(t='VARCHAR')} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS d FROM orders",
)
def _fix_datetime(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").selectExpr("o_orderkey", DATE_TEXT.format(t="STRING") + " AS d"))
    r.fix_dtype("d", "datetime")
    return r.df.withColumn("d", F.date_format("d", "yyyy-MM-dd HH:mm:ss"))


@query("fix_dtype_string", "SELECT o_orderkey, trim('  ' || o_orderpriority || ' ') AS p FROM orders")
def _fix_string(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").selectExpr("o_orderkey", "'  ' || o_orderpriority || ' ' AS p"))
    r.fix_dtype("p", "string")
    return r.df


FLAG = "CASE o_orderkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'False' WHEN 4 THEN o_orderstatus END"


@query(
    "fix_dtype_boolean",
    f"""SELECT o_orderkey, CASE WHEN lower(f) IN ('true', '1', 'yes') THEN true WHEN lower(f) IN ('false', '0', 'no') THEN false END AS f
FROM (SELECT o_orderkey, {FLAG} AS f FROM orders)""",
)
def _fix_boolean(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").selectExpr("o_orderkey", f"{FLAG} AS f"))
    r.fix_dtype("f", "boolean")
    return r.df


@query(
    "fix_dtype_category",
    """SELECT c_custkey, c_mktsegment, CAST((SELECT count(DISTINCT x.c_mktsegment) FROM customer x
WHERE x.c_mktsegment < c.c_mktsegment) AS BIGINT) AS c_mktsegment_code FROM customer c""",
)
def _fix_category(spark, sf):
    r = CleaningRun(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"))
    r.fix_dtype("c_mktsegment", "category")
    return r.df


@query(
    "fix_dtype_failures",
    f"""SELECT CAST(1 AS INTEGER) AS step, 'fix_dtype' AS action_type, 'code' AS "column", CAST(count(*) AS BIGINT) AS rows_affected,
CAST(count(*) FILTER (c IS NOT NULL AND TRY_CAST(c AS DOUBLE) IS NULL) AS BIGINT) AS failed_conversions
FROM (SELECT {CODE.format(t='VARCHAR')} AS c FROM orders)""",
)
def _fix_failures(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").selectExpr(CODE.format(t="STRING") + " AS code"))
    result = r.fix_dtype("code", "numeric")
    return r.audit().select(
        "step", "action_type", "column", "rows_affected", F.lit(result["failed_conversions"]).cast("long").alias("failed_conversions")
    )


IQR = "SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents"
BOUNDS = {
    "iqr": f"(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM ({IQR}))",
    "zscore": "(SELECT avg(n_chars) - 3 * stddev_samp(n_chars) AS lo, avg(n_chars) + 3 * stddev_samp(n_chars) AS hi FROM documents)",
}
ACTIONS = {
    "cap": f"SELECT doc_id, {rnd('CASE WHEN n_chars < lo THEN lo WHEN n_chars > hi THEN hi ELSE n_chars END', 4)} AS n_chars FROM documents, {{b}}",
    "drop": "SELECT doc_id, n_chars FROM documents, {b} WHERE n_chars IS NULL OR n_chars BETWEEN lo AND hi",
    "flag": "SELECT doc_id, n_chars, coalesce(n_chars < lo OR n_chars > hi, false) AS n_chars_is_outlier FROM documents, {b}",
}


def _outlier_query(method, action):
    @query(f"handle_outliers_{method}_{action}", ACTIONS[action].format(b=BOUNDS[method]))
    def run(spark, sf):
        r = CleaningRun(table(spark, sf, "documents").select("doc_id", "n_chars"))
        r.handle_outliers("n_chars", method, action)
        return r.df.withColumn("n_chars", round_to(F.col("n_chars"), 4)) if action == "cap" else r.df

    return run


for _method in BOUNDS:
    for _action in ACTIONS:
        _outlier_query(_method, _action)


@query(
    "normalize_minmax",
    f"""SELECT o_orderkey, {rnd("(o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders)", 6)}
AS o_totalprice FROM orders""",
)
def _minmax(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    r.normalize("o_totalprice", "minmax")
    return r.df.withColumn("o_totalprice", round_to(F.col("o_totalprice"), 6))


@query(
    "normalize_zscore",
    f"""SELECT o_orderkey, {rnd("(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_samp(o_totalprice) FROM orders)", 6)}
AS o_totalprice FROM orders""",
)
def _zscore(spark, sf):
    r = CleaningRun(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    r.normalize("o_totalprice", "zscore")
    return r.df.withColumn("o_totalprice", round_to(F.col("o_totalprice"), 6))


@query("trim_strings", "SELECT c_custkey, c_mktsegment FROM customer")
def _trim(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "'  ' || c_mktsegment || ' \t' AS c_mktsegment")
    return cleaning.trim_strings(df)


@query(
    "drop_empty_rows_and_columns",
    "SELECT price FROM (SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price FROM lineitem) WHERE price IS NOT NULL",
)
def _drop_empty(spark, sf):
    from statloom.sources.readers import drop_empty

    df = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price", "CAST(NULL AS STRING) AS nothing"
    )
    return drop_empty(df)


DIRTY_TYPES = [("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "string"), ("l_quantity", "float")]
FILLED = " + ".join(f"count({c})" for c, _ in DIRTY_TYPES)


@query(
    "validate_schema",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{t}' AS dtype, {rnd(f"100.0 * (count(*) - count({c})) / count(*)", 1)} AS null_pct,
CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, count({c}) = 0 AS all_null, count(DISTINCT {c}) <= 1 AS constant,
{rnd(f"100 * (({FILLED}) / (count(*) * 4.0))", 2)} AS completeness_pct, {rnd(f"({FILLED}) / (count(*) * 4.0)", 3)} AS quality_score FROM {DIRTY_SQL}"""
        for c, t in DIRTY_TYPES
    ),
)
def _validate(spark, sf):
    return cleaning.validate_schema(dirty(spark, sf))


CLEAN_SOURCE_SPARK = [
    "o_custkey",
    "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status",
    "'  ' || o_orderpriority || ' ' AS priority",
    "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS bucket",
    "CAST(NULL AS STRING) AS nothing",
]
CLEAN_DEDUP = """(SELECT DISTINCT o_custkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status,
trim(o_orderpriority) AS priority, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS bucket FROM orders)"""


def _clean(spark, sf):
    return cleaning.clean(table(spark, sf, "orders").selectExpr(*CLEAN_SOURCE_SPARK))


@query(
    "auto_clean",
    f"""WITH d AS {CLEAN_DEDUP}
SELECT o_custkey, coalesce(status, (SELECT status FROM d WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1))
AS status, priority, coalesce(bucket, (SELECT quantile_cont(bucket, 0.5) FROM d)) AS bucket FROM d""",
)
def _auto_clean(spark, sf):
    return _clean(spark, sf)[0]


@query(
    "auto_clean_audit_summary",
    f"""WITH d AS {CLEAN_DEDUP}, n AS (SELECT count(*) AS n FROM orders),
a AS (SELECT 'drop_empty_column' AS action_type, n AS k FROM n
UNION ALL SELECT 'drop_duplicates', n - (SELECT count(*) FROM d) FROM n
UNION ALL SELECT 'impute_missing', count(*) - count(status) FROM d UNION ALL SELECT 'impute_missing', count(*) - count(bucket) FROM d)
SELECT action_type, CAST(count(*) AS BIGINT) AS steps, CAST(sum(k) AS BIGINT) AS rows_affected FROM a GROUP BY action_type""",
)
def _auto_clean_audit(spark, sf):
    audit = _clean(spark, sf)[1]
    return audit.groupBy("action_type").agg(F.count("*").alias("steps"), F.sum("rows_affected").alias("rows_affected"))


@query("interaction_feature", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('l_quantity * l_discount', 6)} AS l_quantity_x_l_discount FROM lineitem")
def _interaction(spark, sf):
    df = cleaning.interaction(table(spark, sf, "lineitem"), "l_quantity", "l_discount")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", round_to(F.col("l_quantity_x_l_discount"), 6).alias("l_quantity_x_l_discount")
    )


@query(
    "json_safe_values",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts,
CASE WHEN event_id % 4 IN (0, 1) THEN NULL ELSE value END AS value FROM events""",
)
def _json_safe(spark, sf):
    from statloom.functions.exprs import json_safe

    df = table(spark, sf, "events").selectExpr(
        "event_id",
        "ts",
        "CASE event_id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN double('-Infinity') ELSE value END AS value",
    )
    return json_safe(df)
