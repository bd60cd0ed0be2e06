"""Registered queries: profiling, value counts, column heuristics, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import profile
from statloom.plans import bundles
from statloom.plans.describe_queries import LINEITEM_NUM, long_sql
from statloom.plans.registry import query, rnd
from statloom.session import new_folder
from statloom.sources import readers
from statloom.sources.sinks import save_results
from statloom.sources.tables import table

LINEITEM = LINEITEM_NUM + ["l_returnflag", "l_linestatus", "l_shipdate"]
# The same planted defects in both engines: missing cells, repeated rows, stray blanks.
DIRTY_SPARK = [
    "nullif(l_discount, 0.0D) AS l_discount",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax",
    "nullif(l_returnflag, 'N') AS l_returnflag",
    "l_quantity",
]
DIRTY_SQL = """(SELECT nullif(l_discount, 0.0) AS l_discount,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax,
  nullif(l_returnflag, 'N') AS l_returnflag, l_quantity FROM lineitem)"""


def dirty(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(*DIRTY_SPARK)


def profile_sql(src: str, columns: list[str], n_num: int, n_cat: int, n_dt: int) -> str:
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    k = len(columns)
    return f"""
WITH t AS (SELECT {', '.join(columns)} FROM {src}),
a AS (SELECT count(*) AS n, {missing} AS m FROM t),
d AS (SELECT count(*) AS u FROM (SELECT DISTINCT * FROM t))
SELECT CAST(n AS BIGINT) AS n_rows, CAST({k} AS BIGINT) AS n_cols, CAST({n_num} AS BIGINT) AS n_numeric,
       CAST({n_cat} AS BIGINT) AS n_categorical, CAST({n_dt} AS BIGINT) AS n_datetime, CAST(m AS BIGINT) AS missing_cells,
       {rnd(f"100.0 * m / (n * {k})", 2)} AS missing_pct, CAST(n - u AS BIGINT) AS duplicate_rows,
       {rnd("100.0 * (n - u) / n", 2)} AS duplicate_pct FROM a, d"""


@query("profile_dataset", profile_sql("lineitem", LINEITEM, 8, 2, 1))
def _profile(spark, sf):
    return profile.profile_dataset(table(spark, sf, "lineitem"))


@query("profile_dataset_dirty", profile_sql(DIRTY_SQL, ["l_discount", "l_tax", "l_returnflag", "l_quantity"], 3, 1, 0))
def _profile_dirty(spark, sf):
    return profile.profile_dataset(dirty(spark, sf))


@query("profile_documents_text_copies", profile_sql("documents", ["text", "lang"], 0, 2, 0))
def _profile_docs(spark, sf):
    return profile.profile_dataset(table(spark, sf, "documents").select("text", "lang"))


@query(
    "missing_analysis",
    "SELECT feature, CAST(m AS BIGINT) AS missing, "
    + rnd("100.0 * m / n", 2)
    + " AS missing_pct, dtype FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS m, count(*) AS n, '{t}' AS dtype FROM {DIRTY_SQL}"
        for c, t in [("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "string"), ("l_quantity", "float")]
    )
    + ") WHERE m > 0",
)
def _missing(spark, sf):
    return profile.missing_analysis(dirty(spark, sf))


def cat_sql(src: str, columns: list[str]) -> str:
    return f"""
WITH long AS ({long_sql(src, columns, text=True)}),
c AS (SELECT feature, v, count(*) AS k FROM long WHERE v IS NOT NULL GROUP BY feature, v),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY k DESC, v) AS rn, sum(k) OVER (PARTITION BY feature) AS n FROM c),
m AS (SELECT feature, count(*) - count(v) AS missing FROM long GROUP BY feature)
SELECT feature, CAST(count(*) AS BIGINT) AS n_unique, CAST(any_value(missing) AS BIGINT) AS missing,
       max(v) FILTER (rn = 1) AS mode, CAST(max(k) FILTER (rn = 1) AS BIGINT) AS mode_freq,
       {rnd("100.0 * max(k) FILTER (rn = 1) / any_value(n)", 2)} AS mode_pct,
       {rnd("abs(-sum(k * 1.0 / n * log2(k * 1.0 / n)))", 3)} AS entropy_bits
FROM r JOIN m USING (feature) GROUP BY feature"""


@query("categorical_summary", cat_sql("lineitem", ["l_returnflag", "l_linestatus"]))
def _categorical(spark, sf):
    return profile.categorical_summary(table(spark, sf, "lineitem"))


@query("categorical_summary_documents", cat_sql("documents", ["text", "lang", "source"]))
def _categorical_docs(spark, sf):
    return profile.categorical_summary(table(spark, sf, "documents"))


@query("categorical_summary_missing", cat_sql(DIRTY_SQL, ["l_returnflag"]))
def _categorical_dirty(spark, sf):
    return profile.categorical_summary(dirty(spark, sf))


@query(
    "frequency_distribution",
    f"""SELECT p_brand AS value, count(*) AS count, {rnd("100.0 * count(*) / (SELECT count(*) FROM part)", 2)} AS pct
FROM part GROUP BY p_brand ORDER BY count DESC, value LIMIT 20""",
)
def _frequency(spark, sf):
    return profile.frequency_distribution(table(spark, sf, "part"), "p_brand")


@query(
    "frequency_facts",
    """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS v, count(*) AS k FROM events GROUP BY user_id)
SELECT 'user_id' AS "column", CAST(count(*) AS BIGINT) AS unique_values, CAST(sum(k) AS BIGINT) AS total_non_null,
       CAST(0 AS BIGINT) AS null_count, (SELECT v FROM c ORDER BY k DESC, v LIMIT 1) AS most_common,
       (SELECT v FROM c ORDER BY k, v DESC LIMIT 1) AS least_common, count(*) > 50 AS is_high_cardinality FROM c""",
)
def _frequency_facts(spark, sf):
    return profile.frequency_facts(table(spark, sf, "events"), "user_id")


@query(
    "top_values",
    f"""WITH c AS (SELECT feature, v, count(*) AS k FROM
({long_sql('part', ['p_name', 'p_brand', 'p_type'], text=True)}) GROUP BY feature, v),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY k DESC, v) AS rn FROM c)
SELECT feature, CAST(rn AS BIGINT) AS rank, v AS value, CAST(k AS BIGINT) AS count FROM r WHERE rn <= 5""",
)
def _top_values(spark, sf):
    return profile.top_values(table(spark, sf, "part"))


def _friendly(t: str) -> str:
    return {"b": "integer", "d": "float", "s": "string", "t": "datetime"}[t]


ORDERS = [
    ("o_orderkey", "b"),
    ("o_custkey", "b"),
    ("o_orderstatus", "s"),
    ("o_totalprice", "d"),
    ("o_orderdate", "t"),
    ("o_orderpriority", "s"),
]


@query(
    "column_overview",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{_friendly(t)}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS missing,
{rnd(f"100.0 * (count(*) - count({c})) / count(*)", 1)} AS missing_pct, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique,
CAST(arg_min({c}, s_suppkey) AS VARCHAR) AS sample FROM supplier"""
        for c, t in [("s_suppkey", "b"), ("s_name", "s"), ("s_nationkey", "b")]
    ),
)
def _overview(spark, sf):
    df = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return profile.column_overview(df, order_by=["s_suppkey"])


@query(
    "column_schema",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{_friendly(t)}' AS dtype, count(*) > count({c}) AS nullable,
CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
(SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS x FROM {src} WHERE {c} IS NOT NULL
 ORDER BY x LIMIT 5)) AS samples FROM {src}"""
        for c, t, src in [
            ("l_discount", "d", DIRTY_SQL),
            ("l_tax", "d", DIRTY_SQL),
            ("l_returnflag", "s", DIRTY_SQL),
            ("l_quantity", "d", DIRTY_SQL),
        ]
    ),
)
def _schema(spark, sf):
    s = profile.column_schema(dirty(spark, sf))
    return s.withColumn("samples", F.concat_ws("|", "sample_values")).drop("sample_values")


def column_stats_sql(src: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in columns:
        if t in "bd":
            num = f"CAST({c} AS DOUBLE)"
        elif t == "s":
            num = f"TRY_CAST({c} AS DOUBLE)"
        else:
            num = "CAST(NULL AS DOUBLE)"
        text = f"strftime(min({c}), '%Y-%m-%dT%H:%M:%S')" if t == "t" else f"CAST(min({c}) AS VARCHAR)"
        text_hi = text.replace("min(", "max(")
        parts.append(
            f"""SELECT '{c}' AS feature, '{_friendly(t)}' AS dtype, {rnd(f"100.0 * (count(*) - count({c})) / count(*)", 2)} AS null_pct,
CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, min({num}) AS min, max({num}) AS max, {rnd(f"avg({num})", 4)} AS mean,
{rnd(f"stddev_samp({num})", 4)} AS std, CASE WHEN count({num}) = 0 THEN {text} END AS min_text,
CASE WHEN count({num}) = 0 THEN {text_hi} END AS max_text FROM {src}"""
        )
    return " UNION ALL ".join(parts)


@query("column_statistics", column_stats_sql("orders", ORDERS))
def _column_stats(spark, sf):
    return profile.column_statistics(table(spark, sf, "orders"))


NUMBERISH = "(SELECT CASE WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 1, 1) ELSE o_orderstatus END AS code FROM orders)"


@query("column_statistics_number_text", column_stats_sql(NUMBERISH, [("code", "s")]))
def _column_stats_text(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 1, 1) ELSE o_orderstatus END AS code"
    )
    return profile.column_statistics(df)


@query(
    "table_summary",
    f"""SELECT feature, dtype, null_pct, unique_count, mean, std, min, max,
CASE WHEN mean IS NULL THEN (SELECT string_agg(x, '|' ORDER BY x) FROM (
  SELECT DISTINCT CASE WHEN feature = 'o_orderstatus' THEN o_orderstatus WHEN feature = 'o_orderpriority' THEN o_orderpriority
  ELSE CAST(o_orderdate AS VARCHAR) END AS x FROM orders ORDER BY x LIMIT 5)) END AS samples,
unique_count < 30 AND dtype = 'string' AS likely_categorical,
feature LIKE '%date%' OR feature LIKE '%time%' AS likely_datetime
FROM ({column_stats_sql("orders", ORDERS)}) s""",
)
def _table_summary(spark, sf):
    s = profile.table_summary(table(spark, sf, "orders"))
    return s.withColumn(
        "samples", F.when(F.col("sample_values").isNotNull(), F.concat_ws("|", "sample_values"))
    ).drop("sample_values")


@query(
    "upload_quality",
    f"""WITH a AS (SELECT count(*) AS n, CAST(floor({rnd("100.0 * (count(*) - count(tax)) / count(*)", 2)} / 100 * count(*)) AS BIGINT) AS m,
count(DISTINCT o_key) AS u, count(*) AS c FROM (SELECT o_orderkey AS o_key, o_orderdate AS created_at,
CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS tax FROM orders))
SELECT CAST(n AS BIGINT) AS row_count, CAST(3 AS BIGINT) AS column_count, {rnd("100.0 * m / (n * 3)", 2)} AS overall_null_rate_pct,
{rnd(f"(100.0 - {rnd('100.0 * m / (n * 3)', 2)}) / 100.0", 3)} AS quality_score, 'created_at' AS dates,
CASE WHEN u = c THEN 'o_key' ELSE '' END AS ids FROM a""",
)
def _upload_quality(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS o_key",
        "o_orderdate AS created_at",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS tax",
    )
    q = profile.upload_quality(df)
    return q.select(
        "row_count",
        "column_count",
        "overall_null_rate_pct",
        "quality_score",
        F.concat_ws("|", "likely_datetime_columns").alias("dates"),
        F.concat_ws("|", "likely_id_columns").alias("ids"),
    )


WARNED_TABLES = ["region", "nation", "orders", "lineitem", "documents"]


@query(
    "structure_notes",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, 'few_rows' AS warning,
'only ' || count(*) || ' rows; modeling needs at least 20' AS detail FROM {t} HAVING count(*) < 20"""
        for t in WARNED_TABLES
    ),
)
def _warnings(spark, sf):
    found = [
        profile.health_warnings(table(spark, sf, t)).select(F.lit(t).alias("dataset"), "warning", "detail")
        for t in WARNED_TABLES
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@query(
    "chart_column_picks",
    f"""WITH v AS (SELECT feature, var_samp(v) AS s FROM ({long_sql('lineitem', LINEITEM_NUM)}) GROUP BY feature),
d AS (SELECT feature, count(DISTINCT v) AS u FROM ({long_sql('lineitem', ['l_returnflag', 'l_linestatus'], text=True)}) GROUP BY feature)
SELECT (SELECT feature FROM v ORDER BY s DESC LIMIT 1) AS top_variance,
(SELECT feature FROM v ORDER BY s DESC LIMIT 1 OFFSET 1) AS second_variance,
(SELECT feature FROM d ORDER BY u LIMIT 1) AS low_cardinality""",
)
def _picks(spark, sf):
    return profile.chart_column_picks(table(spark, sf, "lineitem"))


SOURCE_PROFILES = """SELECT d.source, avg(coalesce(1.0 - l.toxic, 1.0)) AS quality_score,
count(DISTINCT d.lang) AS insight_count, count(CASE WHEN l.quality = 0 THEN 1 END) AS anomaly_count, count(*) AS row_count
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source"""


@query(
    "health_score",
    f"""WITH p AS ({SOURCE_PROFILES}),
s AS (SELECT *, quality_score * 40 AS q, least(insight_count / 5.0, 1.0) * 30 AS i,
greatest(0.0, 15 - anomaly_count * 1.0 / row_count * 1000) AS a, least(log10(row_count) / 4, 1.0) * 15 AS z FROM p)
SELECT source, {rnd("quality_score", 6)} AS quality_score, CAST(row_count AS BIGINT) AS row_count, {rnd("q + i + a + z", 1)} AS overall_score,
CASE WHEN q + i + a + z >= 80 THEN 'A' WHEN q + i + a + z >= 65 THEN 'B' WHEN q + i + a + z >= 50 THEN 'C' ELSE 'D' END AS grade,
CASE WHEN q + i + a + z >= 80 THEN 'Excellent' WHEN q + i + a + z >= 65 THEN 'Good' WHEN q + i + a + z >= 50 THEN 'Fair'
ELSE 'Needs Improvement' END AS label,
{rnd("q", 1)} AS data_quality, {rnd("i", 1)} AS insight_richness, {rnd("a", 1)} AS anomaly_score, {rnd("z", 1)} AS dataset_size_score
FROM s""",
)
def _health(spark, sf):
    from statloom.functions.exprs import rnd as round_to

    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    profiles = (
        docs.join(labels, "doc_id", "left")
        .groupBy("source")
        .agg(
            F.avg(F.coalesce(1.0 - F.col("toxic"), F.lit(1.0))).alias("quality_score"),
            F.countDistinct("lang").alias("insight_count"),
            F.count_if(F.col("quality") == 0).alias("anomaly_count"),
            F.count("*").alias("row_count"),
        )
    )
    return profile.health_score(profiles).select(
        "source",
        round_to(F.col("quality_score"), 6).alias("quality_score"),
        "row_count",
        "overall_score",
        "grade",
        "label",
        "data_quality",
        "insight_richness",
        "anomaly_score",
        "dataset_size_score",
    )


@query(
    "key_takeaways",
    f"""WITH i AS (SELECT lang, source AS title, CAST(count(*) AS VARCHAR) || ' documents' AS description,
CASE WHEN avg(n_chars) > 2000 THEN 'high' WHEN avg(n_chars) > 800 THEN 'medium' ELSE 'low' END AS importance,
count(*) * 1.0 / 1000000 AS confidence FROM documents GROUP BY lang, source),
s AS (SELECT *, CASE importance WHEN 'high' THEN 3 WHEN 'low' THEN 1 ELSE 2 END * confidence AS score FROM i),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, title) AS rn FROM s)
SELECT lang, {rnd("score", 6)} AS score, title || ': ' || description AS takeaway FROM r WHERE rn <= 5""",
)
def _takeaways(spark, sf):
    from statloom.functions.exprs import rnd as round_to

    insights = (
        table(spark, sf, "documents")
        .groupBy("lang", F.col("source").alias("title"))
        .agg(
            F.concat(F.count("*").cast("string"), F.lit(" documents")).alias("description"),
            F.when(F.avg("n_chars") > 2000, "high").when(F.avg("n_chars") > 800, "medium").otherwise("low").alias("importance"),
            (F.count("*") / 1000000).alias("confidence"),
        )
    )
    out = profile.key_takeaways(insights, 5, ["lang"])
    return out.withColumn("score", round_to(F.col("score"), 6))


# ---- sources and sinks ----------------------------------------------------------------------------


# Texts with quotes, commas and line breaks, the same expression in both engines.
QUOTED = """CASE doc_id % 4 WHEN 0 THEN 'she said "yes", ' || text WHEN 1 THEN text || chr(10) || '"' ELSE text END"""


@query("csv_round_trip", f"SELECT doc_id, lang, md5({QUOTED}) AS text_md5, n_chars FROM documents")
def _csv_round_trip(spark, sf):
    df = table(spark, sf, "documents").selectExpr("doc_id", "lang", f"{QUOTED} AS text", "n_chars")
    path = new_folder(spark, "csv")
    df.coalesce(1).write.csv(path, header=True, quote='"', escape='"')  # one file, read by many tasks
    back = readers.read_delimited(spark, path)
    return back.select(F.col("doc_id").cast("long"), "lang", F.md5("text").alias("text_md5"), F.col("n_chars").cast("long"))


@query(
    "csv_headers",
    "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS key_2, n_name || '!' AS name_2 FROM nation",
    # names repeat in the file and are numbered on reading
)
def _csv_headers(spark, sf):
    path = new_folder(spark, "csv")
    nation = table(spark, sf, "nation")
    nation.select(
        F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string"), F.concat("n_name", F.lit("!")))
        .alias("value")
    ).write.text(f"{path}/rows")
    header = spark.sql("SELECT 'key,name,key,name' AS value")
    lines = header.withColumn("o", F.lit(0)).unionByName(spark.read.text(f"{path}/rows").withColumn("o", F.lit(1)))
    lines.coalesce(1).sortWithinPartitions("o").select("value").write.text(f"{path}/file")
    return readers.read_delimited(spark, f"{path}/file")


@query(
    "json_lines_round_trip",
    "SELECT page_id, md5(url) AS url_md5, md5(html) AS html_md5 FROM pages",
)
def _json_lines(spark, sf):
    path = f"{new_folder(spark, 'json')}.jsonl"
    table(spark, sf, "pages").write.json(path)
    back = readers.read_table(spark, path)
    return back.select("page_id", F.md5("url").alias("url_md5"), F.md5("html").alias("html_md5"))


@query(
    "stored_results",
    """SELECT CAST('orders' AS VARCHAR) AS dataset_id, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'lineitem', l_linestatus, count(*) FROM lineitem GROUP BY 2""",
)
def _stored(spark, sf):
    path = new_folder(spark, "results")
    for name, column in (("orders", "o_orderstatus"), ("lineitem", "l_linestatus")):
        counts = table(spark, sf, name).groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n"))
        save_results({"counts": counts}, path, name)
    return spark.read.parquet(f"{path}/counts").select("dataset_id", "status", "n")


@query(
    "study_contexts",
    """SELECT source AS dataset, title, domain, target_column, sensitive_column, CAST(positive_label AS INTEGER) AS positive_label FROM (
SELECT DISTINCT source, 'Data Science Analysis' AS title, 'General' AS domain, CAST(NULL AS VARCHAR) AS target_column, CAST(NULL AS VARCHAR) AS sensitive_column, 1 AS positive_label FROM documents
UNION ALL SELECT 'Heart Disease', 'Heart Disease Prediction Study', 'Clinical / Healthcare', 'target', 'sex', 1)""",
)
def _contexts(spark, sf):
    names = table(spark, sf, "documents").select(F.col("source").alias("dataset")).distinct()
    return bundles.contexts_for(names.unionByName(spark.sql("SELECT 'Heart Disease' AS dataset")))
