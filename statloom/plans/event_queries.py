"""Registered queries: message texts, catalogue listings, event streams, composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions import text
from statloom.functions.exprs import rnd as round_to
from statloom.operators import catalog
from statloom.plans import bundles
from statloom.plans.model_queries import training_frame
from statloom.plans.registry import query, rnd
from statloom.sources.tables import table
from statloom.streaming import events as streams


def _shown(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ---- texts ----------------------------------------------------------------------------------

# Messages with requests planted by turn, the same expression in both engines.
REQUEST = """text || CASE turn % 7 WHEN 0 THEN ' Please predict the Lang now' WHEN 1 THEN ' clean the source column' WHEN 2 THEN ' Draw a HEATMAP'
WHEN 3 THEN ' full report please' WHEN 4 THEN ' any outlier in n_chars?' WHEN 5 THEN ' forecast Quality of source' ELSE '' END"""


def _messages(spark, sf):
    return table(spark, sf, "conversations").selectExpr("conv_id", "turn", "role", f"{REQUEST} AS text")


def _intent_sql() -> str:
    whens = []
    for intent, words in text.INTENT_WORDS.items():
        hits = " OR ".join(f"contains(m, '{w}')" for w in words)
        whens.append(f"WHEN {hits} THEN '{intent}'")
    return "CASE " + " ".join(whens) + f" ELSE '{text.DEFAULT_INTENT}' END"


@query(
    "tag_intent",
    f"SELECT role, {_intent_sql()} AS intent, count(*) AS count FROM (SELECT role, ' ' || lower({REQUEST}) || ' ' AS m FROM conversations) GROUP BY 1, 2",
)
def _intents(spark, sf):
    tagged = _messages(spark, sf).select("role", text.tag_intent(F.col("text")).alias("intent"))
    return tagged.groupBy("role", "intent").count()


@query(
    "tag_intent_documents",
    f"SELECT doc_id, {_intent_sql()} AS intent FROM (SELECT doc_id, ' ' || lower(text) || ' ' AS m FROM documents)",
)
def _intents_docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.tag_intent(F.col("text")).alias("intent"))


MENTIONED = ["lang", "source", "n_chars", "quality"]


def _mention_sql() -> str:
    phrase = r"trim(regexp_extract(m, '(?:predict|model|target|classify|forecast)\s+(?:the\s+)?([\w ]+)', 1))"
    parts = [f"CASE WHEN {phrase} <> '' AND contains({phrase}, '{n}') THEN '{n}' END" for n in MENTIONED]
    parts += [rf"CASE WHEN regexp_matches(m, '\b{n}\b') THEN '{n}' END" for n in MENTIONED]
    return f"coalesce({', '.join(parts)})"


@query("extract_mention", f"SELECT conv_id, turn, {_mention_sql()} AS mention FROM (SELECT conv_id, turn, lower({REQUEST}) AS m FROM conversations)")
def _mentions(spark, sf):
    return _messages(spark, sf).select("conv_id", "turn", text.extract_mention(F.col("text"), MENTIONED).alias("mention"))


WRAPPED = """CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN 'Here it is: ```json\n' || props || '\n``` done' WHEN 2 THEN 'so ' || props || ' ok'
WHEN 3 THEN 'list [1, 2, ' || CAST(user_id AS {t}) || '] end' WHEN 4 THEN 'broken {{"k": ' ELSE event_type END"""
SQL_BLOCKS = [
    "trim(x)",
    r"trim(regexp_extract(x, '```(?:json)?\s*\n?([\s\S]*?)\n?```', 1, 'i'))",
    r"regexp_extract(x, '(\{[\s\S]*\})', 1)",
    r"regexp_extract(x, '(\[[\s\S]*\])', 1)",
]


@query(
    "extract_json",
    "SELECT event_id, coalesce("
    + ", ".join(f"CASE WHEN {b} <> '' AND json_valid({b}) THEN {b} END" for b in SQL_BLOCKS)
    + f") AS found FROM (SELECT event_id, {WRAPPED.format(t='VARCHAR')} AS x FROM events)",
)
def _json(spark, sf):
    wrapped = (
        F.when(F.col("event_id") % 6 == 0, F.col("props"))
        .when(F.col("event_id") % 6 == 1, F.concat(F.lit("Here it is: ```json\n"), "props", F.lit("\n``` done")))
        .when(F.col("event_id") % 6 == 2, F.concat(F.lit("so "), "props", F.lit(" ok")))
        .when(F.col("event_id") % 6 == 3, F.concat(F.lit("list [1, 2, "), F.col("user_id").cast("string"), F.lit("] end")))
        .when(F.col("event_id") % 6 == 4, F.lit('broken {"k": '))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf, "events").select("event_id", text.extract_json(wrapped).alias("found"))


# Seven ways to hold JSON, or nearly, in a text; the same expression in both engines.
PLANTED = """CASE {n} % 7 WHEN 0 THEN text
WHEN 1 THEN '{{"text": ' || size || ', "list": [1, 2.5e3, null]}}' || chr(10)
WHEN 2 THEN text || chr(10) || '```json' || chr(10) || '[{{"k": 1}}, 2]' || chr(10) || '```'
WHEN 3 THEN '{{"a": 1}} and {{"b": ' || size || '}}'
WHEN 4 THEN '{{"a": 1, "a": ' || size || '}}'
WHEN 5 THEN 'see [1, [2, ' || size || ']] '
ELSE '1] , [' || size END"""
SQL_STRIPPED = [r"regexp_replace(x, '^\s+|\s+$', '', 'g')", rf"regexp_replace({SQL_BLOCKS[1][5:-1]}, '^\s+|\s+$', '', 'g')", *SQL_BLOCKS[2:]]


def _json_texts(name: str, source: str, keys: list[str], number: str) -> None:
    found = ", ".join(f"CASE WHEN {b} <> '' AND json_valid({b}) THEN {b} END" for b in SQL_STRIPPED)
    x, listed = PLANTED.format(n=number), ", ".join(keys)

    @query(
        name,
        f"""SELECT {listed}, md5(coalesce({found})) AS found
FROM (SELECT {listed}, {x} AS x FROM (SELECT *, CAST(length(text) AS VARCHAR) AS size FROM {source}))""",
    )
    def run(spark, sf):
        rows = table(spark, sf, source).withColumn("size", F.length("text").cast("string"))
        return rows.select(*keys, F.md5(text.extract_json(F.expr(x))).alias("found"))


_json_texts("extract_json_documents", "documents", ["doc_id"], "doc_id")
_json_texts("extract_json_conversations", "conversations", ["conv_id", "turn"], "(conv_id + turn)")


# ---- listings and roll-ups -------------------------------------------------------------------------


@query(
    "session_runs_left_join",
    """SELECT c.c_custkey, count(o.o_orderkey) AS runs, CAST(count(*) AS BIGINT) AS rows FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey""",
)
def _eager(spark, sf):
    joined = catalog.with_children(table(spark, sf, "customer"), table(spark, sf, "orders"), "c_custkey", "o_custkey")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("runs"), F.count("*").alias("rows"))


@query(
    "report_parts_in_order",
    """SELECT r_regionkey, r_name, n_nationkey, n_name FROM region LEFT JOIN nation ON r_regionkey = n_regionkey""",
)
def _report_parts(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return catalog.ordered_children(table(spark, sf, "region"), nations, "r_regionkey", ["n_name"])


@query(
    "listing_page",
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40""",
)
def _page(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = catalog.page(df, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3, 20)
    return found.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "event_replay",
    """SELECT event_id, user_id, event_type FROM events WHERE user_id = (SELECT min(user_id) FROM events)""",
)
def _replay(spark, sf):
    df = table(spark, sf, "events")
    first = df.agg(F.min("user_id")).first()[0]
    return catalog.replay(df, F.col("user_id") == first, ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query(
    "concatenated_tables",
    """SELECT c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier""",
)
def _concat(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_nationkey AS nationkey", "c_acctbal AS acctbal", "c_mktsegment AS segment")
    b = table(spark, sf, "supplier").selectExpr("s_nationkey AS nationkey", "s_acctbal AS acctbal")
    return catalog.concatenate([a, b])


@query("distinct_values", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL")
def _distinct(spark, sf):
    return catalog.distinct_values(table(spark, sf, "part"), "p_brand")


@query(
    "session_rollup",
    """SELECT count(*) AS sessions, CAST(sum(length(text)) AS BIGINT) AS total_tokens, CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS completed FROM conversations""",
)
def _session_rollup(spark, sf):
    df = table(spark, sf, "conversations").withColumn("tokens", F.length("text").cast("long"))
    return catalog.session_rollup(df, "tokens", F.col("role") == "assistant")


@query(
    "trace_rollup",
    f"""SELECT user_id, count(*) AS steps, {rnd('sum(value)', 4)} AS total_duration, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS tool_calls
FROM events GROUP BY user_id""",
)
def _trace_rollup(spark, sf):
    out = catalog.trace_rollup(table(spark, sf, "events"), "user_id", "value", F.col("event_type") == "click")
    return out.withColumn("total_duration", round_to(F.col("total_duration"), 4))


NUMBERED = "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence_num FROM events"


@query("session_sequence_numbers", NUMBERED)
def _sequence(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return catalog.session_sequence(df, "user_id", "ts", "event_id").drop("ts")


@query(
    "session_sequence_gaps",
    f"""SELECT user_id, min(sequence_num) AS first_num, max(sequence_num) AS last_num,
CAST(max(sequence_num) - min(sequence_num) + 1 - count(DISTINCT sequence_num) AS BIGINT) AS missing, CAST(count(*) - count(DISTINCT sequence_num) AS BIGINT) AS repeated
FROM (SELECT * REPLACE (sequence_num + CASE WHEN event_id % 11 = 0 THEN 1000000 ELSE 0 END AS sequence_num) FROM ({NUMBERED})) GROUP BY user_id
HAVING max(sequence_num) - min(sequence_num) + 1 <> count(DISTINCT sequence_num)""",
)
def _gaps(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "ts")
    numbered = catalog.session_sequence(df, "user_id", "ts", "event_id")
    # every eleventh event gets a far number, which leaves gaps behind
    numbered = numbered.withColumn("sequence_num", F.expr("sequence_num + if(event_id % 11 = 0, 1000000L, 0L)"))
    return catalog.sequence_gaps(numbered, "user_id", "sequence_num")


@query(
    "start_to_completion",
    f"""WITH m AS (SELECT user_id, event_id, event_type, ts, CASE WHEN event_type = 'purchase' THEN ts END AS e FROM events WHERE event_type IN ('signup', 'purchase')),
f AS (SELECT *, first_value(e IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM m)
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started, strftime(nx, '%Y-%m-%d %H:%M:%S') AS ended,
{rnd('(epoch_us(nx) - epoch_us(ts)) / 1e6', 3)} AS seconds FROM f WHERE event_type = 'signup'""",
)
def _durations(spark, sf):
    out = catalog.span_durations(table(spark, sf, "events"), "user_id", "event_type", "signup", "purchase", "ts", "event_id")
    return out.select(
        "user_id", "event_id", _shown("started").alias("started"), _shown("ended").alias("ended"), round_to(F.col("seconds"), 3).alias("seconds")
    )


# ---- streams -------------------------------------------------------------------------------------------


def _stream(spark, sf):
    return streams.read_events(spark, sf, "events.parquet")


@query(
    "stream_profile",
    f"""SELECT event_type, count(value) AS count, {rnd('avg(value)', 6)} AS mean, {rnd('stddev_samp(value)', 6)} AS std, min(value) AS min, max(value) AS max,
{rnd('skewness(value)', 6)} AS skewness, {rnd('kurtosis(value)', 6)} AS kurtosis, TRUE AS quartiles_hold, TRUE AS distinct_holds FROM events GROUP BY event_type""",
)
def _stream_profile(spark, sf):
    out = streams.run(streams.incremental_profile(_stream(spark, sf), ["event_type"], "value"), "complete")
    rounded = [round_to(F.col(c), 6).alias(c) for c in ("mean", "std", "skewness", "kurtosis")]
    return _estimates_hold(out, table(spark, sf, "events"), ["event_type"]).select(
        "event_type", "count", "min", "max", *rounded, "quartiles_hold", "distinct_holds"
    )


def _estimates_hold(profile, events, keys):
    """Whether the quartiles' true ranks are off by 0.01 at most and the distinct estimate by 3 per cent."""
    bounds = profile.select(*keys, "quartiles")
    below = [F.avg((F.col("value") < F.col("quartiles")[i]).cast("int")).alias(f"low{i}") for i in range(3)]
    upto = [F.avg((F.col("value") <= F.col("quartiles")[i]).cast("int")).alias(f"high{i}") for i in range(3)]
    rows = events.join(bounds, keys) if keys else events.crossJoin(F.broadcast(bounds))  # one row
    exact = rows.groupBy(*keys).agg(*below, *upto, F.countDistinct("value").alias("distinct"))
    ranks = F.lit(True)
    for i, p in enumerate((0.25, 0.5, 0.75)):
        ranks = ranks & (F.col(f"low{i}") <= p + 0.01) & (F.col(f"high{i}") >= p - 0.01)
    near = F.abs(F.col("distinct_estimate") / F.col("distinct") - 1) <= 0.03
    checked = profile.join(exact, keys) if keys else profile.crossJoin(F.broadcast(exact))
    return checked.withColumns({"quartiles_hold": ranks, "distinct_holds": near})


@query(
    "merged_stream_profiles",
    f"""SELECT count(value) AS count, {rnd('avg(value)', 6)} AS mean, {rnd('stddev_samp(value)', 6)} AS std, min(value) AS min, max(value) AS max,
TRUE AS quartiles_hold, TRUE AS distinct_holds FROM events""",
)
def _merged_profiles(spark, sf):
    """Profiles per type, kept by the stream, added up to one."""
    fine = streams.run(streams.incremental_profile(_stream(spark, sf), ["event_type"], "value"), "complete")
    whole = streams.merged_profiles(fine)
    rounded = [round_to(F.col(c), 6).alias(c) for c in ("mean", "std")]
    return _estimates_hold(whole, table(spark, sf, "events"), []).select("count", *rounded, "min", "max", "quartiles_hold", "distinct_holds")


@query("stream_unique_events", "SELECT event_id, user_id, event_type, value FROM events")
def _stream_unique(spark, sf):
    delivered = _stream(spark, sf).union(_stream(spark, sf))  # every event arrives twice
    return streams.run(streams.unique_events(delivered)).select("event_id", "user_id", "event_type", "value")


def _windows_sql(shift: str, width: str) -> str:
    return f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL {width}, '%Y-%m-%d %H:%M:%S') AS window_end, event_type,
count(*) AS n, {rnd('sum(value)', 4)} AS total FROM ({shift}) GROUP BY w, event_type"""


def _windows(df):
    return df.select(
        _shown("window_start").alias("window_start"),
        _shown("window_end").alias("window_end"),
        "event_type",
        "n",
        round_to(F.col("total"), 4).alias("total"),
    )


@query("stream_tumbling_rates", _windows_sql("SELECT date_trunc('day', ts) AS w, event_type, value FROM events", "1 DAY"))
def _stream_daily(spark, sf):
    return _windows(streams.run(streams.windowed_rates(_stream(spark, sf), ["event_type"], "value", "1 day"), "complete"))


@query(
    "stream_sliding_rates",
    _windows_sql(
        "SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS w, event_type, value FROM events, range(2) r(k)", "2 HOUR"
    ),
)
def _stream_sliding(spark, sf):
    rates = streams.windowed_rates(_stream(spark, sf), ["event_type"], "value", "2 hours", "1 hour")
    return _windows(streams.run(rates, "complete"))


@query(
    "stream_closed_windows",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
)
def _stream_closed(spark, sf):
    out = streams.run(streams.windowed_rates(_stream(spark, sf), ["event_type"], "value", "1 day"), "append")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(
    "stream_session_spans",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n
FROM s GROUP BY user_id, k""",
)
def _stream_sessions(spark, sf):
    out = streams.run(streams.session_spans(_stream(spark, sf), "user_id", "2 hours"), "complete")
    return out.select("user_id", _shown("session_start").alias("session_start"), _shown("session_end").alias("session_end"), "n")


@query(
    "stream_paired_spans",
    f"""SELECT a.event_id // 2 AS run_id, {rnd('(epoch_us(b.ts) - epoch_us(a.ts)) / 1e6', 3)} AS seconds FROM events a JOIN events b
ON a.event_id // 2 = b.event_id // 2 AND a.event_id % 2 = 0 AND b.event_id % 2 = 1 AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 2 HOUR""",
)
def _stream_pairs(spark, sf):
    runs = _stream(spark, sf).withColumn("run_id", F.expr("event_id div 2"))
    again = _stream(spark, sf).withColumn("run_id", F.expr("event_id div 2"))
    out = streams.run(streams.paired_spans(runs.filter("event_id % 2 = 0"), again.filter("event_id % 2 = 1"), "run_id"))
    return out.select("run_id", round_to(F.col("seconds"), 3).alias("seconds"))


@query(
    "stream_anomaly_flags",
    """WITH b AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY event_type)
SELECT event_id, e.event_type, abs((value - m) / nullif(s, 0)) > 3 AS is_anomaly FROM events e JOIN b ON e.event_type = b.event_type""",
)
def _stream_anomalies(spark, sf):
    bounds = streams.training_bounds(table(spark, sf, "events"), "event_type", "value")
    out = streams.run(streams.anomaly_flags(_stream(spark, sf), bounds, "event_type", "value"))
    return out.select("event_id", "event_type", "is_anomaly")


@query("stream_sequence_numbers", NUMBERED)
def _stream_numbers(spark, sf):
    stream = _stream(spark, sf).select("event_id", "user_id", "ts")
    out = streams.numbered_events(stream, "user_id", "ts", "event_id")
    return out.select("event_id", "user_id", "sequence_num")


# ---- composites -----------------------------------------------------------------------------------------


@query("auto_analysis")
def _auto(spark, sf):
    found = bundles.analyze(training_frame(spark, sf), "quality")
    return found["findings"]


@query(
    "skewed_features",
    f"""SELECT feature, {rnd('skewness(v)', 4)} AS skewness, abs({rnd('skewness(v)', 4)}) > 1 AS skewed FROM
(SELECT 'doc_id' AS feature, CAST(doc_id AS DOUBLE) AS v FROM documents UNION ALL SELECT 'n_chars', CAST(n_chars AS DOUBLE) FROM documents) GROUP BY feature""",
)
def _skewed(spark, sf):
    return bundles.statistics_bundle(table(spark, sf, "documents"))["descriptive"].select("feature", "skewness", "skewed")


@query("report_tables")
def _report(spark, sf):
    out = None
    for name, t in bundles.report_bundle(table(spark, sf, "orders")).items():
        part = t.select(F.lit(name).alias("section"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in t.columns])).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def _broken_stage(df):
    raise ValueError("this stage never works")


@query(
    "stage_chain_status",
    """SELECT 1 AS position, 'dedupe' AS stage, 'completed' AS status, count(*) AS rows FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
UNION ALL SELECT 2, 'broken', 'failed', NULL
UNION ALL SELECT 3, 'open_only', 'completed', count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O')""",
)
def _stages(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    _, status = bundles.run_stages(
        df,
        [
            ("dedupe", lambda d: d.dropDuplicates()),
            ("broken", _broken_stage),
            ("open_only", lambda d: d.filter("o_orderstatus = 'O'")),
        ],
    )
    return status.drop("error")


@query("dataset_health")
def _dataset_health(spark, sf):
    return bundles.dataset_scores(table(spark, sf, "lineitem"))
