"""The registered queries of this subpackage, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import bpe, chunks, collocations, itq, licenses, ngramrules, packing, runs, simhash, sketch, subword, urlrules, warc
from statloom.llm.common import read

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(read(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeats(read(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read(spark, folder, "documents"), vocabulary_path())
    return pieces.select("doc_id", "start", F.crc32("ids").alias("ids_crc32"), "length", "doc_tokens", "sequence_id", "offset")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents")).drop("spans")


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = ", ".join(str(rule) for rule in urlrules.RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(verdict, host, path)")
    return urlrules.judge(read(spark, folder, "pages"), rules)


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return itq.near_duplicates(read(spark, folder, "embeddings"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return subword.scored(documents, subword.fit(documents, read(spark, folder, "labels")))


def op8_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.compared_with_next(read(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(read(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(read(spark, folder, "documents"), vocabulary_path())


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return ngramrules.judged(documents, ngramrules.fit(documents, read(spark, folder, "labels")))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))


def with_period(documents: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the tail of every tenth text, chosen by crc32 of its id, repeats its first words."""
    rows = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    marked = (F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    found = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = rows.select("doc_id", "text", F.when(marked, found).alias("words"), F.floor(F.col("h") / 10).alias("g"))
    at = F.col("g") % F.size("words")
    rows = rows.select("*", at.cast("int").alias("a"), (3 + F.col("g") % 8).cast("int").alias("times"))
    period = 1 + F.floor((F.size("words") - F.col("a")) / F.col("times"))
    rows = rows.withColumn("p", F.when(F.col("words").isNotNull(), period.cast("int")))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.col("times")))
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), F.size("words"))
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_period(read(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.select("*", lines.alias("lines"), longest.alias("longest"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.period)").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_substring_dedup,
        op3_packing,
        op4_license_scan,
        op5_url_rules,
        op6_embedding_dedup,
        op7_quality,
        op8_sketch,
        op9_warc,
        op10_bpe,
        op11_quality_rules,
        op12_collocations,
        op13_periodic_runs,
    )
}

_HOST = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

_FACTS = " UNION ALL ".join(
    f"SELECT '{verdict}' AS v, '{host}' AS h, '{path}' AS p" for verdict, host, path in urlrules.RULES
)

_BITS = "(CASE substr(hex_digest, i, 1) " + " ".join(f"WHEN '{x:x}' THEN '{x:04b}'" for x in range(16)) + " END)"

ORACLE: dict[str, str] = {
    "op5_url_rules": f"""
        WITH pages_of AS (SELECT row_number() OVER () AS n, page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        rules AS ({_FACTS}),
        fitting AS (
            SELECT n, v, h || p AS rule, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(p) DESC, v DESC) AS k
            FROM pages_of, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
        FROM pages_of LEFT JOIN (SELECT * FROM fitting WHERE k = 1) USING (n)""",
    "op9_warc": f"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex_digest FROM pages),
        b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: {_BITS}), 'string_agg', '') AS bits FROM p),
        d AS (
            SELECT *, list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * CAST(substr(bits, 5 * j + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * j + 2, 1) AS INT)
                + 4 * CAST(substr(bits, 5 * j + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * j + 4, 1) AS INT)
                + CAST(substr(bits, 5 * j + 5, 1) AS INT), 1)), 'string_agg', '') AS payload_digest FROM b),
        g AS (SELECT hex_digest, max(page_id) AS response FROM p GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to, TRUE AS verified
        FROM d JOIN g USING (hex_digest)""",
    "op12_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
        spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 6) AS lengths(k)),
        often AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
            FROM spans GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM often WHERE k > 1),
        scored AS (
            SELECT c.lang, c.k, c.phrase, a, x.f AS l, y.f AS r, n, j, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN totals USING (lang)
            JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
            JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1 : c.k], ' ')),
        best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS p FROM scored),
        longer AS (
            SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1 : k - 1], ' '), array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase, f
            FROM often WHERE k > 2),
        kept AS (
            SELECT * FROM best b WHERE p = 1 AND NOT EXISTS (
                SELECT 1 FROM longer z WHERE z.lang = b.lang AND z.phrase = b.phrase AND 100 * z.f >= 100 * b.a)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""",
}
