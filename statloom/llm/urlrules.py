"""URL filters as a sort-merge range join, in DataFrame operations only.

Hosts are reversed label by label ("blog.example.org" -> "org.example.blog."), so that a rule's host
and all its subdomains are one interval of keys, and the intervals of two rules are nested or apart.
Rules and URLs are sorted by key together and swept: each rule carries the stack of the rules whose
intervals enclose it, and a URL looks at the last rule before it, since every rule whose interval is
open there is on that rule's stack. Rules of the stack that really hold the URL's host and whose path
the URL's path begins with fit; the longest wins.

The sweep is cut into key ranges by literal limits. A range begins with the stack that is open at its
lower limit. URLs of one host are spread over several ranges by a hash behind their key, so a host
with a third of all pages isn't one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.common import ascii_lower, col

#: Rules as (verdict, host, path); the contract's.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
RULE_SCHEMA = "verdict string, host string, path string"
MOST_RANGES = 512  # the limits are literals of the plan; more pages make longer ranges
PER_RANGE = 64  # keys sampled for each range, to place the limits


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels reversed, each followed by a zero character, which sorts before all others."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\0"), F.lit("\0"))


def _limits(keys: DataFrame, ranges: int) -> list[str]:
    """Range limits from a sample of bounded size, taken by the smallest hashes of the sort keys."""
    sample = keys.select("sort").orderBy(F.xxhash64("sort"), "sort").limit(PER_RANGE * ranges)
    found = sorted(r[0] for r in sample.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _range_of(sort: Column, limits: list[str]) -> Column:
    """How many limits are not above the key, by a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(sort < limits[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(limits))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every page.

    ``rules(verdict, host, path)``: a rule fits its host and all subdomains if the URL's path starts
    with the rule's path. The longest fitting rule (host and path together) decides, among equals the
    one whose path is longer, then block before allow; ``rule`` is its host and path. Pages that no
    rule fits get NULL and the ``default``. A URL that is NULL or has no ``://`` has empty host and
    path; a rule with a NULL host or path is ignored, one with an empty host holds every host. Repeated
    pages and rules and NULL ids are kept apart: one row per page. Other columns are left behind.
    """
    spark = pages.sparkSession
    ranges = ranges or min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    urls = pages.select(col(id_col).alias("page_id"), host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path"))
    # the hash spreads a host's pages; it stands behind two zero characters and so below all subdomains
    spread = F.concat(F.lit("\0"), F.hex(F.xxhash64("page_id", "path")))
    urls = urls.withColumn("sort", F.concat(host_key(F.col("host")), spread))
    known = rules.select(
        col("verdict").alias("verdict"), ascii_lower(col("host")).alias("host"), col("path").alias("path")
    ).where("host is not null and path is not null")
    known = known.withColumn("sort", F.when(F.col("host") == "", "").otherwise(host_key(F.col("host"))))
    one = F.struct(
        (F.length("host") + F.length("path")).alias("size"),
        F.length("path").alias("depth"),
        F.col("verdict"),
        F.col("host"),
        F.col("path"),
    )
    # rules of one host are one entry of the stack
    entries = known.groupBy("sort").agg(F.sort_array(F.collect_set(one), asc=False).alias("rules"))
    stacks = _stacks(entries)
    limits = _limits(urls.select("sort").unionByName(entries.select("sort")), ranges)
    marks = stacks.select(_range_of(F.col("sort"), limits).alias("range"), "sort", "stack")
    # the stack open where a range begins: that of the last rule before it
    last = marks.groupBy("range").agg(F.max_by("stack", "sort").alias("open"))
    steps = spark.range(len(limits) + 1).select(F.col("id").cast("int").alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    opening = steps.join(F.broadcast(last), "range", "left").select("range", F.last("open", ignorenulls=True).over(before).alias("open"))
    # a mark at a range's beginning carries the open stack; only rules and marks have a stack
    empty = {c: F.lit(None).cast(t).alias(c) for c, t in urls.dtypes if c != "sort"}
    rows = urls.select(_range_of(F.col("sort"), limits).alias("range"), "sort", F.lit(2).alias("kind"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"), "page_id", "host", "path")
    rows = rows.unionByName(marks.select("range", "sort", F.lit(1).alias("kind"), "stack", *empty.values()))
    rows = rows.unionByName(opening.select("range", F.lit("").alias("sort"), F.lit(0).alias("kind"), F.col("open").alias("stack"), *empty.values()))
    sweep = Window.partitionBy("range").orderBy("sort", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 2")
    fits = F.filter(
        F.flatten(F.coalesce("stack", F.array())),
        lambda r: ((r["host"] == "") | F.col("host").eqNullSafe(r["host"]) | F.col("host").endswith(F.concat(F.lit("."), r["host"])))
        & F.col("path").startswith(r["path"]),
    )
    best = F.array_max(fits)
    judged = swept.select("page_id", "host", "path", best.alias("best"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.concat("best.host", "best.path").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def _stacks(entries: DataFrame) -> DataFrame:
    """``(sort, stack)``: the rules of an entry and of all entries whose intervals enclose it.

    An enclosing key is a prefix of whole labels, so every entry asks for its own prefixes by equality.
    """
    prefixes = F.expr(
        "transform(sequence(0, size(split(sort, '\\0')) - 1), i -> case when i = 0 then '' else concat(array_join(slice(split(sort, '\\0'), 1, i), '\\0'), '\\0') end)"
    )
    asked = entries.select("sort", F.explode(prefixes).alias("above"))
    found = asked.join(entries.select(F.col("sort").alias("above"), "rules"), "above")
    return found.groupBy("sort").agg(F.collect_list("rules").alias("stack"))
