"""Exact quantiles (linear interpolation) whose memory does not grow with the data.

``percentile`` keeps one counter per distinct value in a single aggregation buffer.
That is the fastest plan while the number of distinct values is small, which is
checked first with a HyperLogLog pass. Beyond the limit the exact order statistics
are selected in two passes: a bounded sketch brackets every wanted rank, then only
the values inside the brackets are counted, ordered and interpolated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import any_of, melt, number
from statloom.functions.prefix import prefix_sums, range_count
from statloom.session import settle

BUFFER_LIMIT = 200_000  # distinct values one percentile buffer may hold
GROUP_BUFFER_LIMIT = 100_000  # the same where a task may hold buffers of several groups
SKETCH_ACCURACY = 50_000  # rank error of the bracketing sketch is n / accuracy
GROUP_BROADCAST_LIMIT = 100_000  # groups whose brackets may be broadcast
QUARTILES = [0.25, 0.5, 0.75]


def _exact(c: Column, probs: list[float]) -> Column:
    return F.percentile(c, F.array(*[F.lit(float(p)) for p in probs]))


def _fits(distinct: float | None, limit: int) -> bool:
    return (distinct or 0) * 1.2 <= limit  # the estimate may be 5 % off either way


def quantile_columns(
    df: DataFrame, names: list[str], probs: list[float], distinct: dict[str, int], limit: int | None = None
) -> dict[str, Column]:
    """Per column an expression for its quantiles, to be used inside ``df.agg``.

    Few distinct values (known from ``distinct``): the aggregate itself. Many: a literal
    array found by distributed selection.
    """
    limit = BUFFER_LIMIT if limit is None else limit
    small = [n for n in names if _fits(distinct.get(n), limit)]
    large = [n for n in names if n not in small]
    out = {n: _exact(number(df, n), probs) for n in small}
    if large:
        found = _select_columns(df, large, probs)
        out.update({n: F.array(*[F.lit(q).cast("double") for q in found[n]]) for n in large})
    return out


def distinct_estimates(df: DataFrame, names: list[str]) -> dict[str, int]:
    row = df.agg(
        *[F.approx_count_distinct(number(df, n), 0.05).alias(f"d{i}") for i, n in enumerate(names)]
    ).first()
    return {n: row[i] for i, n in enumerate(names)}


def column_quantiles(
    df: DataFrame, names: list[str], probs: list[float], limit: int | None = None, distinct: dict[str, int] | None = None
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns; the answer is columns x probs numbers."""
    if not names:
        return {}
    distinct = distinct_estimates(df, names) if distinct is None else distinct
    limit = BUFFER_LIMIT if limit is None else limit
    small = [n for n in names if _fits(distinct[n], limit)]
    large = [n for n in names if n not in small]
    out: dict[str, list[float | None]] = {}
    if small:
        row = df.agg(*[_exact(number(df, n), probs).alias(f"q{i}") for i, n in enumerate(small)]).first()
        out.update({n: list(row[i]) if row[i] is not None else [None] * len(probs) for i, n in enumerate(small)})
    if large:
        out.update(_select_columns(df, large, probs))
    return out


def _brackets(probs: list[float]) -> list[float]:
    margin = 4.0 / SKETCH_ACCURACY
    return [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]


def _select_columns(df: DataFrame, names: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Whole columns: sketch scan, counting scan, and a group-by of the bracketed values.

    Columns are handled side by side in each scan; only values inside a bracket (a few
    in ten thousand) are exploded and shuffled.
    """
    m = len(probs)
    cols = {n: f"c{i}" for i, n in enumerate(names)}
    work = df.select(*[number(df, n).alias(c) for n, c in cols.items()])
    sketch = work.agg(
        *[F.count(c).alias(f"n_{c}") for c in cols.values()],
        *[F.percentile_approx(c, _brackets(probs), SKETCH_ACCURACY).alias(f"s_{c}") for c in cols.values()],
    ).first()
    lo = {c: sketch[f"s_{c}"][:m] for c in cols.values()}
    hi = {c: sketch[f"s_{c}"][m:] for c in cols.values()}
    below = work.agg(
        *[F.count_if(F.col(c) < lo[c][i]).alias(f"b_{c}_{i}") for c in cols.values() for i in range(m)]
    ).first()
    inside = {
        (c, i): (F.col(c) >= lo[c][i]) & (F.col(c) <= hi[c][i]) for c in cols.values() for i in range(m)
    }
    cells = [
        F.when(inside[c, i], F.struct(F.lit(c).alias("feature"), F.lit(i).alias("i"), F.col(c).alias("v")))
        for c, i in inside
    ]
    counted = (
        work.filter(any_of(list(inside.values())))
        .select(F.explode(F.array(*cells)).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy("cell.feature", "cell.i", "cell.v")
        .agg(F.count("*").alias("c"))
    )
    start = F.element_at(
        F.create_map(
            *[x for c in cols.values() for i in range(m) for x in (F.lit(f"{c}/{i}"), F.lit(below[f"b_{c}_{i}"]))]
        ),
        F.concat_ws("/", "feature", F.col("i").cast("string")),
    )
    rank = {
        (c, i): probs[i] * (sketch[f"n_{c}"] - 1) for c in cols.values() for i in range(m)
    }
    wanted = F.element_at(
        F.create_map(*[x for (c, i), r in rank.items() for x in (F.lit(f"{c}/{i}"), F.lit(float(r)))]),
        F.concat_ws("/", "feature", F.col("i").cast("string")),
    )
    # running counts range by range: a bracket may hold many values
    held = sum(sketch[f"n_{c}"] for c in cols.values()) * m * 10 / SKETCH_ACCURACY  # at most so many values
    inner = prefix_sums(settle(counted, "bracketed"), "v", ["c"], ["feature", "i"], ranges=range_count(held))
    picked = (
        inner.select("feature", "i", "v", (F.col("c_upto") + start).alias("upto"), wanted.alias("pos"))
        .groupBy("feature", "i")
        .agg(*_order_statistics())
        .collect()  # columns x probs rows
    )
    found = {(r["feature"], r["i"]): r for r in picked}
    out: dict[str, list[float | None]] = {}
    missed = []
    for n, c in cols.items():
        values = []
        for i in range(m):
            r = found.get((c, i))
            at = int(rank[c, i])
            if r is None or r["v0"] is None or r["v1"] is None or below[f"b_{c}_{i}"] > at:
                missed.append(n)
                break
            values.append(r["v0"] + (rank[c, i] - at) * (r["v1"] - r["v0"]))
        out[n] = values
    if missed:  # a sketch broke its promise: order those columns in full
        long = melt(df, missed, "v")
        for r in _ranked(long, ["feature"], "v", probs).collect():
            out[r["feature"]] = r["q"]
    return out


def _order_statistics() -> list[Column]:
    """First values whose running count passes the wanted position and the one after."""
    return [
        F.min(F.when(F.col("upto") > F.floor("pos"), F.col("v"))).alias("v0"),
        F.min(F.when(F.col("upto") > F.ceil("pos"), F.col("v"))).alias("v1"),
    ]


def group_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], limit: int | None = None
) -> DataFrame:
    """Exact quantiles of ``value`` per group: ``(keys..., q array<double>)``.

    Groups with few distinct values are aggregated directly; the others (few, since each
    holds more than ``limit`` distinct values) go through distributed selection.
    """
    limit = GROUP_BUFFER_LIMIT if limit is None else limit
    base = df.select(*keys, number(df, value).alias("v")).filter(F.col("v").isNotNull())
    sizes = base.groupBy(*keys).agg(F.approx_count_distinct("v", 0.05).alias("d"))
    wide = F.col("d") * 1.2 > limit
    groups = sizes.agg(F.count_if(wide).alias("k")).first()["k"]
    if groups == 0:
        return base.groupBy(*keys).agg(_exact(F.col("v"), probs).alias("q"))
    big = sizes.filter(wide).select(*keys)
    big = F.broadcast(big) if groups <= GROUP_BROADCAST_LIMIT else big
    direct = base.join(big, keys, "left_anti").groupBy(*keys).agg(_exact(F.col("v"), probs).alias("q"))
    return direct.unionByName(select_quantiles(base.join(big, keys, "left_semi"), keys, "v", probs, groups))


def select_quantiles(long: DataFrame, keys: list[str], value: str, probs: list[float], groups: int) -> DataFrame:
    """Order statistics of large groups by bracketing, in full order where a sketch missed."""
    m = len(probs)
    sketch = settle(
        long.groupBy(*keys).agg(
            F.count(value).alias("n"), F.percentile_approx(value, _brackets(probs), SKETCH_ACCURACY).alias("s")
        ),
        "brackets",
    )
    joined = long.join(F.broadcast(sketch) if groups <= GROUP_BROADCAST_LIMIT else sketch, keys)
    v = F.col(value)
    inside = [(v >= F.col("s")[i]) & (v <= F.col("s")[m + i]) for i in range(m)]
    below = joined.groupBy(*keys).agg(
        F.first("n").alias("n"), F.array(*[F.count_if(v < F.col("s")[i]) for i in range(m)]).alias("below")
    )
    cells = F.array(
        *[F.when(inside[i], F.struct(F.lit(i).alias("i"), v.alias("v"))) for i in range(m)]
    )
    counted = (
        joined.filter(any_of(inside))
        .select(*keys, F.explode(cells).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy(*keys, F.col("cell.i").alias("i"), F.col("cell.v").alias("v"))
        .agg(F.count("*").alias("c"))
    )
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probs]), F.col("i") + 1)
    running = prefix_sums(settle(counted, "bracketed"), "v", ["c"], [*keys, "i"])
    ranked = running.withColumnRenamed("c_upto", "run").join(below, keys)
    ranked = ranked.withColumn("pos", p * (F.col("n") - 1)).withColumn(
        "upto", F.col("run") + F.element_at("below", F.col("i") + 1)
    )
    picked = ranked.groupBy(*keys, "i").agg(
        *_order_statistics(),
        F.first(F.col("pos") - F.floor("pos")).alias("frac"),
        F.max(F.element_at("below", F.col("i") + 1) <= F.floor("pos")).alias("low_ok"),
    )
    q = F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0"))
    sure = F.col("low_ok") & F.col("v0").isNotNull() & F.col("v1").isNotNull()
    result = settle(
        picked.groupBy(*keys).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("i", q.alias("q")))), lambda s: s["q"]).alias("q"),
            (F.min(sure) & (F.count("*") == m)).alias("covered"),
        ),
        "quantiles",
    )
    missed = result.filter(~F.col("covered")).select(*keys)
    if not missed.limit(1).count():
        return result.select(*keys, "q")
    again = _ranked(long.join(missed, keys, "left_semi"), keys, value, probs)
    return result.filter("covered").select(*keys, "q").unionByName(again)


def _ranked(long: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Order statistics from range-wise running counts over all distinct values."""
    counts = settle(long.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("c")), "counts")
    upto = prefix_sums(counts, "v", ["c"], keys).withColumnRenamed("c_upto", "upto")
    sizes = counts.groupBy(*keys).agg(F.sum("c").alias("n"))
    joined = upto.join(sizes, keys)
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        aggs += [
            F.min(F.when(F.col("upto") > F.floor(pos), F.col("v"))).alias(f"a{i}"),
            F.min(F.when(F.col("upto") > F.ceil(pos), F.col("v"))).alias(f"b{i}"),
            F.first(pos - F.floor(pos)).alias(f"f{i}"),
        ]
    q = [F.col(f"a{i}") + F.col(f"f{i}") * (F.col(f"b{i}") - F.col(f"a{i}")) for i in range(len(probs))]
    return joined.groupBy(*keys).agg(*aggs).select(*keys, F.array(*q).alias("q"))
