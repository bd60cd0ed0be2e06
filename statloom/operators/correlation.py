"""Pairwise association of numeric columns: Pearson, Spearman, Kendall."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import tails
from statloom.functions.exprs import ALPHA, all_of, number, rnd, stack_rows, verdict, with_scalars
from statloom.functions.prefix import prefix_sums, range_count
from statloom.functions.roles import numeric_columns
from statloom.functions.skew import attach_by_key
from statloom.session import settle

PAIRS_PER_SCAN = 500  # correlation sums fused into one scan
RANK_BROADCAST_LIMIT = 200_000  # distinct values whose rank table may be broadcast
DIGIT_BITS = 4  # Kendall counts inversions digit by digit, 16 counters per row


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, r double, n long")


def pearson_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``(feature_a, feature_b, r, n)`` over pairwise complete rows.

    A first scan finds means, ranges and gaps. The second sums centred products: one sum
    per pair of complete columns, six for a pair with gaps. Very wide complete tables use
    the Gram matrix of centred vectors instead, still a single scan.
    """
    if not pairs:
        return _empty(df)
    names = list(dict.fromkeys(c for p in pairs for c in p))
    at = {n: i for i, n in enumerate(names)}
    facts = _column_facts(df, names)
    return _centred_pairs(df, pairs, at, facts)


def _column_facts(df: DataFrame, names: list[str]) -> dict[str, float | None]:
    return (
        df.agg(
            F.count("*").alias("n"),
            *[
                f(number(df, c)).alias(f"{label}{i}")
                for i, c in enumerate(names)
                for label, f in (("k", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))
            ],
        )
        .first()
        .asDict()
    )


def _centred_pairs(df: DataFrame, pairs, at: dict[str, int], facts: dict[str, float | None]) -> DataFrame:
    """Correlations from centred sums, given each column's size, mean and range."""
    names = list(at)
    n = facts["n"]
    whole = {c for c, i in at.items() if facts[f"k{i}"] == n}
    flat = {c for c, i in at.items() if facts[f"lo{i}"] is None or facts[f"lo{i}"] == facts[f"hi{i}"]}
    centred = df.select(*[(number(df, c) - F.lit(float(facts[f"m{i}"] or 0.0))).alias(f"x{i}") for c, i in at.items()])
    if len(pairs) > PAIRS_PER_SCAN and whole == set(names):
        return _gram_pairs(centred, pairs, at, flat, n)
    out = None
    for start in range(0, len(pairs), PAIRS_PER_SCAN):
        chunk = pairs[start : start + PAIRS_PER_SCAN]
        used = sorted({at[c] for p in chunk for c in p})
        aggs = [f(F.col(f"x{i}")).alias(f"{label}{i}") for i in used for label, f in (("s", F.sum), ("ss", _square_sum))]
        rows = []
        for k, (a, b) in enumerate(chunk):
            i, j = at[a], at[b]
            x, y = F.col(f"x{i}"), F.col(f"x{j}")
            aggs.append(F.sum(x * y).alias(f"xy{k}"))
            if a in whole and b in whole:
                sums = (F.lit(float(n)), F.col(f"s{i}"), F.col(f"s{j}"), F.col(f"ss{i}"), F.col(f"ss{j}"), F.col(f"xy{k}"))
                constant = F.lit(a in flat or b in flat)
                size = F.lit(n).cast("long")
            else:
                both = x.isNotNull() & y.isNotNull()
                px, py = F.when(both, x), F.when(both, y)
                for label, e in (
                    ("n", F.count(px)), ("sx", F.sum(px)), ("sy", F.sum(py)), ("sxx", _square_sum(px)),
                    ("syy", _square_sum(py)), ("flat", (F.min(px) == F.max(px)) | (F.min(py) == F.max(py))),
                ):
                    aggs.append(e.alias(f"{label}_{k}"))
                sums = (*[F.col(f"{x}_{k}") for x in ("n", "sx", "sy", "sxx", "syy")], F.col(f"xy{k}"))
                constant = F.coalesce(F.col(f"flat_{k}"), F.lit(True))
                size = F.col(f"n_{k}")
            rows.append([F.lit(a), F.lit(b), F.when(~constant, _r(*sums)), size])
        part = stack_rows(centred.agg(*aggs), rows, ["feature_a", "feature_b", "r", "n"])
        out = part if out is None else out.unionByName(part)
    return out


def _square_sum(c: Column) -> Column:
    return F.sum(c * c)


def _r(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    return F.try_divide(sxy - sx * sy / n, F.sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)))


def _gram_pairs(centred: DataFrame, pairs, at: dict[str, int], flat: set[str], n: int) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    keep = [c for c in at if c not in flat]
    vectors = VectorAssembler(inputCols=[f"x{at[c]}" for c in keep], outputCol="v").transform(centred).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()  # columns x columns
    place = {c: i for i, c in enumerate(keep)}
    rows = [
        (a, b, float(matrix[place[a], place[b]]) if a in place and b in place else None, n) for a, b in pairs
    ]
    return centred.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double, n long")


def average_ranks(df: DataFrame, name: str, distinct: int) -> DataFrame:
    """``(name, <name>_rank, count)``: tie-averaged rank of every distinct value."""
    counts = df.groupBy(F.col(name)).agg(F.count("*").alias("_c"))
    ranked = prefix_sums(counts, name, ["_c"], ranges=range_count(distinct))
    return ranked.select(name, (F.col("_c_upto") - (F.col("_c") - 1) / 2).alias(f"{name}_rank"), F.col("_c").alias("count"))


def with_ranks(df: DataFrame, names: list[str], distinct: dict[str, int], total: int) -> DataFrame:
    """Replace complete columns by their tie-averaged ranks over the whole table."""
    out = df.select(*names)
    for name in names:
        ranks = average_ranks(df, name, distinct[name])
        if distinct[name] <= RANK_BROADCAST_LIMIT:
            out = out.join(F.broadcast(ranks.drop("count")), name)
        else:
            out = attach_by_key(out, ranks, [name], "count", total)
    return out.select(*[F.col(f"{n}_rank").alias(n) for n in names])


def _rank_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Spearman over complete columns. Ranks average (n + 1) / 2, so the ranked table,
    the expensive part, is evaluated once."""
    names = list(dict.fromkeys(c for p in pairs for c in p))
    row = df.agg(
        F.count("*").alias("n"),
        *[F.approx_count_distinct(n).alias(f"d{i}") for i, n in enumerate(names)],
        *[f(n).alias(f"{label}{i}") for i, n in enumerate(names) for label, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    n = row["n"]
    facts: dict[str, float | None] = {"n": n}
    for i in range(len(names)):
        facts.update({f"k{i}": n, f"m{i}": (n + 1) / 2, f"lo{i}": row[f"lo{i}"], f"hi{i}": row[f"hi{i}"]})
    ranked = with_ranks(df, names, {c: row[f"d{i}"] for i, c in enumerate(names)}, n)
    return _centred_pairs(ranked, pairs, {c: i for i, c in enumerate(names)}, facts)


def spearman_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson on ranks; columns with gaps are re-ranked over each pair's complete rows."""
    names = list(dict.fromkeys(c for p in pairs for c in p))
    if not names:
        return _empty(df)
    alias = {n: f"c{i}" for i, n in enumerate(names)}
    work = df.select(*[number(df, n).alias(alias[n]) for n in names])
    gaps = work.agg(*[F.count_if(F.col(alias[n]).isNull()).alias(alias[n]) for n in names]).first()
    complete = [p for p in pairs if gaps[alias[p[0]]] == 0 and gaps[alias[p[1]]] == 0]
    partial = [p for p in pairs if p not in complete]
    back = F.create_map(*[x for n in names for x in (F.lit(alias[n]), F.lit(n))])
    parts = []
    if complete:
        parts.append(_rank_pairs(work, [(alias[a], alias[b]) for a, b in complete]))
    for a, b in partial:
        parts.append(_rank_pairs(work.select(alias[a], alias[b]).dropna(), [(alias[a], alias[b])]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        F.element_at(back, F.col("feature_a")).alias("feature_a"),
        F.element_at(back, F.col("feature_b")).alias("feature_b"),
        "r",
        "n",
    )


def kendall_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """Kendall's tau-b of one pair without pairing rows.

    y is replaced by its dense rank written in base 16. Two rows differ first at one
    digit position, so for every position the rows sharing all higher digits are scanned
    along x with one running counter per digit value: n log n work, all of it grouped
    sums and range-wise prefix scans.
    """
    x, y = number(df, a), number(df, b)
    cells = (
        df.select(x.alias("x"), y.alias("y")).dropna().groupBy("x", "y").agg(F.count("*").cast("double").alias("w"))
    )
    cells = settle(cells, "kendall")
    ys = cells.groupBy("y").agg(F.count("*").alias("k")).withColumn("one", F.lit(1))
    facts = cells.agg(
        F.sum("w").alias("n"), F.count("*").alias("cells"), F.countDistinct("y").alias("levels")
    ).first()
    levels_of_y = facts["levels"]
    if not facts["n"]:
        return _empty(df)
    codes = prefix_sums(ys, "y", ["one"], ranges=range_count(levels_of_y)).select("y", "k", (F.col("one_upto") - 1).alias("code"))
    coded = attach_by_key(cells, codes, ["y"], "k", facts["cells"])
    levels = max(1, -(-max(levels_of_y - 1, 1).bit_length() // DIGIT_BITS))
    base = 1 << DIGIT_BITS
    position = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    digits = coded.select("x", "w", "code", position).select(
        "x",
        "w",
        "level",
        F.expr(f"shiftright(code, (level + 1) * {DIGIT_BITS})").alias("prefix"),
        F.expr(f"shiftright(code, level * {DIGIT_BITS}) & {base - 1}").alias("digit"),
    )
    names = [f"d{i}" for i in range(base)]
    rows = digits.groupBy("level", "prefix", "x").agg(
        *[F.sum(F.when(F.col("digit") == i, F.col("w")).otherwise(0.0)).alias(names[i]) for i in range(base)]
    )
    # a group of rows sharing a prefix has at most `cells` distinct x
    scanned = prefix_sums(rows, "x", names, ["level", "prefix"], ranges=range_count(facts["cells"]))
    before = [F.col(f"{n}_upto") - F.col(n) for n in names]
    score = F.lit(0.0)
    lower, total = F.lit(0.0), sum(before[1:], before[0])
    for i, n in enumerate(names):
        # concordant: earlier x with smaller digit; discordant: earlier x with larger digit
        score = score + F.col(n) * (F.lit(2.0) * lower + before[i] - total)
        lower = lower + before[i]
    s = scanned.agg(F.sum(score).alias("s"))

    def ties(col: str) -> DataFrame:
        return cells.groupBy(col).agg(F.sum("w").alias("t")).agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias(f"tie_{col}"))

    n = float(facts["n"])
    pairs = n * (n - 1) / 2
    tau = F.try_divide(F.col("s"), F.sqrt((F.lit(pairs) - F.col("tie_x")) * (F.lit(pairs) - F.col("tie_y"))))
    return (
        s.transform(with_scalars, ties("x"))  # three one-row sides
        .transform(with_scalars, ties("y"))
        .select(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), tau.alias("r"), F.lit(int(n)).cast("long").alias("n"))
    )


def correlation_pairs(df: DataFrame, method: str = "pearson", names: list[str] | None = None) -> DataFrame:
    """Unrounded correlations of all column pairs over pairwise complete rows."""
    names = numeric_columns(df) if names is None else names
    pairs = list(combinations(names, 2))
    if method == "pearson":
        return pearson_pairs(df, pairs)
    if method == "spearman":
        return spearman_pairs(df, pairs)
    if method == "kendall":
        out = _empty(df)
        for a, b in pairs:
            out = out.unionByName(kendall_pair(df, a, b))
        return out
    raise ValueError(f"unknown method '{method}'")


def correlation_matrix(df: DataFrame, method: str = "pearson", digits: int = 4, names: list[str] | None = None) -> DataFrame:
    """Full matrix in long form, diagonal included; empty below two numeric columns."""
    names = numeric_columns(df) if names is None else names
    if len(names) < 2:
        return _empty(df).select("feature_a", "feature_b", F.col("r").alias("correlation"))
    value = rnd(F.col("r"), digits).alias("correlation")
    upper = correlation_pairs(df, method, names).select("feature_a", "feature_b", value)
    # every pair fills two cells: emitted from one row, so the statistics run once
    mirrored = upper.select(
        F.inline(
            F.array(
                F.struct("feature_a", "feature_b", "correlation"),
                F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "correlation"),
            )
        )
    )
    spread = df.agg(*[(F.min(number(df, n)) < F.max(number(df, n))).alias(f"v{i}") for i, n in enumerate(names)])
    diagonal = stack_rows(
        spread,
        [[F.lit(n), F.lit(n), F.when(F.col(f"v{i}"), 1.0)] for i, n in enumerate(names)],
        ["feature_a", "feature_b", "correlation"],
    )
    return mirrored.unionByName(diagonal)


def matrix_table(matrix: DataFrame, names: list[str]) -> DataFrame:
    """Long matrix to one row per feature with a column per feature."""
    return matrix.groupBy("feature_a").pivot("feature_b", names).agg(F.first("correlation"))


def top_correlations(df: DataFrame, method: str = "pearson", n: int = 10) -> DataFrame:
    """The ``n`` strongest pairs by absolute value; ties by name."""
    r = rnd(F.col("r"), 4)
    return (
        correlation_pairs(df, method)
        .select("feature_a", "feature_b", r.alias("correlation"))
        .orderBy(F.abs("correlation").desc_nulls_last(), "feature_a", "feature_b")
        .limit(n)
    )


def correlation_analysis(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs at or above the threshold with strength, direction and pair count."""
    pairs = correlation_pairs(df)
    k = len(numeric_columns(df))
    size = F.abs("r")
    strength = (
        F.when(size >= 0.9, "very strong").when(size >= 0.7, "strong").when(size >= 0.5, "moderate").otherwise("weak")
    )
    return (
        pairs.filter(size >= threshold)
        .select(
            F.col("feature_a").alias("column_a"),
            F.col("feature_b").alias("column_b"),
            rnd(F.col("r"), 4).alias("correlation"),
            strength.alias("strength"),
            F.when(F.col("r") > 0, "positive").otherwise("negative").alias("direction"),
            F.lit(k * (k - 1) // 2).cast("long").alias("total_pairs_analyzed"),
        )
        .orderBy(F.abs("correlation").desc(), "column_a", "column_b")
    )


def correlation_significance(df: DataFrame, method: str = "pearson", alpha: float = ALPHA) -> DataFrame:
    """Correlations with p-values over rows complete in every numeric column."""
    names = numeric_columns(df)
    empty = df.sparkSession.createDataFrame(
        [], "feature_a string, feature_b string, r double, n long, p_value double, significant string"
    )
    if len(names) < 2:
        return empty
    complete = df.filter(all_of([number(df, c).isNotNull() for c in names])).select(
        *[number(df, c).alias(c) for c in names]
    )
    facts = complete.agg(
        F.count("*").alias("n"), *[(F.min(F.col(f"`{c}`")) < F.max(F.col(f"`{c}`"))).alias(f"v{i}") for i, c in enumerate(names)]
    ).first()
    varying = [c for i, c in enumerate(names) if facts[f"v{i}"]]
    if facts["n"] < 3 or len(varying) < 2:
        return empty
    pairs = correlation_pairs(complete, method, varying)
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("r")))
    nu = F.col("n") - 2.0
    t = F.when(F.abs(bounded) >= 1, float("inf")).otherwise(bounded * F.sqrt(nu / (1 - bounded * bounded)))
    return (
        pairs.withColumn("p_value", tails.t_two_sided(t, nu))
        .select(
            "feature_a",
            "feature_b",
            rnd(F.col("r"), 4).alias("r"),
            "n",
            "p_value",
            verdict(F.col("p_value"), alpha).alias("significant"),
        )
        .orderBy(F.abs("r").desc(), "feature_a", "feature_b")
    )


def describe_strongest(significance: DataFrame) -> DataFrame:
    """Wording for the strongest pair: strength and direction of the joint movement."""
    size = F.abs("r")
    return significance.orderBy(size.desc(), "feature_a", "feature_b").limit(1).select(
        "feature_a",
        "feature_b",
        "r",
        F.when(size >= 0.7, "strongly").when(size >= 0.4, "moderately").otherwise("weakly").alias("strength"),
        F.when(F.col("r") > 0, "together").otherwise("in opposite directions").alias("direction"),
    )
