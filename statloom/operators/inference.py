"""Hypothesis tests. Data rows are reduced to group statistics first; only those
few rows reach the second stage and the distribution tails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions import tails
from statloom.functions.exprs import ALPHA, melt, name_col, number, present, ratio, rnd, stack_rows, verdict, with_scalars
from statloom.functions.prefix import prefix_sums, suffix_minimum
from statloom.functions.quantiles import GROUP_BROADCAST_LIMIT, group_quantiles
from statloom.functions.roles import LOW_CARDINALITY, numeric_columns
from statloom.functions.skew import attach_by_key
from statloom.session import settle
from statloom.operators.normality import normality
from statloom.operators.correlation import pearson_pairs


# ---- comparisons of group means ---------------------------------------------


def group_stats(long: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sizes, means and variances per group (map-side combined)."""
    return long.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var")
    )


def mean_tests(
    stats: DataFrame, by: list[str], group: str, min_size: int = 2, always_f: bool = False
) -> DataFrame:
    """Welch t (two groups) or one-way ANOVA (more) for each ``by`` from group statistics.

    ``always_f`` keeps the F test for two groups as well.

    ``stats`` has ``(by..., group, n, mean, var)``. Also returns eta squared, which
    counts the groups below ``min_size`` as well.
    """
    stats = settle(stats, "groups")  # a row per group: the data is read once
    n, mean, var = F.col("n"), F.col("mean"), F.coalesce("var", F.lit(0.0))
    used = n >= min_size
    grand = stats.groupBy(*by).agg(
        (F.sum(F.when(used, n * mean)) / F.sum(F.when(used, n))).alias("grand_used"),
        (F.sum(n * mean) / F.sum(n)).alias("grand_all"),
    )
    joined = stats.join(grand, by) if by else stats.transform(with_scalars, grand)

    def side(pick) -> Column:
        return pick(F.struct("n", "mean", "var"), F.when(used, name_col(group)))

    agg = joined.groupBy(*by).agg(
        F.count_if(used).alias("n_groups"),
        F.sum(F.when(used, n)).alias("total"),
        F.sum(F.when(used, n * (mean - F.col("grand_used")) ** 2)).alias("ssb"),
        F.sum(F.when(used, (n - 1) * var)).alias("ssw"),
        F.sum(n * (mean - F.col("grand_all")) ** 2).alias("ssb_all"),
        F.sum((n - 1) * var).alias("ssw_all"),
        side(F.min_by).alias("a"),
        side(F.max_by).alias("b"),
    )
    k, total = F.col("n_groups"), F.col("total")
    va, vb = F.col("a.var") / F.col("a.n"), F.col("b.var") / F.col("b.n")
    infinite = F.lit(float("inf"))
    gap = F.col("a.mean") - F.col("b.mean")
    t = F.when(va + vb > 0, F.try_divide(gap, F.sqrt(va + vb))).when(gap != 0, F.signum(gap) * infinite)
    nu = F.try_divide((va + vb) ** 2, va**2 / (F.col("a.n") - 1) + vb**2 / (F.col("b.n") - 1))
    f = F.when(
        F.col("ssw") > 0, F.try_divide(F.col("ssb") / (k - 1), F.try_divide(F.col("ssw"), (total - k).cast("double")))
    ).when(F.col("ssb") > 0, infinite)
    two = (k == 2) & F.lit(not always_f)
    scored = agg.filter(k >= 2).select(
        *by,
        F.when(two, "Welch t-test").otherwise("one-way ANOVA").alias("test"),
        "n_groups",
        F.when(two, t).otherwise(f).alias("statistic"),
        F.when(two, F.lit(1.0)).otherwise((k - 1).cast("double")).alias("dof1"),
        F.when(two, F.coalesce(nu, total - 2.0)).otherwise((total - k).cast("double")).alias("dof2"),
        ratio(F.col("ssb_all"), F.col("ssb_all") + F.col("ssw_all")).alias("eta_squared"),
    )
    as_f = F.when(F.col("test") == "Welch t-test", F.col("statistic") ** 2).otherwise(F.col("statistic"))
    return scored.withColumn("p_value", tails.f_upper(as_f, F.col("dof1"), F.col("dof2")))


def _pairs(df: DataFrame, value: str, group: str) -> DataFrame:
    return df.select(present(df, group).alias("group"), number(df, value).alias("v")).dropna()


def compare_groups(df: DataFrame, value: str, group: str, alpha: float = ALPHA) -> DataFrame:
    """One row: the test chosen by the number of groups with at least two rows."""
    tested = mean_tests(group_stats(_pairs(df, value, group), ["group"], "v"), [], "group")
    return tested.select(
        "test",
        F.lit(value).alias("numeric"),
        F.lit(group).alias("group"),
        "n_groups",
        rnd(F.col("statistic"), 4).alias("statistic"),
        "p_value",
        verdict(F.col("p_value"), alpha).alias("result"),
    )


def group_means(df: DataFrame, value: str, group: str) -> DataFrame:
    """Mean per group with at least two rows, rounded to four decimals."""
    stats = group_stats(_pairs(df, value, group), ["group"], "v")
    return stats.filter("n >= 2").select(F.col("group").cast("string").alias("group"), "n", rnd(F.col("mean"), 4).alias("mean"))


def eta_squared(df: DataFrame, value: str, group: str) -> DataFrame:
    """Share of the variance explained by the groups."""
    tested = settle(group_stats(_pairs(df, value, group), ["group"], "v"), "groups")
    grand = tested.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    ssb = F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2)
    ssw = F.sum((F.col("n") - 1) * F.coalesce("var", F.lit(0.0)))
    return tested.transform(with_scalars, grand).agg(ratio(ssb, ssb + ssw).alias("eta_squared"))  # one row


def cohens_d(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Standardised mean difference of two groups; NULL when it is undefined."""
    c, g = number(df, value), name_col(group)
    aggs = []
    for side, key in (("a", a), ("b", b)):
        v = F.when(g == F.lit(key), c)
        aggs += [F.count(v).alias(f"n{side}"), F.avg(v).alias(f"m{side}"), F.var_samp(v).alias(f"v{side}")]
    na, nb = F.col("na"), F.col("nb")
    pooled = F.sqrt(((na - 1) * F.col("va") + (nb - 1) * F.col("vb")) / (na + nb - 2))
    d = F.when((na >= 2) & (nb >= 2), F.try_divide(F.col("ma") - F.col("mb"), pooled))
    return df.agg(*aggs).select(F.lit(str(a)).alias("group_a"), F.lit(str(b)).alias("group_b"), d.alias("cohens_d"))


def confidence_intervals(df: DataFrame, names: list[str] | None = None, confidence: float = 0.95) -> DataFrame:
    """t interval of the mean for every numeric column, one scan."""
    names = numeric_columns(df) if names is None else names
    aggs = []
    for i, n in enumerate(names):
        c = number(df, n)
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    rows = [[F.lit(n), F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"s{i}")] for i, n in enumerate(names)]
    long = stack_rows(df.agg(*aggs), rows, ["feature", "n", "mean", "std"])
    margin = tails.t_quantile(F.lit(0.5 + confidence / 2), F.col("n") - 1.0) * F.col("std") / F.sqrt("n")
    enough = F.col("n") >= 2
    return long.withColumn("margin", margin).select(
        "feature",
        "n",
        F.lit(confidence).alias("confidence"),
        rnd(F.col("mean"), 4).alias("mean"),
        F.when(enough, rnd(F.col("mean") - F.col("margin"), 4)).alias("low"),
        F.when(enough, rnd(F.col("mean") + F.col("margin"), 4)).alias("high"),
    )


# ---- contingency tables --------------------------------------------------------


def chi_square_tests(cells: DataFrame, by: list[str]) -> DataFrame:
    """Chi-square of independence per ``by`` from cell counts ``(by..., a, b, o)``.

    Cells that never occur are not materialised: together they contribute their
    expected counts, n minus the expectation of the cells seen. A 2x2 table uses
    the continuity correction, whose deviation is the same in all four cells.
    """
    cells = settle(cells, "cells")  # a row per cell: the data is read once
    rows = cells.groupBy(*by, "a").agg(F.sum("o").alias("row_total"), F.count("*").alias("_k"))
    cols = cells.groupBy(*by, "b").agg(F.sum("o").alias("col_total"), F.count("*").alias("_k"))
    shape = (
        rows.groupBy(*by)
        .agg(F.count("*").alias("r"), F.sum("row_total").alias("n"), F.sum(1 / F.col("row_total")).alias("inv_r"))
        .alias("s")
    )
    shape_c = cols.groupBy(*by).agg(F.count("*").alias("c"), F.sum(1 / F.col("col_total")).alias("inv_c"))
    # a level may hold most of the cells: with a two-valued target every level of it does
    count = cells.count()
    placed = attach_by_key(cells, rows, [*by, "a"], "_k", count)
    placed = attach_by_key(placed, cols, [*by, "b"], "_k", count)
    if by:
        joined = placed.join(shape.join(shape_c, by), by)
    else:
        joined = placed.transform(with_scalars, shape.transform(with_scalars, shape_c))  # one row
    e = F.col("row_total") * F.col("col_total") / F.col("n")
    dev = F.abs(F.col("o") - e)
    agg = joined.groupBy(*by).agg(
        F.first("r").alias("r"),
        F.first("c").alias("c"),
        F.first("n").alias("n"),
        F.sum(dev * dev / e).alias("seen"),
        F.sum(e).alias("expected_seen"),
        F.max(dev).alias("dev"),
        F.first(F.col("inv_r") * F.col("inv_c")).alias("inv"),
    )
    n, r, c = F.col("n"), F.col("r"), F.col("c")
    dof = (r - 1) * (c - 1)
    corrected = F.col("dev") - F.least(F.lit(0.5), F.col("dev"))
    plain = F.col("seen") + (n - F.col("expected_seen"))
    chi2 = F.greatest(F.lit(0.0), F.when(dof == 1, corrected * corrected * n * F.col("inv")).otherwise(plain))
    return (
        agg.filter((r >= 2) & (c >= 2))
        .select(*by, n.cast("long").alias("n"), chi2.alias("chi2"), dof.cast("long").alias("dof"), F.least(r, c).alias("_m"))
        .withColumn("p_value", tails.chi2_upper(F.col("chi2"), F.col("dof")))
        .withColumn("cramers_v", F.sqrt(F.col("chi2") / (F.col("n") * (F.col("_m") - 1))))
        .drop("_m")
    )


def _cells(df: DataFrame, a: str, b: str) -> DataFrame:
    return (
        df.select(present(df, a).alias("a"), present(df, b).alias("b")).dropna().groupBy("a", "b").agg(F.count("*").alias("o"))
    )


def chi_square_independence(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """One row: chi-square test of two categorical columns with Cramer's V."""
    return chi_square_tests(_cells(df, a, b), []).select(
        F.lit("chi-square independence").alias("test"),
        F.lit(a).alias("var_a"),
        F.lit(b).alias("var_b"),
        rnd(F.col("chi2"), 4).alias("chi2"),
        "dof",
        "p_value",
        rnd(F.col("cramers_v"), 4).alias("cramers_v"),
        verdict(F.col("p_value"), alpha).alias("result"),
    )


def crosstab(df: DataFrame, a: str, b: str, levels: list | None = None) -> DataFrame:
    """Contingency counts, one column per level of ``b`` (levels read first if not given)."""
    sub = df.select(present(df, a).alias(a), present(df, b).alias(b)).dropna()
    pivot = sub.groupBy(name_col(a)).pivot(b, levels) if levels else sub.groupBy(name_col(a)).pivot(b)
    return pivot.count().na.fill(0)


# ---- feature against target ----------------------------------------------------


def feature_target_screen(df: DataFrame, target: str, alpha: float = ALPHA) -> DataFrame:
    """Test every feature against the target; at most two jobs whatever the column count.

    Pearson for number/number, Welch t or ANOVA for number/category either way round,
    chi-square for category/category. A numeric target with few values is a category.
    """
    nums = [c for c in numeric_columns(df) if c != target]
    others = [c for c in df.columns if c != target and c not in nums and isinstance(df.schema[c].dataType, T.AtomicType)]
    target_numeric = target in numeric_columns(df)
    if target_numeric:
        levels = df.agg(F.countDistinct(number(df, target)).alias("d")).first()["d"]
        target_numeric = levels > LOW_CARDINALITY
    cols = ["feature", "test", "statistic", "p_value"]
    parts = []
    known = df.filter(present(df, target).isNotNull())
    if target_numeric:
        if nums:
            r = pearson_pairs(known, [(c, target) for c in nums]).filter("n >= 3 AND r IS NOT NULL")
            bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("r")))
            nu = F.col("n") - 2.0
            t = F.when(F.abs(bounded) >= 1, float("inf")).otherwise(bounded * F.sqrt(nu / (1 - bounded * bounded)))
            parts.append(
                r.withColumn("p_value", tails.t_two_sided(t, nu)).select(
                    F.col("feature_a").alias("feature"), F.lit("pearson").alias("test"), F.col("r").alias("statistic"), "p_value"
                )
            )
        if others:
            long = melt(
                known.withColumn("_target", number(known, target)), others, "value", keep=["_target"], text=True
            )
            parts.append(mean_tests(group_stats(long, ["feature", "value"], "_target"), ["feature"], "value").select(*cols))
    else:
        keyed = known.withColumn("_target", present(known, target).cast("string"))
        if nums:
            long = melt(keyed, nums, "v", keep=["_target"])
            parts.append(mean_tests(group_stats(long, ["feature", "_target"], "v"), ["feature"], "_target").select(*cols))
        if others:
            long = melt(keyed, others, "a", keep=["_target"], text=True)
            cells = long.groupBy("feature", "a", F.col("_target").alias("b")).agg(F.count("*").alias("o"))
            parts.append(
                chi_square_tests(cells, ["feature"]).select(
                    "feature", F.lit("chi-square").alias("test"), F.col("chi2").alias("statistic"), "p_value"
                )
            )
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, test string, statistic double, p_value double, significant string")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "feature", "test", rnd(F.col("statistic"), 4).alias("statistic"), "p_value", verdict(F.col("p_value"), alpha).alias("significant")
    ).orderBy(F.col("p_value").asc_nulls_last(), "feature")


def correct_pvalues(table: DataFrame, p: str = "p_value", method: str = "fdr_bh", alpha: float = ALPHA) -> DataFrame:
    """Add ``p_adjusted`` and ``reject``: Bonferroni or Benjamini-Hochberg step-up.

    Equal p-values share the adjustment of the last of them, so ranks are running
    counts over distinct values; neither step needs all p-values in one task.
    """
    if method == "bonferroni":
        total = table.agg(F.count(p).alias("_n"))
        out = table.transform(with_scalars, total)  # one row
        adjusted = F.least(name_col(p) * F.col("_n"), F.lit(1.0))
        return out.withColumn("p_adjusted", adjusted).drop("_n").withColumn("reject", F.col("p_adjusted") < alpha)
    if method != "fdr_bh":
        raise ValueError(f"unknown method '{method}'")
    counts = table.filter(name_col(p).isNotNull()).groupBy(name_col(p).alias("_p")).agg(F.count("*").alias("_c"))
    total = counts.agg(F.sum("_c").alias("_n"))
    ranked = prefix_sums(counts, "_p", ["_c"]).transform(with_scalars, total)  # one row
    stepped = ranked.withColumn("_s", F.col("_p") * F.col("_n") / F.col("_c_upto"))
    adjusted = suffix_minimum(stepped, "_p", "_s", "_adj").select(
        F.col("_p"), "_c", F.least(F.col("_adj"), F.lit(1.0)).alias("p_adjusted")
    )
    # one p-value may be that of most rows: 0 is the usual one
    known = table.filter(name_col(p).isNotNull()).withColumn("_p", name_col(p))
    out = attach_by_key(known, adjusted, ["_p"], "_c", total.first()["_n"] or 0).select(*[name_col(c) for c in table.columns], "p_adjusted")
    missing = table.filter(name_col(p).isNull()).withColumn("p_adjusted", F.lit(None).cast("double"))
    return out.unionByName(missing).withColumn("reject", F.col("p_adjusted") < alpha)


def corrected_screen(df: DataFrame, target: str, method: str = "fdr_bh", alpha: float = ALPHA) -> DataFrame:
    """The feature screen with adjusted p-values and the decision after correction."""
    screen = settle(feature_target_screen(df, target, alpha), "screen")  # one row per feature
    return correct_pvalues(screen, "p_value", method, alpha)


def assumption_checks(df: DataFrame, value: str, group: str, alpha: float = ALPHA) -> DataFrame:
    """One row: normality in all groups, equal variance (Levene, median-centred), advice."""
    pairs = _pairs(df, value, group)
    sizes = pairs.groupBy("group").agg(F.count("*").alias("n")).filter("n >= 3").select("group")
    medians = group_quantiles(pairs, ["group"], "v", [0.5]).select("group", F.col("q")[0].alias("median"))
    kept = sizes.join(medians, "group")
    if sizes.count() <= GROUP_BROADCAST_LIMIT:
        kept = F.broadcast(kept)
    rows = pairs.join(kept, "group")
    centred = rows.withColumn("dev", F.abs(F.col("v") - F.col("median")))
    levene = mean_tests(group_stats(centred, ["group"], "dev"), [], "group", always_f=True).select(
        "n_groups", F.col("statistic").alias("levene_statistic"), F.col("p_value").alias("levene_p")
    )
    normal = normality(rows, ["v"], ["group"], min_n=3).agg(
        F.min(F.col("p_value") >= alpha).alias("all_groups_normal")
    )
    two = F.col("n_groups") == 2
    equal = F.col("levene_p") >= alpha
    advice = (
        F.when(~F.col("all_groups_normal"), F.when(two, "Mann-Whitney U (non-parametric)").otherwise("Kruskal-Wallis (non-parametric)"))
        .when(two, F.when(equal, "Student t-test").otherwise("Welch t-test"))
        .otherwise(F.when(equal, "one-way ANOVA").otherwise("Welch ANOVA"))
    )
    return levene.transform(with_scalars, normal).select(  # one row each
        "n_groups",
        "all_groups_normal",
        equal.alias("equal_variance"),
        rnd(F.col("levene_statistic"), 4).alias("levene_statistic"),
        rnd(F.col("levene_p"), 4).alias("levene_p"),
        advice.alias("recommended_test"),
    )
