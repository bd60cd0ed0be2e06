"""Registered queries: correlation, hypothesis tests, trend and chart data."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from statloom.functions.exprs import p_text
from statloom.functions.exprs import rnd as round_to
from statloom.operators import charts, correlation, describe, inference, normality, trend
from statloom.plans.describe_queries import LINEITEM_NUM, long_sql
from statloom.plans.profile_queries import DIRTY_SQL, dirty
from statloom.plans.registry import chi2_tail, f_tail, query, rnd, t_tail
from statloom.sources.tables import table


def _round(df, *names, digits=6):
    return df.select(*[(round_to(F.col(c), digits).alias(c) if c in names else F.col(f"`{c}`")) for c in df.columns])


def pairs_sql(src: str, columns: list[str], digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM {src}"
        for a, b in combinations(columns, 2)
    )


# ---- correlation -----------------------------------------------------------------

MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {rnd(f'corr({a}, {b})' if a != b else '1.0', 4)} AS correlation FROM lineitem"
    for a in LINEITEM_NUM
    for b in LINEITEM_NUM
)


@query("correlation_matrix", f"SELECT DISTINCT * FROM ({MATRIX})")
def _matrix(spark, sf):
    return correlation.correlation_matrix(table(spark, sf, "lineitem"))


DIRTY_NUM = ["l_discount", "l_tax", "l_quantity"]


@query(
    "correlation_pairwise_complete",
    f"SELECT feature_a, feature_b, {rnd('r', 6)} AS r, CAST(n AS BIGINT) AS n FROM ({pairs_sql(DIRTY_SQL, DIRTY_NUM)})",
)
def _pairwise(spark, sf):
    return _round(correlation.correlation_pairs(dirty(spark, sf)), "r")


def spearman_sql(src: str, columns: list[str]) -> str:
    def rank(c):
        return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)"

    return " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(ra, rb) AS r, count(*) AS n FROM
(SELECT {rank(a)} AS ra, {rank(b)} AS rb FROM {src} AS t WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
        for a, b in combinations(columns, 2)
    )


SPEARMAN_COLS = ["l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


@query(
    "correlation_spearman",
    f"SELECT feature_a, feature_b, {rnd('r', 6)} AS r, CAST(n AS BIGINT) AS n FROM ({spearman_sql('lineitem', SPEARMAN_COLS)})",
)
def _spearman(spark, sf):
    df = table(spark, sf, "lineitem").select(*SPEARMAN_COLS)
    return _round(correlation.correlation_pairs(df, "spearman"), "r")


@query(
    "correlation_spearman_with_nulls",
    f"SELECT feature_a, feature_b, {rnd('r', 6)} AS r, CAST(n AS BIGINT) AS n FROM ({spearman_sql(DIRTY_SQL, DIRTY_NUM)})",
)
def _spearman_nulls(spark, sf):
    return _round(correlation.correlation_pairs(dirty(spark, sf), "spearman"), "r")


def kendall_sql(src: str, columns: list[str]) -> str:
    parts = []
    for a, b in combinations(columns, 2):
        g = f"(SELECT {a} AS x, {b} AS y, CAST(count(*) AS DOUBLE) AS w FROM {src} GROUP BY 1, 2)"
        pairs = f"(SELECT sum(w) * (sum(w) - 1) / 2 FROM {g})"
        tied = {c: f"(SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(w) AS t FROM {g} GROUP BY {c}))" for c in "xy"}
        score = f"(SELECT sum(p.w * q.w * sign(p.x - q.x) * sign(p.y - q.y)) / 2 FROM {g} p, {g} q)"
        parts.append(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
            f"{score} / sqrt(({pairs} - {tied['x']}) * ({pairs} - {tied['y']})) AS r, (SELECT sum(w) FROM {g}) AS n"
        )
    return " UNION ALL ".join(parts)


KENDALL_COLS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "correlation_kendall",
    f"SELECT feature_a, feature_b, {rnd('r', 6)} AS r, CAST(n AS BIGINT) AS n FROM ({kendall_sql('lineitem', KENDALL_COLS)})",
)
def _kendall(spark, sf):
    df = table(spark, sf, "lineitem").select(*KENDALL_COLS)
    return _round(correlation.correlation_pairs(df, "kendall"), "r")


TOP = f"""SELECT feature_a, feature_b, {rnd('r', 4)} AS correlation FROM ({pairs_sql('lineitem', LINEITEM_NUM)})
ORDER BY abs(correlation) DESC, feature_a, feature_b LIMIT 10"""


@query("top_correlations", TOP)
def _top(spark, sf):
    return correlation.top_correlations(table(spark, sf, "lineitem"))


# lineitem with a price per piece, so that some pairs are correlated
PIECES_SQL = "(SELECT *, l_extendedprice / l_quantity AS piece_price FROM lineitem)"


@query(
    "correlation_analysis",
    f"""SELECT feature_a AS column_a, feature_b AS column_b, {rnd('r', 4)} AS correlation,
CASE WHEN abs(r) >= 0.9 THEN 'very strong' WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.5 THEN 'moderate' ELSE 'weak' END AS strength,
CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction, CAST(36 AS BIGINT) AS total_pairs_analyzed
FROM ({pairs_sql(PIECES_SQL, [*LINEITEM_NUM, 'piece_price'])}) WHERE abs(r) >= 0.3""",
)
def _analysis(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("piece_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return correlation.correlation_analysis(df)


def significance_sql(src: str, columns: list[str]) -> str:
    complete = f"(SELECT * FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in columns) + ")"
    t = "r * sqrt((n - 2) / (1 - r * r))"
    return f"""SELECT feature_a, feature_b, {rnd('r', 4)} AS r, CAST(n AS BIGINT) AS n, {rnd('p', 6)} AS p_value,
CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS significant
FROM (SELECT *, {t_tail(t, 'n - 2.0')} AS p FROM ({pairs_sql(complete, columns)}))"""


@query("correlation_significance", significance_sql(DIRTY_SQL, DIRTY_NUM))
def _significance(spark, sf):
    return _round(correlation.correlation_significance(dirty(spark, sf)), "p_value")


@query("correlation_significance_lineitem", significance_sql("lineitem", LINEITEM_NUM))
def _significance_all(spark, sf):
    return _round(correlation.correlation_significance(table(spark, sf, "lineitem")), "p_value")


@query(
    "strongest_relationship",
    f"""SELECT feature_a, feature_b, correlation AS r,
CASE WHEN abs(correlation) >= 0.7 THEN 'strongly' WHEN abs(correlation) >= 0.4 THEN 'moderately' ELSE 'weakly' END AS strength,
CASE WHEN correlation > 0 THEN 'together' ELSE 'in opposite directions' END AS direction FROM ({TOP}) LIMIT 1""",
)
def _strongest(spark, sf):
    return correlation.describe_strongest(correlation.correlation_significance(table(spark, sf, "lineitem")))


# ---- group comparisons -------------------------------------------------------------


def compare_sql(src: str, value: str, group: str) -> str:
    return f"""
WITH g AS (SELECT {group} AS k, count({value}) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {src}
           WHERE {group} IS NOT NULL AND {value} IS NOT NULL GROUP BY {group} HAVING count({value}) >= 2),
o AS (SELECT sum(n * m) / sum(n) AS grand, sum(n) AS total, count(*) AS k FROM g),
a AS (SELECT any_value(o.k) AS groups, sum(n * (m - grand) * (m - grand)) / (any_value(o.k) - 1) AS msb,
      sum((n - 1) * v) / any_value(total - o.k) AS msw, any_value(total - o.k) AS d2, arg_min(m, g.k) AS m1, arg_max(m, g.k) AS m2,
      arg_min(v / n, g.k) AS e1, arg_max(v / n, g.k) AS e2, arg_min(n, g.k) AS n1, arg_max(n, g.k) AS n2 FROM g, o),
s AS (SELECT groups, CASE WHEN groups = 2 THEN (m1 - m2) / sqrt(e1 + e2) ELSE msb / msw END AS stat,
      CASE WHEN groups = 2 THEN 1.0 ELSE groups - 1.0 END AS d1,
      CASE WHEN groups = 2 THEN (e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) ELSE d2 END AS d2 FROM a),
p AS (SELECT *, {f_tail("CASE WHEN groups = 2 THEN stat * stat ELSE stat END", "d1", "d2")} AS p FROM s)"""


def compare_select(src: str, value: str, group: str) -> str:
    return (
        compare_sql(src, value, group)
        + f"""
SELECT CASE WHEN groups = 2 THEN 'Welch t-test' ELSE 'one-way ANOVA' END AS test, '{value}' AS numeric, '{group}' AS "group",
CAST(groups AS BIGINT) AS n_groups, {rnd('stat', 4)} AS statistic, {rnd('p', 6)} AS p_value,
CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS result FROM p"""
    )


@query("compare_groups_welch", compare_select("lineitem", "l_extendedprice", "l_linestatus"))
def _welch(spark, sf):
    return _round(inference.compare_groups(table(spark, sf, "lineitem"), "l_extendedprice", "l_linestatus"), "p_value")


@query("compare_groups_anova", compare_select("orders", "o_totalprice", "o_orderstatus"))
def _anova(spark, sf):
    return _round(inference.compare_groups(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus"), "p_value")


@query("compare_groups_documents", compare_select("documents", "n_chars", "lang"))
def _anova_docs(spark, sf):
    return _round(inference.compare_groups(table(spark, sf, "documents"), "n_chars", "lang"), "p_value")


@query(
    "group_means",
    f"""SELECT p_brand AS "group", count(*) AS n, {rnd('avg(p_retailprice)', 4)} AS mean FROM part GROUP BY p_brand HAVING count(*) >= 2""",
)
def _group_means(spark, sf):
    return inference.group_means(table(spark, sf, "part"), "p_retailprice", "p_brand")


@query(
    "eta_squared",
    f"""WITH t AS (SELECT o_totalprice AS v, o_orderpriority AS k FROM orders), o AS (SELECT avg(v) AS g FROM t)
SELECT {rnd('(SELECT sum(n * (m - g) * (m - g)) FROM (SELECT count(*) AS n, avg(v) AS m FROM t GROUP BY k), o) / (SELECT sum((v - g) * (v - g)) FROM t, o)', 8)}
AS eta_squared""",
)
def _eta(spark, sf):
    return _round(inference.eta_squared(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority"), "eta_squared", digits=8)


@query(
    "cohens_d",
    f"""WITH a AS (SELECT count(*) AS n, avg(n_chars) AS m, var_samp(n_chars) AS v FROM documents WHERE lang = 'en'),
b AS (SELECT count(*) AS n, avg(n_chars) AS m, var_samp(n_chars) AS v FROM documents WHERE lang = 'fr')
SELECT 'en' AS group_a, 'fr' AS group_b,
{rnd('(a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2))', 6)} AS cohens_d FROM a, b""",
)
def _cohen(spark, sf):
    return _round(inference.cohens_d(table(spark, sf, "documents"), "n_chars", "lang", "en", "fr"), "cohens_d")


@query("confidence_intervals")
def _intervals(spark, sf):
    return inference.confidence_intervals(table(spark, sf, "lineitem"))


@query(
    "confidence_interval_means",
    f"""WITH s AS (SELECT feature, count(v) AS n, avg(v) AS m, stddev_samp(v) / sqrt(count(v)) AS se FROM ({long_sql('orders', ['o_orderkey', 'o_custkey', 'o_totalprice'])}) GROUP BY feature)
SELECT feature, n, {rnd('m', 4)} AS mean, {rnd(t_tail('1.96', 'n - 1.0'), 6)} AS tail_at_196 FROM s""",
)
def _interval_means(spark, sf):
    from statloom.functions import tails

    ci = inference.confidence_intervals(table(spark, sf, "orders"))
    tail = tails.t_two_sided(F.lit(1.96), F.col("n") - 1.0)
    return ci.select("feature", "n", "mean", round_to(tail, 6).alias("tail_at_196"))


@query(
    "confidence_bounds",
    f"""SELECT feature, CAST(0.05 AS DOUBLE) AS beyond_low, CAST(0.05 AS DOUBLE) AS beyond_high
FROM ({long_sql('orders', ['o_orderkey', 'o_custkey', 'o_totalprice'])}) GROUP BY feature""",
)
def _bounds(spark, sf):
    """The two-sided t tail beyond either bound is what the confidence leaves."""
    from statloom.functions import tails

    df = table(spark, sf, "orders")
    spread = describe.descriptive_stats(df).select("feature", (F.col("std") / F.sqrt("count")).alias("se"))
    ci = inference.confidence_intervals(df).join(spread, "feature")
    tail = [tails.t_two_sided(d / F.col("se"), F.col("n") - 1.0) for d in (F.col("mean") - F.col("low"), F.col("high") - F.col("mean"))]
    return ci.select("feature", round_to(tail[0], 3).alias("beyond_low"), round_to(tail[1], 3).alias("beyond_high"))


# ---- contingency -------------------------------------------------------------------


def chi_sql(src: str, a: str, b: str) -> str:
    stat = """CASE WHEN (r - 1) * (c - 1) = 1 THEN sum((abs(o - e) - least(0.5, abs(o - e))) * (abs(o - e) - least(0.5, abs(o - e))) / e)
ELSE sum((o - e) * (o - e) / e) END"""
    return f"""
WITH t AS (SELECT CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
ra AS (SELECT a, count(*) AS rt FROM t GROUP BY a), cb AS (SELECT b, count(*) AS ct FROM t GROUP BY b),
n AS (SELECT count(*) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c FROM t),
cells AS (SELECT ra.a, cb.b, coalesce(x.o, 0) AS o, rt * ct * 1.0 / n AS e, n, r, c FROM ra CROSS JOIN cb CROSS JOIN n
          LEFT JOIN (SELECT a, b, count(*) AS o FROM t GROUP BY a, b) x ON x.a = ra.a AND x.b = cb.b),
s AS (SELECT {stat} AS chi2, (r - 1) * (c - 1) AS dof, n, least(r, c) AS m FROM cells GROUP BY n, r, c),
p AS (SELECT *, {chi2_tail('chi2', 'dof')} AS p FROM s)"""


def chi_select(src: str, a: str, b: str) -> str:
    return (
        chi_sql(src, a, b)
        + f"""
SELECT 'chi-square independence' AS test, '{a}' AS var_a, '{b}' AS var_b, {rnd('chi2', 4)} AS chi2, CAST(dof AS BIGINT) AS dof,
{rnd('p', 6)} AS p_value, {rnd('sqrt(chi2 / (n * (m - 1)))', 4)} AS cramers_v,
CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS result FROM p"""
    )


@query("chi_square_independence", chi_select("orders", "o_orderpriority", "o_orderstatus"))
def _chi(spark, sf):
    return _round(inference.chi_square_independence(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"), "p_value")


@query("chi_square_two_by_two", chi_select("labels", "quality", "toxic"))
def _chi2x2(spark, sf):
    return _round(inference.chi_square_independence(table(spark, sf, "labels"), "quality", "toxic"), "p_value")


@query("chi_square_sparse_cells", chi_select("documents", "source", "lang"))
def _chi_docs(spark, sf):
    return _round(inference.chi_square_independence(table(spark, sf, "documents"), "source", "lang"), "p_value")


@query(
    "crosstab",
    """SELECT l_returnflag, CAST(count(*) FILTER (l_linestatus = 'F') AS BIGINT) AS F,
CAST(count(*) FILTER (l_linestatus = 'O') AS BIGINT) AS O FROM lineitem GROUP BY l_returnflag""",
)
def _crosstab(spark, sf):
    return inference.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


# ---- screen ----------------------------------------------------------------------------


def screen_groups(features: list[str], src: str, target: str, target_first: bool) -> str:
    """Mean tests of several numeric features by one group column, or the reverse."""
    parts = []
    for f in features:
        value, group = (target, f) if target_first else (f, target)
        parts.append(
            f"SELECT '{f}' AS feature, CASE WHEN groups = 2 THEN 'Welch t-test' ELSE 'one-way ANOVA' END AS test, stat, p FROM ("
            + compare_sql(src, value, group)
            + " SELECT * FROM p)"
        )
    return " UNION ALL ".join(parts)


def screen_chi(features: list[str], src: str, target: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, 'chi-square' AS test, chi2 AS stat, p FROM (" + chi_sql(src, f, target) + " SELECT * FROM p)"
        for f in features
    )


SCREENED = f"""SELECT feature, test, {rnd('stat', 4)} AS statistic, {rnd('p', 6)} AS p_value,
CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS significant"""
CAT_SCREEN = (
    screen_groups(["o_custkey", "o_totalprice"], "orders", "o_orderstatus", False)
    + " UNION ALL "
    + screen_chi(["o_orderpriority"], "orders", "o_orderstatus")
)


@query("feature_screen_categorical_target", f"{SCREENED} FROM ({CAT_SCREEN})")
def _screen_cat(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return _round(inference.feature_target_screen(df, "o_orderstatus"), "p_value")


NUM_SCREEN = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, 'pearson' AS test, r AS stat, {t_tail('r * sqrt((n - 2) / (1 - r * r))', 'n - 2.0')} AS p FROM (SELECT corr({f}, l_extendedprice) AS r, count(*) AS n FROM lineitem)"
    for f in ["l_quantity", "l_discount", "l_tax"]
)


@query(
    "feature_screen_numeric_target",
    f"{SCREENED} FROM ({NUM_SCREEN} UNION ALL {screen_groups(['l_returnflag', 'l_linestatus'], 'lineitem', 'l_extendedprice', True)})",
)
def _screen_num(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_extendedprice"
    )
    return _round(inference.feature_target_screen(df, "l_extendedprice"), "p_value")


LABELLED = "(SELECT d.lang, d.source, d.n_chars, l.toxic, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query(
    "feature_screen_low_cardinality_target",
    f"{SCREENED} FROM ({screen_groups(['n_chars', 'toxic'], LABELLED, 'quality', False)} UNION ALL {screen_chi(['lang', 'source'], LABELLED, 'quality')})",
)
def _screen_low(spark, sf):
    df = (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id")
        .select("lang", "source", "n_chars", "toxic", "quality")
    )
    return _round(inference.feature_target_screen(df, "quality"), "p_value")


def adjust_sql(src: str, method: str) -> str:
    if method == "bonferroni":
        adj = "least(p * count(*) OVER (), 1.0)"
        inner = f"SELECT *, {adj} AS adj FROM ({src})"
    else:
        inner = f"""SELECT *, least(1.0, min(p * n / rk) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS adj
FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY p) AS rk FROM ({src}))"""
    return f"SELECT feature, test, {rnd('p', 6)} AS p_value, {rnd('adj', 6)} AS p_adjusted, adj < 0.05 AS reject FROM ({inner})"


def _adjusted(spark, sf, method):
    df = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    out = inference.corrected_screen(df, "o_orderstatus", method)
    return _round(out.select("feature", "test", "p_value", "p_adjusted", "reject"), "p_value", "p_adjusted")


@query("p_values_benjamini_hochberg", adjust_sql(CAT_SCREEN, "fdr_bh"))
def _bh(spark, sf):
    return _adjusted(spark, sf, "fdr_bh")


@query("p_values_bonferroni", adjust_sql(CAT_SCREEN, "bonferroni"))
def _bonferroni(spark, sf):
    return _adjusted(spark, sf, "bonferroni")


@query(
    "p_value_text",
    f"""SELECT feature, CASE WHEN p < 0.001 THEN '<0.001' ELSE printf('%.3f', p) END AS p_text FROM ({NUM_SCREEN})""",
)
def _p_text(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return inference.feature_target_screen(df, "l_extendedprice").select("feature", p_text(F.col("p_value")).alias("p_text"))


# ---- assumptions ---------------------------------------------------------------------------


@query(
    "levene_test",
    f"""
WITH m AS (SELECT lang, median(n_chars) AS med FROM documents GROUP BY lang HAVING count(*) >= 3),
z AS (SELECT d.lang AS k, abs(n_chars - med) AS v FROM documents d JOIN m USING (lang)),
g AS (SELECT k, count(*) AS n, avg(v) AS m, var_samp(v) AS v FROM z GROUP BY k),
o AS (SELECT sum(n * m) / sum(n) AS grand, sum(n) AS total, count(*) AS k FROM g),
s AS (SELECT any_value(o.k) AS k, any_value(total) AS total, (sum(n * (m - grand) * (m - grand)) / any_value(o.k - 1)) / (sum((n - 1) * v) / any_value(total - o.k)) AS f FROM g, o)
SELECT CAST(k AS BIGINT) AS n_groups, {rnd('f', 4)} AS levene_statistic, {rnd(f_tail('f', 'k - 1.0', 'total - k'), 4)} AS levene_p FROM s""",
)
def _levene(spark, sf):
    return inference.assumption_checks(table(spark, sf, "documents"), "n_chars", "lang").select(
        "n_groups", "levene_statistic", "levene_p"
    )


@query("assumption_checks")
def _assumptions(spark, sf):
    return inference.assumption_checks(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus")


def k2_sql(src: str, columns: list[str]) -> str:
    return f"""
WITH m AS (SELECT feature, count(v) AS cnt, CAST(count(v) AS DOUBLE) AS n, avg(v) AS mu FROM ({long_sql(src, columns)}) GROUP BY feature),
c AS (SELECT feature, any_value(cnt) AS cnt, any_value(n) AS n, avg(pow(v - mu, 2)) AS m2, avg(pow(v - mu, 3)) AS m3, avg(pow(v - mu, 4)) AS m4
      FROM ({long_sql(src, columns)}) JOIN m USING (feature) GROUP BY feature),
g AS (SELECT feature, cnt, n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM c),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
      (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM g),
b AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS aa FROM a),
z AS (SELECT feature, cnt, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
      (1 - 2 / (9 * aa) - cbrt((1 - 2 / aa) / (1 + x * sqrt(2 / (aa - 4))))) / sqrt(2 / (9 * aa)) AS z2 FROM b)
SELECT feature, cnt AS n, 'D''Agostino-Pearson' AS test, {rnd('z1 * z1 + z2 * z2', 4)} AS statistic, {rnd('exp(-(z1 * z1 + z2 * z2) / 2)', 6)} AS p_value,
exp(-(z1 * z1 + z2 * z2) / 2) >= 0.05 AS normal,
CASE WHEN exp(-(z1 * z1 + z2 * z2) / 2) >= 0.05 THEN 'fails to reject normality' ELSE 'departs from normality' END AS note FROM z"""


@query("normality_large", k2_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def _k2(spark, sf):
    report = normality.normality_report(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )
    return _round(report, "p_value")


@query("normality_small")
def _shapiro(spark, sf):
    return normality.normality_report(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])


# ---- time series ------------------------------------------------------------------------------


def calendar_sql(src: str, when: str, value: str, unit: str) -> str:
    return f"""
WITH p AS (SELECT date_trunc('{unit}', {when}) AS period, avg({value}) AS value, count({value}) AS n FROM {src}
           WHERE {when} IS NOT NULL AND {value} IS NOT NULL GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT min(period)::TIMESTAMP FROM p), (SELECT max(period)::TIMESTAMP FROM p), INTERVAL 1 {unit})) AS period),
m AS (SELECT row_number() OVER (ORDER BY cal.period) - 1 AS position, cal.period, value, coalesce(n, 0) AS n
      FROM cal LEFT JOIN p ON cal.period = p.period)"""


@query(
    "trend_analysis",
    calendar_sql("orders", "o_orderdate", "o_totalprice", "month")
    + f""",
f AS (SELECT count(*) AS k, regr_slope(value, position) AS slope, arg_min(value, position) FILTER (value IS NOT NULL) AS s,
      arg_max(value, position) FILTER (value IS NOT NULL) AS e FROM m)
SELECT 'o_orderdate' AS date_column, 'o_totalprice' AS value_column,
CASE WHEN slope > 0 THEN 'upward' WHEN slope < 0 THEN 'downward' ELSE 'flat' END AS trend_direction, {rnd('slope', 4)} AS slope,
{rnd('100 * (e - s) / abs(s)', 2)} AS pct_change_overall, {rnd('s', 4)} AS start_value, {rnd('e', 4)} AS end_value, k AS period_count FROM f""",
)
def _trend(spark, sf):
    return _round(trend.trend_analysis(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"), "start_value", "end_value", digits=4)


@query(
    "monthly_averages",
    calendar_sql("orders", "o_orderdate", "o_totalprice", "month")
    + f" SELECT position, strftime(last_day(period), '%Y-%m-%d') AS period, {rnd('value', 4)} AS value FROM m",
)
def _monthly(spark, sf):
    return _round(trend.monthly_averages(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"), "value", digits=4)


@query(
    "resample_daily_with_gaps",
    # all events, moved apart so that days without any lie between
    calendar_sql("(SELECT CAST('2024-01-01' AS TIMESTAMP) + to_days(CAST(4 * (day(ts) + 31 * month(ts)) AS INTEGER)) AS ts, value FROM events WHERE ts IS NOT NULL)", "ts", "value", "day")
    + f" SELECT position, strftime(period, '%Y-%m-%d') AS period, {rnd('value', 4)} AS value, n FROM m",
)
def _daily(spark, sf):
    moved = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(4 * (day(ts) + 31 * month(ts)))")
    df = table(spark, sf, "events").where("ts is not null").select(moved.alias("ts"), "value")
    out = trend.resample(df, "ts", "value", "day")
    return _round(out.withColumn("period", F.date_format("period", "yyyy-MM-dd")), "value", digits=4)


@query(
    "line_series",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders WHERE o_orderdate IS NOT NULL",
)
def _line(spark, sf):
    return trend.line_series(table(spark, sf, "orders"), "o_orderdate", ["o_totalprice"])


# ---- chart data -------------------------------------------------------------------------------------


def histogram_sql(src: str, column: str, bins: int) -> str:
    return f"""
WITH r AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins}.0 AS w FROM {src}),
c AS (SELECT CAST(least(floor(({column} - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS k FROM {src}, r GROUP BY 1)
SELECT CAST(b.i AS INTEGER) AS bin, {rnd('lo + i * w', 4)} AS lower, {rnd('lo + (i + 1) * w', 4)} AS upper, coalesce(k, 0) AS count
FROM range({bins}) b(i) CROSS JOIN r LEFT JOIN c ON c.bin = b.i"""


@query("histogram", histogram_sql("lineitem", "l_extendedprice", 30))
def _histogram(spark, sf):
    return _round(charts.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), "lower", "upper", digits=4)


@query("histogram_fifty_bins", histogram_sql("documents", "n_chars", 50))
def _histogram50(spark, sf):
    return _round(charts.histogram(table(spark, sf, "documents"), "n_chars", 50), "lower", "upper", digits=4)


@query("bar_counts", "SELECT p_brand AS category, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def _bars(spark, sf):
    return charts.bar_counts(table(spark, sf, "part"), "p_brand")


@query(
    "bar_means",
    f"SELECT category, {rnd('mean', 4)} AS mean FROM (SELECT p_brand AS category, avg(p_retailprice) AS mean FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)",
)
def _bar_means(spark, sf):
    return _round(charts.bar_means(table(spark, sf, "part"), "p_brand", "p_retailprice"), "mean", digits=4)


@query(
    "pie_shares",
    f"SELECT event_type AS category, count(*) AS count, {rnd('100.0 * count(*) / (SELECT count(*) FROM events)', 2)} AS share_pct FROM events GROUP BY 1",
)
def _pie(spark, sf):
    return charts.pie_shares(table(spark, sf, "events"), "event_type")


@query("scatter_points")
def _scatter(spark, sf):
    return charts.scatter_points(
        table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag",
        key=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    )


@query(
    "scatter_points_are_rows",
    """SELECT least(2000, count(*) FILTER (l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL)) AS points,
TRUE AS all_in_table FROM lineitem""",
)
def _scatter_rows(spark, sf):
    points = _scatter(spark, sf)
    names = ["l_quantity", "l_extendedprice", "l_returnflag"]
    known = table(spark, sf, "lineitem").select(*[F.col(c).cast(points.schema[c].dataType).alias(c) for c in names]).distinct()
    known = known.withColumn("known", F.lit(True))
    return points.join(known, names, "left").agg(F.count("*").alias("points"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_in_table"))


@query(
    "trend_line",
    f"""WITH f AS (SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i,
min(l_quantity) AS a, max(l_quantity) AS b FROM lineitem)
SELECT n, {rnd('s', 4)} AS slope, {rnd('i', 4)} AS intercept, a AS x_start, b AS x_end, {rnd('i + s * a', 4)} AS y_start, {rnd('i + s * b', 4)} AS y_end FROM f""",
)
def _trend_line(spark, sf):
    out = charts.trend_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return _round(out, "slope", "intercept", "y_start", "y_end", digits=4)


@query(
    "heatmap",
    "SELECT DISTINCT feature_a, feature_b, round_even(correlation * 1e3, 0) / 1e3 AS correlation FROM ("
    + MATRIX.replace("1e4", "1e9")
    + ")",
)
def _heatmap(spark, sf):
    return charts.heatmap(table(spark, sf, "lineitem"))


@query(
    "box_stats",
    f"""WITH t AS (SELECT lang AS g, n_chars AS v FROM documents),
q AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM t GROUP BY g)
SELECT g AS "group", {rnd('any_value(q1)', 4)} AS q1, {rnd('any_value(q2)', 4)} AS median, {rnd('any_value(q3)', 4)} AS q3, count(*) AS n,
CAST(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_low,
CAST(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_high,
CAST(count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
{rnd('avg(v)', 4)} AS mean, {rnd('stddev_samp(v)', 4)} AS sd FROM t JOIN q USING (g) GROUP BY g""",
)
def _boxes(spark, sf):
    return _round(
        charts.box_stats(table(spark, sf, "documents"), "n_chars", "lang"), "q1", "median", "q3", "mean", "sd", digits=4
    )


@query("auto_charts")
def _auto_charts(spark, sf):
    tables = charts.auto_charts(table(spark, sf, "orders"))
    out = None
    for name, t in tables.items():
        part = t.select(F.lit(name).alias("chart"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in t.columns])).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out
