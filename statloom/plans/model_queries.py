"""Registered queries: preparation, models, metrics, clustering, attribution, fairness."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statloom.functions.exprs import rnd as round_to
from statloom.operators import diagnostics, explain, fairness, metrics, models, preprocess, selection, target, unsupervised
from statloom.plans.registry import f_tail, query, rnd
from statloom.sources.tables import table

LABELLED_SQL = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.toxic, l.quality, CASE WHEN d.n_chars > 400 THEN 1 ELSE 0 END AS pred
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id")


def ruled(spark, sf):
    return labelled(spark, sf).withColumn("pred", (F.col("n_chars") > 400).cast("int"))


def training_frame(spark, sf):
    return labelled(spark, sf).select("lang", "source", "n_chars", "toxic", "quality")


def _rounded(df, names, digits=6):
    return df.select(*[(round_to(F.col(c), digits).alias(c) if c in names else F.col(f"`{c}`")) for c in df.columns])


# ---- target and features ------------------------------------------------------------


def id_sql(src: str, columns: list[tuple[str, bool]]) -> str:
    parts = []
    for c, numeric in columns:
        named = c in ("id", "index", "uuid") or c.endswith("id")
        by_name = f"count(DISTINCT {c}) > 0.9 * count(*)" if named else "false"
        by_value = "false" if numeric else f"(count(*) > 10 AND count(DISTINCT {c}) >= 0.98 * count(*))"
        parts.append(
            f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique, {by_name} OR {by_value} AS looks_like_id FROM {src}"
        )
    return " UNION ALL ".join(parts)


@query(
    "identifier_columns",
    id_sql("customer", [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False)])
    + " UNION ALL "
    + id_sql("documents", [("doc_id", True), ("text", False), ("lang", False), ("source", False), ("n_chars", True)]),
)
def _ids(spark, sf):
    return target.identifier_columns(table(spark, sf, "customer")).unionByName(
        target.identifier_columns(table(spark, sf, "documents"))
    )


@query(
    "target_choice",
    "SELECT 'orders' AS dataset, 'o_orderpriority' AS target, CASE WHEN count(DISTINCT o_orderpriority) <= 20 THEN 'classification' ELSE 'regression' END AS task FROM orders"
    " UNION ALL SELECT 'lineitem', 'l_linestatus', CASE WHEN count(DISTINCT l_linestatus) <= 20 THEN 'classification' ELSE 'regression' END FROM lineitem",
)
def _target_choice(spark, sf):
    out = None
    for name in ("orders", "lineitem"):
        df = table(spark, sf, name)
        facts = target.column_facts(df)
        chosen = target.suggest_target(df, facts)
        row = df.limit(1).select(
            F.lit(name).alias("dataset"), F.lit(chosen).alias("target"), F.lit(target.detect_task(df, chosen, facts)).alias("task")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "prepared_numbers",
    f"""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice FROM part),
f AS (SELECT p_partkey, coalesce(p_size, (SELECT quantile_cont(p_size, 0.5) FROM t)) AS a, p_retailprice AS b FROM t)
SELECT p_partkey, {rnd('(a - avg(a) OVER ()) / stddev_pop(a) OVER ()', 6)} AS size_scaled,
{rnd('(b - avg(b) OVER ()) / stddev_pop(b) OVER ()', 6)} AS price_scaled FROM f""",
)
def _prepared(spark, sf):
    df = table(spark, sf, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS p_size", "p_retailprice"
    )
    prep = preprocess.fit_preparation(df, ["p_size", "p_retailprice"])
    x = vector_to_array("features")
    return prep.transform(df).select(
        "p_partkey", round_to(x[0], 6).alias("size_scaled"), round_to(x[1], 6).alias("price_scaled")
    )


def one_hot_totals(df, prep):
    """Rows per slot, from the vectors' own slots and values."""
    parts = F.unwrap_udt("features")
    sparse = F.when(parts["type"] == 0, parts["indices"]).otherwise(F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    cells = prep.transform(df).select(F.explode(F.arrays_zip(sparse.alias("slot"), parts["values"].alias("v"))).alias("c"))
    totals = cells.groupBy(F.col("c.slot").alias("slot")).agg(F.sum("c.v").alias("rows")).where("rows <> 0")
    return totals.join(prep.slot_table(), "slot").select(F.col("name").alias("slot"), "rows")


@query(
    "one_hot_totals",
    """SELECT 'p_type_' || p_type AS slot, CAST(count(*) AS DOUBLE) AS rows FROM part GROUP BY p_type
UNION ALL SELECT 'p_brand_' || p_brand, CAST(count(*) AS DOUBLE) FROM part GROUP BY p_brand""",
)
def _one_hot(spark, sf):
    df = table(spark, sf, "part")
    return one_hot_totals(df, preprocess.fit_preparation(df, ["p_type", "p_brand"]))


@query(
    "one_hot_totals_many_levels",
    """WITH o AS (SELECT 'k' || (o_orderkey // 2) AS pair, o_orderpriority FROM orders)
SELECT 'pair_' || pair AS slot, CAST(count(*) AS DOUBLE) AS rows FROM o GROUP BY pair
UNION ALL SELECT 'o_orderpriority_' || o_orderpriority, CAST(count(*) AS DOUBLE) FROM o GROUP BY o_orderpriority""",
)
def _one_hot_many(spark, sf):
    """A text column of which half the values are distinct: its levels never reach the driver."""
    df = table(spark, sf, "orders").selectExpr("concat('k', o_orderkey div 2) AS pair", "o_orderpriority")
    return one_hot_totals(df, preprocess.fit_preparation(df, ["pair", "o_orderpriority"]))


def parts_sql(src: str, by: str, cuts: list[str], part: str) -> str:
    """Rows per class and part when every class of n rows is cut after round(n * share) rows."""
    ends = [f"CAST(floor(n * {c} + 0.5) AS BIGINT)" for c in cuts]
    sizes = [f"{hi} - {lo}" for lo, hi in zip(["0", *ends], [*ends, "n"])]
    rows = " UNION ALL ".join(f"SELECT {by}, {part.format(i)} AS part, CAST({s} AS BIGINT) AS rows FROM c" for i, s in enumerate(sizes))
    return f"WITH c AS (SELECT {by}, count(*) AS n FROM {src} GROUP BY {by}) SELECT * FROM ({rows}) WHERE rows > 0"


@query("stratified_split", parts_sql("orders", "o_orderstatus", ["0.2"], "CASE {} WHEN 0 THEN 'test' ELSE 'train' END"))
def _split(spark, sf):
    df = table(spark, sf, "orders")
    train, test = preprocess.split(df, "o_orderstatus", key=["o_orderkey"])
    a = train.groupBy("o_orderstatus").agg(F.count("*").alias("rows")).withColumn("part", F.lit("train"))
    return a.unionByName(test.groupBy("o_orderstatus").agg(F.count("*").alias("rows")).withColumn("part", F.lit("test")))


@query("stratified_folds", parts_sql("orders", "o_orderstatus", ["0.2", "0.4", "0.6", "0.8"], "{}").replace("AS part", "AS fold"))
def _folds(spark, sf):
    df = preprocess.with_folds(table(spark, sf, "orders"), 5, "o_orderstatus", key=["o_orderkey"])
    return df.groupBy("o_orderstatus", "fold").agg(F.count("*").alias("rows"))


# rows that repeat, and a class that is NULL
REPEATED = "(SELECT l_linestatus, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS flag FROM lineitem)"


@query("stratified_folds_repeated_rows", parts_sql(REPEATED, "flag", ["0.2", "0.4", "0.6", "0.8"], "{}").replace("AS part", "AS fold"))
def _folds_repeated(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_linestatus", "if(l_returnflag = 'A', null, l_returnflag) as flag")
    return preprocess.with_folds(df, 5, "flag").groupBy("flag", "fold").agg(F.count("*").alias("rows"))


@query(
    "training_sample",
    """WITH c AS (SELECT l_returnflag, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM lineitem GROUP BY 1)
SELECT l_returnflag, CASE WHEN total <= 15000 THEN n ELSE CAST(floor(n * (15000.0 / total) + 0.5) AS BIGINT) END AS rows FROM c""",
)
def _sample(spark, sf):
    df = table(spark, sf, "lineitem")
    sample = preprocess.training_sample(df, 15_000, "l_returnflag")
    return sample.groupBy("l_returnflag").agg(F.count("*").alias("rows"))


@query(
    "balanced_class_weights",
    f"""WITH c AS (SELECT CAST(quality AS VARCHAR) AS class, count(*) AS n FROM labels GROUP BY quality), t AS (SELECT sum(n) AS n, count(*) AS k FROM c)
SELECT class, {rnd('t.n / (t.k * c.n)', 6)} AS weight FROM c, t WHERE (SELECT max(n) * 1.0 / min(n) FROM c) >= 1.5""",
)
def _weights(spark, sf):
    df = table(spark, sf, "labels")
    _, weights = preprocess.class_weights(df, "quality")
    classes = df.groupBy(F.col("quality").cast("string").alias("class")).count()
    return classes.select("class", round_to(preprocess.literal_map(weights, F.col("class")), 6).alias("weight"))


def f_sql(src: str, y: str, numbers: list[str], levels: list[str]) -> str:
    """ANOVA F of numbers and 0/1 level indicators, best level per feature."""
    values = [f"SELECT '{c}' AS feature, '{c}' AS slot, CAST({c} AS DOUBLE) AS v, {y} AS y FROM {src}" for c in numbers]
    values += [
        f"SELECT '{c}' AS feature, l.x AS slot, CASE WHEN s.{c} = l.x THEN 1.0 ELSE 0.0 END AS v, {y} AS y FROM {src} s CROSS JOIN (SELECT DISTINCT {c} AS x FROM {src}) l"
        for c in levels
    ]
    return f"""
WITH v AS ({' UNION ALL '.join(values)}),
g AS (SELECT feature, slot, y, count(*) AS n, avg(v) AS m, coalesce(var_samp(v), 0) AS var FROM v GROUP BY feature, slot, y),
o AS (SELECT feature, slot, sum(n * m) / sum(n) AS grand, sum(n) AS total, count(*) AS k FROM g GROUP BY feature, slot),
f AS (SELECT g.feature, g.slot, (sum(n * (m - grand) * (m - grand)) / (any_value(k) - 1)) / nullif(sum((n - 1) * var) / any_value(total - k), 0) AS f,
      any_value(k) - 1.0 AS d1, any_value(total - k) AS d2 FROM g JOIN o ON g.feature = o.feature AND g.slot = o.slot GROUP BY g.feature, g.slot),
p AS (SELECT *, {f_tail('f', 'd1', 'd2')} AS p FROM f)
SELECT feature, {rnd('max(f)', 3)} AS f_score, {rnd('min(p)', 5)} AS f_pvalue FROM p GROUP BY feature"""


@query("univariate_f_classes", f_sql(LABELLED_SQL, "quality", ["n_chars", "toxic"], ["lang", "source"]))
def _f_classes(spark, sf):
    scores = selection.f_scores(models.frame_problem(training_frame(spark, sf), "quality"))
    return scores.groupBy("feature").agg(
        round_to(F.max("f_score"), 3).alias("f_score"), round_to(F.min("f_pvalue"), 5).alias("f_pvalue")
    )


def f_regression_sql(src: str, y: str, numbers: list[str], levels: list[str]) -> str:
    parts = [f"SELECT '{c}' AS feature, '{c}' AS slot, corr({c}, {y}) AS r, count(*) AS n FROM {src}" for c in numbers]
    parts += [
        f"SELECT '{c}' AS feature, l.x AS slot, corr(CASE WHEN s.{c} = l.x THEN 1.0 ELSE 0.0 END, {y}) AS r, count(*) AS n FROM {src} s CROSS JOIN (SELECT DISTINCT {c} AS x FROM {src}) l GROUP BY l.x"
        for c in levels
    ]
    return f"""WITH r AS ({' UNION ALL '.join(parts)}), f AS (SELECT feature, r * r * (n - 2) / (1 - r * r) AS f, n - 2.0 AS d2 FROM r)
SELECT feature, {rnd('max(f)', 3)} AS f_score, {rnd(f"min({f_tail('f', '1.0', 'd2')})", 5)} AS f_pvalue FROM f GROUP BY feature"""


@query("univariate_f_regression", f_regression_sql("part", "p_retailprice", ["p_size"], ["p_brand", "p_type"]))
def _f_regression(spark, sf):
    df = table(spark, sf, "part").select("p_size", "p_brand", "p_type", "p_retailprice")
    scores = selection.f_scores(models.frame_problem(df, "p_retailprice"))
    return scores.groupBy("feature").agg(
        round_to(F.max("f_score"), 3).alias("f_score"), round_to(F.min("f_pvalue"), 5).alias("f_pvalue")
    )


@query("feature_ranking")
def _ranking(spark, sf):
    return selection.feature_ranking(training_frame(spark, sf).drop("source"), "quality")


def _facts_row(spark, facts: dict):
    return spark.createDataFrame([(k, str(v)) for k, v in facts.items()], "fact string, value string")


@query("selection_impact")
def _impact(spark, sf):
    return _facts_row(spark, selection.selection_impact(training_frame(spark, sf).drop("source"), "quality"))


@query("engineered_interaction")
def _engineered(spark, sf):
    return _facts_row(spark, selection.engineered_interaction(training_frame(spark, sf).drop("source"), "quality"))


# ---- models --------------------------------------------------------------------------------


@query("leaderboard_classification")
def _leaderboard(spark, sf):
    return models.train_and_evaluate(training_frame(spark, sf), "quality").leaderboard


@query("leaderboard_regression")
def _leaderboard_regression(spark, sf):
    df = table(spark, sf, "part").select("p_size", "p_brand", "p_type", "p_partkey", "p_retailprice")
    return models.train_and_evaluate(df, "p_retailprice").leaderboard


@query("gradient_boosting_predictions")
def _boosting(spark, sf):
    return diagnostics.prediction_table(training_frame(spark, sf), "quality", "Gradient Boosting")


@query("feature_importance")
def _importance(spark, sf):
    problem = models.frame_problem(training_frame(spark, sf), "quality")
    return models.feature_importance(models.fit_model(problem, problem.data, "Random Forest"))


@query("permutation_importance")
def _permutation(spark, sf):
    problem = models.frame_problem(training_frame(spark, sf), "quality")
    train, test = preprocess.split(problem.data, "quality")
    return models.permutation_importance(models.fit_model(problem, train, "Logistic Regression"), test)


@query("roc_pr_curves")
def _curves(spark, sf):
    return diagnostics.roc_pr_curves(training_frame(spark, sf), "quality", "Logistic Regression")[0]


@query("hyperparameter_search")
def _tune(spark, sf):
    found = diagnostics.tune(training_frame(spark, sf).drop("source"), "quality", "Logistic Regression")
    return _facts_row(spark, found)


@query("learning_curve")
def _learning(spark, sf):
    df = training_frame(spark, sf).drop("source")
    return diagnostics.learning_curve(df, "quality", "Logistic Regression")


LINEAR_FIT = "SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem"


@query(
    "linear_regression_fit",
    f"""WITH f AS ({LINEAR_FIT}), e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS e FROM lineitem, f)
SELECT {rnd('1 - sum(e * e) / (var_pop(y) * count(*))', 6)} AS r2, {rnd('sqrt(avg(e * e))', 4)} AS rmse, {rnd('avg(abs(e))', 4)} AS mae FROM e""",
)
def _linear_fit(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    problem = models.frame_problem(df, "l_extendedprice")
    predicted = models.fit_model(problem, problem.data, "Linear Regression").predict(problem.data)
    m = metrics.regression_metrics(predicted, "l_extendedprice", "prediction", 9)
    return m.select(round_to(F.col("r2"), 6).alias("r2"), round_to(F.col("rmse"), 4).alias("rmse"), round_to(F.col("mae"), 4).alias("mae"))


# ---- metrics on rule-based predictions --------------------------------------------------------

CONFUSION = f"SELECT CAST(quality AS VARCHAR) AS label, CAST(pred AS VARCHAR) AS prediction, count(*) AS count FROM {LABELLED_SQL} GROUP BY 1, 2"


@query("confusion_counts", CONFUSION)
def _confusion(spark, sf):
    return metrics.confusion_counts(ruled(spark, sf), "quality", "pred")


@query(
    "confusion_matrix",
    f"""SELECT label, CAST(coalesce(sum(count) FILTER (prediction = '0'), 0) AS BIGINT) AS "0",
CAST(coalesce(sum(count) FILTER (prediction = '1'), 0) AS BIGINT) AS "1" FROM ({CONFUSION}) GROUP BY label""",
)
def _matrix(spark, sf):
    return metrics.confusion_matrix(ruled(spark, sf), "quality", "pred", ["0", "1"])


def metrics_sql(cells: str) -> str:
    return f"""
WITH c AS ({cells}),
k AS (SELECT DISTINCT label AS k FROM c UNION SELECT DISTINCT prediction FROM c),
m AS (SELECT k, (SELECT coalesce(sum(count), 0) FROM c WHERE label = k) * 1.0 AS t, (SELECT coalesce(sum(count), 0) FROM c WHERE prediction = k) * 1.0 AS p,
      (SELECT coalesce(sum(count), 0) FROM c WHERE label = k AND prediction = k) * 1.0 AS tp FROM k),
r AS (SELECT *, coalesce(tp / nullif(p, 0), 0) AS pr, coalesce(tp / nullif(t, 0), 0) AS re FROM m),
s AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f FROM r)
SELECT {rnd('sum(tp) / sum(t)', 4)} AS accuracy, {rnd('sum(pr * t) / sum(t)', 4)} AS precision, {rnd('sum(re * t) / sum(t)', 4)} AS recall,
{rnd('sum(f * t) / sum(t)', 4)} AS f1, {rnd('sum(f * t) / sum(t)', 4)} AS f1_weighted,
{rnd('coalesce((sum(tp) * sum(t) - sum(p * t)) / nullif(sqrt((sum(t) * sum(t) - sum(p * p)) * (sum(t) * sum(t) - sum(t * t))), 0), 0)', 4)} AS mcc FROM s"""


@query("classification_metrics", metrics_sql(CONFUSION))
def _metrics(spark, sf):
    return metrics.classification_metrics(ruled(spark, sf), "quality", "pred")


MULTI = "SELECT o_orderstatus AS label, CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 150000 THEN 'O' ELSE 'P' END AS prediction, count(*) AS count FROM orders GROUP BY 1, 2"


@query("classification_metrics_three_classes", metrics_sql(MULTI))
def _metrics3(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "pred", F.expr("CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 150000 THEN 'O' ELSE 'P' END")
    )
    return metrics.classification_metrics(df, "o_orderstatus", "pred")


SCORES = f"""s AS (SELECT n_chars AS score, sum(quality) AS pos, sum(1 - quality) AS neg FROM {LABELLED_SQL} GROUP BY 1),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s),
c AS (SELECT score, pos, neg, P, N, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
      sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM s, t)"""


@query(
    "ranking_metrics",
    f"""WITH {SCORES} SELECT {rnd('sum(pos * (below + neg / 2.0)) / (any_value(P) * any_value(N))', 6)} AS roc_auc,
{rnd('sum(pos * (tp * 1.0 / (tp + fp))) / any_value(P)', 6)} AS pr_auc, CAST(any_value(P) AS DOUBLE) AS support FROM c""",
)
def _ranking_metrics(spark, sf):
    m = metrics.ranking_metrics(labelled(spark, sf), F.col("quality") == 1, F.col("n_chars"))
    return _rounded(m, ["roc_auc", "pr_auc"])


@query(
    "roc_pr_points",
    f"""WITH {SCORES} SELECT CAST(score AS DOUBLE) AS threshold, {rnd('fp * 1.0 / N', 6)} AS fpr, {rnd('tp * 1.0 / P', 6)} AS tpr,
{rnd('tp * 1.0 / (tp + fp)', 6)} AS precision, {rnd('tp * 1.0 / P', 6)} AS recall FROM c
UNION ALL SELECT CAST(-1 AS DOUBLE), 0.0, 0.0, 1.0, 0.0""",
)
def _points(spark, sf):
    points = metrics.curve_points(labelled(spark, sf), F.col("quality") == 1, F.col("n_chars"))
    shown = F.when(F.col("threshold") == float("inf"), -1.0).otherwise(F.col("threshold"))
    return _rounded(points.withColumn("threshold", shown), ["fpr", "tpr", "precision", "recall"])


@query(
    "regression_metrics",
    f"""WITH t AS (SELECT l_extendedprice AS y, 1500 * l_quantity AS p FROM lineitem)
SELECT {rnd('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS r2, {rnd('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse,
{rnd('avg(abs(y - p))', 4)} AS mae, {rnd('avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16))', 4)} AS mape FROM t""",
)
def _regression_metrics(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice", (1500 * F.col("l_quantity")).alias("p"))
    return metrics.regression_metrics(df, "l_extendedprice", "p")


# ---- unsupervised ----------------------------------------------------------------------------------


@query(
    "principal_components_two_columns",
    f"""WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
SELECT 'PC1' AS component, {rnd('(1 + r) / 2', 4)} AS explained_variance, {rnd('(1 + r) / 2', 4)} AS cumulative FROM r
UNION ALL SELECT 'PC2', {rnd('(1 - r) / 2', 4)}, {rnd('(1 + r) / 2 + (1 - r) / 2', 4)} FROM r""",
)
def _pca2(spark, sf):
    df = table(spark, sf, "lineitem")
    return unsupervised.run_pca(df, names=["l_quantity", "l_extendedprice"]).variance


@query("principal_components_embeddings")
def _pca_embeddings(spark, sf):
    df = table(spark, sf, "embeddings")
    width = df.select(F.max(F.size("embedding"))).first()[0]
    wide = unsupervised.embedding_columns(df, "embedding", width)
    return unsupervised.run_pca(wide, names=[f"e{i}" for i in range(width)]).variance


@query(
    "pca_projection",
    f"""WITH s AS (SELECT p_partkey, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS a,
(p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS b FROM part)
SELECT p_partkey, {rnd('pow(a, 2) + pow(b, 2)', 4)} AS squared_length FROM s""",
)
def _projection(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = unsupervised.run_pca(df, names=["p_size", "p_retailprice"]).projection
    return out.select("p_partkey", round_to(F.col("PC1") ** 2 + F.col("PC2") ** 2, 4).alias("squared_length"))


@query("kmeans_selection")
def _kmeans(spark, sf):
    df = table(spark, sf, "part").select("p_size", "p_retailprice")
    return unsupervised.run_clustering(df).selection


@query("kmeans_order", "SELECT CAST(k AS INTEGER) AS k, TRUE AS closer_than_before, TRUE AS silhouette_in_range FROM range(2, 9) r(k)")
def _kmeans_order(spark, sf):
    """What must hold for every k: points get closer to their centres, the silhouette is one."""
    df = table(spark, sf, "part").select("p_size", "p_retailprice")
    rows = unsupervised.run_clustering(df, starts=3).selection.collect()  # a row per k
    flags = [(r.k, i == 0 or r.inertia < rows[i - 1].inertia, -1 <= r.silhouette <= 1) for i, r in enumerate(rows)]
    return spark.createDataFrame(flags, "k int, closer_than_before boolean, silhouette_in_range boolean")


@query(
    "cluster_profiles",
    f"SELECT CAST(p_size // 10 AS BIGINT) AS cluster, count(*) AS size, {rnd('avg(p_size)', 2)} AS p_size, {rnd('avg(p_retailprice)', 2)} AS p_retailprice FROM part GROUP BY 1",
)
def _profiles(spark, sf):
    df = table(spark, sf, "part").withColumn("cluster", F.expr("p_size div 10"))
    return unsupervised.cluster_profiles(df, ["p_size", "p_retailprice"])


# ---- attribution ---------------------------------------------------------------------------------------


@query(
    "attribution_linear",
    f"""WITH f AS ({LINEAR_FIT}), m AS (SELECT avg(l_quantity) AS m FROM lineitem)
SELECT 'l_quantity' AS feature, {rnd('avg(abs(b * (l_quantity - m)))', 3)} AS mean_abs_shap FROM lineitem, f, m""",
)
def _attribution_linear(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    problem = models.frame_problem(df.select("l_quantity", "l_extendedprice"), "l_extendedprice")
    fitted = models.fit_model(problem, problem.data, "Linear Regression")
    found = explain.global_importance(explain.explain(fitted, df, ["l_orderkey"]).values)
    return _rounded(found, ["mean_abs_shap"], 3)


def _tree_model(spark, sf):
    df = labelled(spark, sf)
    problem = models.frame_problem(df, "quality")
    return df, models.fit_model(problem, problem.data, "Random Forest")


@query("attribution_forest")
def _attribution_forest(spark, sf):
    df, fitted = _tree_model(spark, sf)
    return explain.global_importance(explain.explain(fitted, df, ["doc_id"]).values)


def _sums(fitted, found, df):
    """Rows, and whether base value and attributions add up to the model's output in all of them."""
    total = found.values.groupBy("doc_id").agg(F.sum("shap_value").alias("s"))
    output = fitted.predict(df).select("doc_id", vector_to_array("scores")[1].alias("p"))
    off = F.max(F.abs(F.col("s") + F.lit(float(found.base)) - F.col("p")))
    return total.join(output, "doc_id").agg(F.count("*").alias("rows"), (off < 1e-6).alias("adds_up"))


LABELLED_ROWS = "SELECT count(*) AS rows, TRUE AS adds_up FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL"


@query("attribution_forest_sums", LABELLED_ROWS)
def _forest_sums(spark, sf):
    df, fitted = _tree_model(spark, sf)
    return _sums(fitted, explain.explain(fitted, df, ["doc_id"]), df)


@query("attribution_sampling_sums", LABELLED_ROWS)
def _sampling_sums(spark, sf):
    df = labelled(spark, sf).drop("source")
    problem = models.frame_problem(df, "quality")
    fitted = models.fit_model(problem, problem.data, "Logistic Regression")
    return _sums(fitted, explain.sampling_attribution(fitted, df, ["doc_id"]), df)


@query("attribution_beeswarm")
def _beeswarm(spark, sf):
    df = labelled(spark, sf)
    problem = models.frame_problem(df, "quality")
    fitted = models.fit_model(problem, problem.data, "Logistic Regression")
    return explain.beeswarm(explain.explain(fitted, df, ["doc_id"]).values)


@query("attribution_waterfall")
def _waterfall(spark, sf):
    df = labelled(spark, sf)
    problem = models.frame_problem(df, "quality")
    fitted = models.fit_model(problem, problem.data, "Logistic Regression")
    first = df.agg(F.min("doc_id")).first()[0]
    return explain.waterfall(explain.explain(fitted, df, ["doc_id"]).values, F.col("doc_id") == first)


@query("attribution_sampling")
def _attribution_sampling(spark, sf):
    df = labelled(spark, sf).drop("source")
    problem = models.frame_problem(df, "quality")
    fitted = models.fit_model(problem, problem.data, "Logistic Regression")
    return explain.global_importance(explain.sampling_attribution(fitted, df, ["doc_id"]).values)


# ---- fairness ---------------------------------------------------------------------------------------------


@query(
    "class_imbalance",
    f"""WITH c AS (SELECT CAST(quality AS VARCHAR) AS y, count(*) AS n FROM labels GROUP BY quality),
a AS (SELECT count(*) AS k, arg_min(y, -n) AS maj, arg_max(y, -n) AS mi, max(n) AS hi, min(n) AS lo FROM c)
SELECT k AS n_classes, maj AS majority_class, mi AS minority_class, hi AS majority_count, lo AS minority_count,
{rnd('hi * 1.0 / lo', 2)} AS imbalance_ratio, CASE WHEN hi * 1.0 / lo < 1.5 THEN 'balanced' WHEN hi * 1.0 / lo < 3 THEN 'moderate' ELSE 'severe' END AS severity,
hi * 1.0 / lo < 1.5 AS balanced FROM a""",
)
def _imbalance(spark, sf):
    return fairness.class_imbalance_report(table(spark, sf, "labels"), "quality")


GROUP_METRICS = f"""
WITH c AS (SELECT lang AS g, count(*) AS n, count(*) FILTER (pred = 1) AS sel, count(*) FILTER (pred = quality) AS ok,
count(*) FILTER (pred = 1 AND quality = 1) AS tp, count(*) FILTER (pred = 0 AND quality = 1) AS fn,
count(*) FILTER (pred = 1 AND quality = 0) AS fp, count(*) FILTER (pred = 0 AND quality = 0) AS tn FROM {LABELLED_SQL} GROUP BY lang),
o AS (SELECT sum(sel) * 1.0 / sum(n) AS r FROM c),
g AS (SELECT g AS "group", n, {rnd('sel * 1.0 / n', 4)} AS selection_rate, {rnd('ok * 1.0 / n', 4)} AS accuracy,
CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {rnd('tp * 1.0 / (tp + fn)', 4)} END AS tpr_recall,
CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {rnd('fp * 1.0 / (fp + tn)', 4)} END AS fpr,
CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {rnd('coalesce(tp * 1.0 / nullif(tp + fp, 0), 0)', 4)} END AS precision,
CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {rnd('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)', 4)} END AS f1,
{rnd('(sel * 1.0 / n) / r', 4)} AS disparate_impact FROM c, o WHERE n >= 5)"""


@query("fairness_group_metrics", GROUP_METRICS + " SELECT * FROM g")
def _group_metrics(spark, sf):
    return fairness.group_metrics(ruled(spark, sf), "quality", "pred", "lang")


VERDICTS = (
    GROUP_METRICS
    + f""", v AS (
SELECT 'demographic_parity' AS criterion, 'Selection rate gap' AS metric, {rnd('max(selection_rate) - min(selection_rate)', 4)} AS value, 0.1 AS threshold,
{rnd('max(selection_rate) - min(selection_rate)', 9)} <= 0.1 AS pass FROM g
UNION ALL SELECT 'disparate_impact', 'Disparate impact (minimum)', {rnd('min(disparate_impact)', 4)}, 0.8, min(disparate_impact) >= 0.8 FROM g
UNION ALL SELECT 'equal_opportunity', 'True positive rate gap', {rnd('max(tpr_recall) - min(tpr_recall)', 4)}, 0.1, {rnd('max(tpr_recall) - min(tpr_recall)', 9)} <= 0.1 FROM g
UNION ALL SELECT 'predictive_parity', 'Precision gap', {rnd('max(precision) - min(precision)', 4)}, 0.1, {rnd('max(precision) - min(precision)', 9)} <= 0.1 FROM g)"""
)


@query("fairness_verdicts", VERDICTS + " SELECT criterion, metric, value, CAST(threshold AS DOUBLE) AS threshold, pass FROM v")
def _verdicts(spark, sf):
    return fairness.fairness_verdict(fairness.group_metrics(ruled(spark, sf), "quality", "pred", "lang"))


@query(
    "fairness_analysis",
    VERDICTS + " SELECT CAST(count(*) FILTER (pass) AS BIGINT) AS n_criteria_pass, count(*) AS n_criteria_total, bool_and(pass) AS overall_pass FROM v",
)
def _fairness(spark, sf):
    report = fairness.run_fairness_analysis(
        table(spark, sf, "documents").select("doc_id", "lang"),
        ruled(spark, sf).select("doc_id", "quality", "pred"),
        ["doc_id"],
        "quality",
        "pred",
        sensitive="lang",
    )
    return report.summary
