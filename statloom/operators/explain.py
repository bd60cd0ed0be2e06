"""Shapley attributions of fitted models as distributed batch scoring."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import SEED, name_col, rnd
from statloom.functions.trees import Forest
from statloom.operators.models import Fitted
from statloom.operators.preprocess import unit_hash
from statloom.session import new_folder, share_package

MOST_NODES = 1_000_000  # of an ensemble that are broadcast at once
WALKED = 2048  # nodes of small trees that are walked at once


@dataclass(frozen=True)
class Attribution:
    """Long table ``(key..., feature, shap_value, feature_value)`` and its base value."""

    values: DataFrame
    key: list[str]
    base: float
    kind: str


def _prepared(fitted: Fitted, df: DataFrame, key: list[str]) -> DataFrame:
    ready = fitted.preparation.transform(df)
    return ready.select(*[name_col(k) for k in key], vector_to_array("features").alias("x"))


def _long(df: DataFrame, key: list[str], slots: list[str], phi: Column) -> DataFrame:
    names = F.array(*[F.lit(s) for s in slots])
    zipped = df.select(*[name_col(k) for k in key], F.posexplode(F.arrays_zip(phi.alias("phi"), F.col("x").alias("x"))))
    return zipped.select(
        *[name_col(k) for k in key],
        names[F.col("pos")].alias("feature"),
        F.col("col.phi").alias("shap_value"),
        F.col("col.x").alias("feature_value"),
    )


def linear_attribution(fitted: Fitted, df: DataFrame, key: list[str]) -> Attribution:
    """Coefficient times distance from the mean; the base is the model at the mean.

    For a classifier this is on the log-odds scale of the second class (first class when
    there are more than two).
    """
    m = fitted.model
    if hasattr(m, "coefficientMatrix"):
        beta, intercept = m.coefficientMatrix.toArray()[0], float(m.interceptVector[0])
    else:
        beta, intercept = m.coefficients.toArray(), float(m.intercept)
    ready = fitted.preparation.transform(df)
    mean = ready.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    rows = _prepared(fitted, df, key)
    b, c = (F.array(*[F.lit(float(v)) for v in a]) for a in (beta, mean))
    rows = rows.withColumn("_b", b).withColumn("_c", c)
    phi = F.zip_with("_b", F.zip_with("x", "_c", lambda x, mu: x - mu), lambda w, d: w * d)
    base = intercept + float(np.dot(beta, mean))
    return Attribution(_long(rows, key, fitted.preparation.slots, phi), key, base, "linear")


def forest_nodes(fitted: Fitted) -> pa.Table:
    """``(tree, id, parent, feature, cut, left, share, value)``: the nodes of a fitted ensemble, parents first.

    They are read back from the saved node table and related to each other as columns. Their number
    depends on trees and depth, not on the data; the model itself has them on the driver already.
    """
    m = fitted.model
    spark = fitted.problem.data.sparkSession
    path = new_folder(spark, "trees")
    m.write().save(path)
    forest = "RandomForest" in type(m).__name__
    classes = fitted.problem.task == "classification" and forest
    weights = [1.0 / len(m.treeWeights)] * len(m.treeWeights) if forest else list(m.treeWeights)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if classes else F.get(stats, F.lit(0))
    output = F.when(F.size(stats) == 2, F.get(stats, F.lit(1))).otherwise(F.get(stats, F.lit(0))) / F.greatest(cover, F.lit(1e-300)) if classes else F.col("prediction")
    kinds, cuts = F.col("split.numCategories"), F.col("split.leftCategoriesOrThreshold")
    odd = nodes.where((F.col("leftChild") >= 0) & ~kinds.isin(-1, 2)).limit(1).count()
    if odd:
        raise ValueError("only numeric and 0/1 features are supported")
    flipped = (kinds == 2) & (F.size(cuts) == 1) & (F.get(cuts, F.lit(0)) == 1.0)  # of a 0/1 indicator the value 1 goes left
    facts = nodes.select(
        F.col("treeID").alias("tree"),
        "id",
        F.col("split.featureIndex").alias("feature"),
        F.when(kinds == -1, F.get(cuts, F.lit(0))).otherwise(0.5).alias("cut"),
        flipped.alias("flipped"),
        "leftChild",
        "rightChild",
        cover.alias("cover"),
        output.alias("output"),
    ).orderBy("tree", "id")
    got = facts.toArrow()
    column = lambda name: got.column(name).to_numpy()
    tree, ids = column("tree"), column("id")
    starts = np.searchsorted(tree, np.unique(tree))
    first = np.repeat(starts, np.diff(np.append(starts, len(tree))))  # ids count up from 0 in a tree, parents first
    parent, left = np.full(len(ids), -1), np.zeros(len(ids), dtype=bool)
    inner = np.flatnonzero(column("leftChild") >= 0)
    for side, lower in (("leftChild", True), ("rightChild", False)):
        child = first[inner] + column(side)[inner]
        parent[child] = inner
        left[child] = column("flipped")[inner] != lower
    cover_of = column("cover")
    share = np.where(parent >= 0, cover_of / np.maximum(cover_of[np.maximum(parent, 0)], 1e-300), 1.0)
    value = np.asarray(weights)[tree] * column("output")
    columns = {"tree": tree, "parent": parent, "feature": column("feature"), "cut": column("cut"), "left": left, "share": share, "value": value}
    return pa.table(columns)


def _forests(nodes: pa.Table, width: int, most: int) -> list[tuple]:
    """The arguments of ``Forest`` for groups of whole trees with about ``most`` nodes each."""
    tree = nodes.column("tree").to_numpy()
    starts = np.append(np.flatnonzero(np.diff(tree, prepend=-1)), len(tree))
    groups, begin = [], 0
    for end, following in zip(starts[1:].tolist(), [*starts[2:].tolist(), None]):
        if following is None or following - begin > most:
            part = nodes.slice(begin, end - begin)
            columns = {n: part.column(n).to_numpy() for n in ("parent", "feature", "cut", "left", "share", "value")}
            columns["parent"] = np.where(columns["parent"] >= 0, columns["parent"] - begin, -1)
            groups.append((*columns.values(), width))
            begin = end
    return groups


def tree_attribution(fitted: Fitted, df: DataFrame, key: list[str], most_nodes: int = MOST_NODES) -> Attribution:
    """Path-dependent attribution: probability of the second class for forests, margin
    for boosted classifiers, prediction for regressions.

    The nodes are broadcast in groups of trees with at most ``most_nodes`` nodes (one tree at least);
    every further group is one more pass over the rows, which adds to their attributions.
    """
    width = fitted.preparation.width
    groups = _forests(forest_nodes(fitted), width, most_nodes)
    rows = _prepared(fitted, df, key).withColumn("phi", F.array_repeat(F.lit(0.0), width))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:  # the walks, not the rows, are what takes long
        rows = rows.repartition(cores)
    share_package(df.sparkSession)
    base = 0.0
    for group in groups:
        base += sum(Forest(*part).base for part in _split(group))
        rows = rows.mapInArrow(_adding(df.sparkSession.sparkContext.broadcast(group), width), rows.schema)
    return Attribution(_long(rows, key, fitted.preparation.slots, F.col("phi")), key, base, "tree")


def _split(group: tuple) -> list[tuple]:
    """A group's trees in parts of about ``WALKED`` nodes, which are walked at once."""
    *columns, width = group
    heads = np.flatnonzero(columns[0] < 0)
    cuts = [0]
    for head, end in zip(heads.tolist(), [*heads[1:].tolist(), len(columns[0])]):
        if end - cuts[-1] > WALKED and head > cuts[-1]:
            cuts.append(head)
    parts = []
    for a, b in zip(cuts, [*cuts[1:], len(columns[0])]):
        own = [c[a:b] for c in columns]
        own[0] = np.where(own[0] >= 0, own[0] - a, -1)
        parts.append((*own, width))
    return parts


def _adding(shared: Broadcast, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forests = [Forest(*part) for part in _split(shared.value)]
        for batch in batches:
            at = batch.schema.get_field_index("phi")
            x, phi = (batch.column(n).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for n in ("x", "phi"))
            for forest in forests:
                phi = phi + forest.attribute(x)
            offsets = np.arange(0, (len(phi) + 1) * width, width, dtype=np.int32) if width else np.zeros(len(phi) + 1, dtype=np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(phi.ravel()))
            yield batch.set_column(at, pa.field("phi", made.type), made)

    return run


def sampling_attribution(
    fitted: Fitted, df: DataFrame, key: list[str], permutations: int = 10, background: int = 10
) -> Attribution:
    """Model-agnostic attribution by permutation sampling.

    Each row meets a few (feature order, background row) pairs; features are switched
    from the background to the row one by one and the change of the output is credited
    to the feature just switched. All hybrids are scored as one distributed batch.
    """
    slots = fitted.preparation.slots
    width = len(slots)
    rows = _prepared(fitted, df, key)
    some = rows.orderBy(unit_hash(key), *[name_col(k) for k in key]).limit(background)
    pool = [r["x"] for r in some.collect()]  # ``background`` rows
    rng = np.random.default_rng(SEED)
    plans = [(rng.permutation(width), pool[i % len(pool)]) for i in range(permutations)]
    place = F.array(*[F.array(*[F.lit(int(v)) for v in np.argsort(order)]) for order, _ in plans])
    order = F.array(*[F.array(*[F.lit(int(v)) for v in o]) for o, _ in plans])
    base = F.array(*[F.array(*[F.lit(float(v)) for v in b]) for _, b in plans])
    keys = [name_col(k) for k in key]
    steps = rows.select(*keys, "x", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("p"))
    steps = steps.select(*keys, "x", "p", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("s"))
    steps = steps.withColumns({"_pos": place[F.col("p")], "_bg": base[F.col("p")]})
    hybrid = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda j: F.when(F.element_at("_pos", j + 1) < F.col("s"), F.element_at("x", j + 1)).otherwise(F.element_at("_bg", j + 1)),
    )
    scored = fitted.model.transform(steps.withColumn("features", array_to_vector(hybrid)))
    if fitted.problem.task == "classification" and "probability" in scored.columns:
        out = vector_to_array("probability")[1 if len(fitted.problem.labels) == 2 else 0]
    else:
        out = F.col("prediction")
    # output at step s counts for the feature switched at s and against the next one
    switched = F.when(F.col("s") > 0, F.struct(order[F.col("p")][F.col("s") - 1].alias("slot"), out.alias("d")))
    following = F.when(F.col("s") < width, F.struct(order[F.col("p")][F.col("s")].alias("slot"), (-out).alias("d")))
    credits = scored.select(*keys, F.explode(F.array_compact(F.array(switched, following))).alias("c"))
    phi = credits.groupBy(*keys, "c.slot").agg((F.sum("c.d") / permutations).alias("shap_value"))
    names = F.array(*[F.lit(s) for s in slots])
    actual = rows.select(*keys, F.posexplode("x").alias("slot", "feature_value"))
    values = phi.join(actual, [*key, "slot"]).select(*keys, names[F.col("slot")].alias("feature"), "shap_value", "feature_value")
    background_scores = fitted.model.transform(
        df.sparkSession.createDataFrame([(list(map(float, b)),) for _, b in plans], "x array<double>").select(
            array_to_vector("x").alias("features")
        )
    )
    at_base = vector_to_array("probability")[1 if len(fitted.problem.labels) == 2 else 0] if "probability" in background_scores.columns else F.col("prediction")
    return Attribution(values, key, float(background_scores.agg(F.avg(at_base)).first()[0]), "sampling")


def explain(fitted: Fitted, df: DataFrame, key: list[str], max_rows: int | None = None) -> Attribution:
    """Attribution by the method that fits the model; all rows unless ``max_rows`` is set."""
    if max_rows:
        df = df.orderBy(unit_hash(key), *[name_col(k) for k in key]).limit(max_rows)
    m = fitted.model
    if hasattr(m, "coefficientMatrix") or hasattr(m, "coefficients"):
        return linear_attribution(fitted, df, key)
    if hasattr(m, "treeWeights"):
        return tree_attribution(fitted, df, key)
    return sampling_attribution(fitted, df, key)


def global_importance(values: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, strongest first."""
    return (
        values.groupBy("feature")
        .agg(rnd(F.avg(F.abs("shap_value")), 5).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


def beeswarm(values: DataFrame, top_n: int = 15) -> DataFrame:
    """Attributions of the strongest features with their values scaled to [0, 1]."""
    strong = (
        values.groupBy("feature")
        .agg(F.avg(F.abs("shap_value")).alias("m"), F.min("feature_value").alias("lo"), F.max("feature_value").alias("hi"))
        .orderBy(F.col("m").desc(), "feature")
        .limit(top_n)
    )
    scaled = (F.col("feature_value") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9)
    return values.join(F.broadcast(strong), "feature").select(  # at most top_n rows
        *[name_col(c) for c in values.columns if c != "feature_value"], scaled.alias("feature_value_norm")
    )


def waterfall(values: DataFrame, row: Column) -> DataFrame:
    """Attributions of one row, strongest first."""
    return (
        values.filter(row)
        .select("feature", rnd(F.col("shap_value"), 5).alias("shap_value"), "feature_value")
        .orderBy(F.abs("shap_value").desc(), "feature")
    )
