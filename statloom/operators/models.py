"""Training, cross-validation, leaderboard and importances on Spark MLlib."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.exprs import SEED, name_col, rnd, with_scalars
from statloom.functions.prefix import sequence_numbers
from statloom.operators import metrics
from statloom.operators.preprocess import (
    Preparation,
    class_weights,
    fit_preparation,
    literal_map,
    split,
    training_sample,
    unit_hash,
    with_folds,
)
from statloom.operators.target import column_facts, detect_task, looks_like_id, with_known_target
from statloom.session import settle

MIN_ROWS = 20
PARALLEL_FITS = 6
ROWS_PER_TASK = 100_000
MAX_CLASSES = 1000

# Candidate models in the order they are tried, and their settings.
CLASSIFIERS = ["Logistic Regression", "Random Forest", "Gradient Boosting"]
REGRESSORS = ["Linear Regression", "Random Forest", "Gradient Boosting"]
DEFAULTS: dict[str, dict[str, Any]] = {
    "Logistic Regression": {"C": 1.0},
    "Linear Regression": {},
    "Random Forest": {"trees": 100, "depth": 10},
    "Gradient Boosting": {"trees": 100, "depth": 4, "rate": 0.1},
}


@dataclass(frozen=True)
class Problem:
    """A table made ready for training: known target, usable features, task."""

    data: DataFrame
    target: str
    features: list[str]
    dropped: list[str]
    task: str
    labels: list[str] = field(default_factory=list)
    rows: int = 0


@dataclass(frozen=True)
class Fitted:
    name: str
    problem: Problem
    preparation: Preparation
    model: Model

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (label text or number) and, for classes, ``scores``."""
        out = self.model.transform(self.preparation.transform(df))
        drop = [c for c in ("rawPrediction", "probability") if c in out.columns]
        if self.problem.task == "regression":
            return out.drop(*drop)
        scores = "probability" if "probability" in out.columns else "rawPrediction"
        labels = F.array(*[F.lit(x) for x in self.problem.labels])
        out = out.withColumn("scores", F.col(scores)) if scores in out.columns else out
        return out.withColumn("prediction", labels[F.col("prediction").cast("int")]).drop(*drop)


def class_labels(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> list[str]:
    """Class labels as text, in the natural order of the target's type.

    Every class is a model output and a literal of the plan, so more than ``max_classes`` are refused.
    """
    rows = df.select(name_col(target).alias("y")).distinct().orderBy("y").limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"target '{target}' has more than {max_classes} classes")
    return [r["y"] if isinstance(r["y"], str) else str(r["y"]).lower() if isinstance(r["y"], bool) else str(r["y"]) for r in rows]


def frame_problem(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> Problem:
    """Rows with a known target, identifiers set aside, task and classes determined."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    data = with_known_target(df, target)
    facts = column_facts(data)
    if facts.rows < MIN_ROWS:
        raise ValueError(f"not enough rows with a known target (need >= {MIN_ROWS})")
    usable = [f.name for f in data.schema.fields if isinstance(f.dataType, T.AtomicType)]
    dropped = [c for c in usable if c != target and looks_like_id(data, c, facts)]
    features = [c for c in usable if c != target and c not in dropped]
    if not features:
        raise ValueError("no usable feature columns after removing identifiers")
    task = detect_task(data, target, facts)
    labels = class_labels(data, target, max_classes) if task == "classification" else []
    return Problem(data, target, features, dropped, task, labels, facts.rows)


def _labelled(problem: Problem, df: DataFrame, weights: dict[str, float]) -> DataFrame:
    y = name_col(problem.target)
    if problem.task == "regression":
        return df.withColumn("_label", y.cast("double"))
    index = {k: float(i) for i, k in enumerate(problem.labels)}
    out = df.withColumn("_label", literal_map(index, y.cast("string")))
    return out.withColumn("_weight", literal_map(weights, y.cast("string")) if weights else F.lit(1.0))


def make_estimator(name: str, task: str, classes: int, settings: dict[str, Any], weight_sum: float):
    s = {**DEFAULTS[name], **settings}
    common = {"featuresCol": "features", "labelCol": "_label"}
    if name == "Logistic Regression":
        # the penalty is stated against the summed loss, MLlib minimises the mean loss
        return LogisticRegression(
            maxIter=1000,
            regParam=1.0 / (s["C"] * max(weight_sum, 1.0)),
            standardization=False,
            weightCol="_weight",
            **common,
        )
    if name == "Linear Regression":
        return LinearRegression(regParam=0.0, solver="normal", **common)
    if name == "Random Forest":
        depth = 30 if s["depth"] is None else s["depth"]  # 30 is the deepest MLlib grows
        if task == "classification":
            return RandomForestClassifier(numTrees=s["trees"], maxDepth=depth, seed=SEED, weightCol="_weight", **common)
        return RandomForestRegressor(numTrees=s["trees"], maxDepth=depth, seed=SEED, **common)
    if name == "Gradient Boosting":
        boost = {"maxIter": s["trees"], "maxDepth": s["depth"], "stepSize": s["rate"], "seed": SEED, **common}
        if task == "regression":
            return GBTRegressor(**boost)
        booster = GBTClassifier(**boost)
        return booster if classes == 2 else OneVsRest(classifier=booster, **common)
    raise ValueError(f"unknown model '{name}'")


def side_by_side(rows: int, parallelism: int = PARALLEL_FITS) -> int:
    """Fits at a time: one whose rows fill many tasks leaves no cores, and would push the others' cached rows to disk."""
    return max(1, parallelism // (rows // ROWS_PER_TASK + 1))


def _dealt(ready: DataFrame, name: str, rows: int) -> DataFrame:
    """The training rows, in as many equal partitions as ``rows`` ask for.

    Splits and folds leave up to a million rows in one partition and may leave others empty: a tree's levels would be
    counted by one task. Of few rows the scheduling is what costs: boosting runs four jobs a tree and regressions one
    a step, each through the whole lineage. A forest needs a job per level only, and draws its bootstrap per
    partition: its few rows stay as they are.
    """
    parts = rows // ROWS_PER_TASK + 1
    if parts == 1 and name == "Random Forest":
        return ready
    if name in ("Random Forest", "Gradient Boosting"):
        ready = settle(ready.repartition(parts) if parts > 1 else ready.coalesce(1), "training")
    return ready.coalesce(parts)


def fit_model(
    problem: Problem,
    train: DataFrame,
    name: str,
    preparation: Preparation | None = None,
    settings: dict[str, Any] | None = None,
    weights: dict[str, float] | None = None,
    features: list[str] | None = None,
) -> Fitted:
    """Fit one model; the preparation is fitted on the same training rows only."""
    preparation = preparation or fit_preparation(train, features or problem.features)
    ready = _labelled(problem, preparation.transform(train), weights or {})
    keep = ["features", "_label"] + (["_weight"] if problem.task == "classification" else [])
    ready = ready.select(*keep).persist()
    try:
        rows, total = ready.agg(F.count("*"), F.sum("_weight") if "_weight" in keep else F.count("*")).first()
        estimator = make_estimator(name, problem.task, len(problem.labels), settings or {}, float(total or 1.0))
        return Fitted(name, problem, preparation, estimator.fit(_dealt(ready, name, rows)))
    finally:
        ready.unpersist()


def score(problem: Problem, predicted: DataFrame) -> float | None:
    """Headline score of predictions: weighted F1 or R squared."""
    if problem.task == "classification":
        return _weighted_f1(metrics.confusion_counts(predicted, problem.target, "prediction").collect())
    return metrics.regression_metrics(predicted, problem.target, "prediction", 12).first()["r2"]


def _weighted_f1(cells: list) -> float:
    """Weighted F1 from the confusion counts (a row per pair of classes)."""
    true: dict[str, int] = {}
    guessed: dict[str, int] = {}
    hits: dict[str, int] = {}
    for r in cells:
        true[r["label"]] = true.get(r["label"], 0) + r["count"]
        guessed[r["prediction"]] = guessed.get(r["prediction"], 0) + r["count"]
        if r["label"] == r["prediction"]:
            hits[r["label"]] = r["count"]
    total = sum(true.values())
    return sum(t * 2 * hits.get(k, 0) / (t + guessed.get(k, 0)) for k, t in true.items()) / total if total else 0.0


def fold_count(problem: Problem, train: DataFrame, wanted: int = 5) -> int:
    if problem.task == "regression":
        return max(2, wanted)
    smallest = train.groupBy(name_col(problem.target)).agg(F.count("*").alias("n")).agg(F.min("n").alias("n")).first()["n"]
    return max(2, min(wanted, smallest or 0))


def cross_validate(
    problem: Problem,
    train: DataFrame,
    candidates: list[tuple[str, dict[str, Any]]],
    folds: int = 5,
    weights: dict[str, float] | None = None,
    features: list[str] | None = None,
    train_scores: bool = False,
    parallelism: int = PARALLEL_FITS,
) -> dict[int, list[tuple[float, float | None]]]:
    """Per candidate the (held-out, training) scores of every fold.

    A fold's preparation is fitted once, on its training part, and shared by all candidates. Fits
    don't depend on each other, so ``parallelism`` of them are submitted at a time, fewer where rows are many.
    """
    by = problem.target if problem.task == "classification" else None
    tagged = with_folds(train, folds, by).persist()

    def prepare(k: int) -> Preparation:
        return fit_preparation(tagged.filter(F.col("fold") != k), features or problem.features)

    def trial(job: tuple[int, int]) -> tuple[float, float | None]:
        k, i = job
        inside, held = tagged.filter(F.col("fold") != k), tagged.filter(F.col("fold") == k)
        fitted = fit_model(problem, inside, candidates[i][0], preparations[k], candidates[i][1], weights)
        own = score(problem, fitted.predict(inside)) if train_scores else None
        return score(problem, fitted.predict(held)), own

    # the boosters take longest: they start first
    jobs = sorted(((k, i) for k in range(folds) for i in range(len(candidates))), key=lambda job: candidates[job[1]][0] != "Gradient Boosting")
    inherit = inheritable_thread_target(train.sparkSession)
    try:
        with ThreadPool(max(1, min(parallelism, folds))) as pool:
            preparations = pool.map(inherit(prepare), range(folds))
        with ThreadPool(max(1, min(side_by_side(preparations[0].rows, parallelism), len(jobs)))) as pool:
            scores = pool.map(inherit(trial), jobs, chunksize=1)
    finally:
        tagged.unpersist()
    return {i: [s for (_, j), s in zip(jobs, scores) if j == i] for i in range(len(candidates))}


def _mean(values: list[float | None]) -> float | None:
    kept = [v for v in values if v is not None and not math.isnan(v)]
    return sum(kept) / len(kept) if kept else None


def _spread(values: list[float | None]) -> float | None:
    m = _mean(values)
    return None if m is None else _mean([(v - m) ** 2 for v in values if v is not None]) ** 0.5


def evaluate(problem: Problem, predicted: DataFrame) -> DataFrame:
    """One row with every metric of the task."""
    if problem.task == "regression":
        return metrics.regression_metrics(predicted, problem.target, "prediction")
    base = metrics.classification_metrics(predicted, problem.target, "prediction")
    if "scores" not in predicted.columns:
        return base
    if len(problem.labels) == 2:
        from pyspark.ml.functions import vector_to_array

        positive = name_col(problem.target).cast("string") == problem.labels[1]
        rank = metrics.ranking_metrics(predicted, positive, vector_to_array("scores")[1])
        rank = rank.select(rnd(F.col("roc_auc"), 4).alias("roc_auc"), rnd(F.col("pr_auc"), 4).alias("pr_auc"))
    else:
        rank = metrics.weighted_ovr_auc(predicted, problem.target, "scores", problem.labels)
        rank = rank.select(rnd(F.col("roc_auc"), 4).alias("roc_auc"))
    return base.transform(with_scalars, rank)  # one row each


@dataclass(frozen=True)
class Training:
    problem: Problem
    fitted: dict[str, Fitted]
    leaderboard: DataFrame
    best: str
    train: DataFrame
    test: DataFrame
    folds: int
    imbalance_ratio: float
    weighted: bool

    @property
    def best_model(self) -> Fitted:
        return self.fitted[self.best]

    def predictions(self) -> DataFrame:
        return self.best_model.predict(self.test)

    def importance(self) -> DataFrame:
        return feature_importance(self.best_model)

    def confusion(self) -> DataFrame:
        return metrics.confusion_matrix(self.predictions(), self.problem.target, "prediction", self.problem.labels)


def train_and_evaluate(
    df: DataFrame,
    target: str,
    test_share: float = 0.2,
    cv_folds: int = 5,
    cap: int | None = None,
    models: list[str] | None = None,
    settings: dict[str, dict[str, Any]] | None = None,
) -> Training:
    """Cross-validate, fit and score every candidate; the best one leads the board.

    ``cap`` bounds the training rows by a stratified sample; it is off by default.
    """
    problem = frame_problem(df, target)
    by = target if problem.task == "classification" else None
    data = training_sample(problem.data, cap, by) if cap else problem.data
    ratio, weights = class_weights(data, target) if by else (1.0, {})
    train, test = split(data, by, test_share)
    train, test = train.persist(), test.persist()
    try:
        return _trained(problem, train, test, cv_folds, models, settings or {}, ratio, weights)
    finally:
        train.unpersist()
        test.unpersist()


def _trained(
    problem: Problem,
    train: DataFrame,
    test: DataFrame,
    cv_folds: int,
    models: list[str] | None,
    settings: dict[str, dict[str, Any]],
    ratio: float,
    weights: dict[str, float],
) -> Training:
    by = problem.target if problem.task == "classification" else None
    names = models or (CLASSIFIERS if by else REGRESSORS)
    folds = fold_count(problem, train, cv_folds)
    inherit = inheritable_thread_target(train.sparkSession)
    preparation = fit_preparation(train, problem.features)

    def final(name: str) -> tuple[Fitted, dict[str, Any]]:
        found = fit_model(problem, train, name, preparation, settings.get(name), weights)
        return found, evaluate(problem, found.predict(test)).first().asDict()

    beside = side_by_side(preparation.rows, len(names))
    with ThreadPool(beside) as pool:  # the fits on all training rows run beside those of the folds, unless they are large
        finals = pool.map_async(inherit(final), names, chunksize=1)
        if beside == 1:
            finals.wait()
        cv = cross_validate(problem, train, [(n, settings.get(n, {})) for n in names], folds, weights)
        done = finals.get()
    fitted, rows, order = {}, [], {}
    for i, (name, (found, row)) in enumerate(zip(names, done)):
        fitted[name] = found
        held = [s for s, _ in cv[i]]
        row = {"model": name, **row, "cv_mean": _mean(held), "cv_std": _spread(held)}
        rows.append({k: (round(v, 4) if isinstance(v, float) else v) for k, v in row.items()})
        order[name] = row["f1" if by else "r2"]
    columns = list(dict.fromkeys(c for r in rows for c in r))
    schema = ", ".join(f"`{c}` {'string' if c == 'model' else 'double'}" for c in columns)
    board = train.sparkSession.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)
    best = max(names, key=lambda n: -math.inf if order[n] is None else order[n])
    return Training(problem, fitted, board, best, train, test, folds, ratio, bool(weights))


def feature_importance(fitted: Fitted) -> DataFrame:
    """Tree importances, or absolute coefficients (first class row), per vector slot."""
    m, slots = fitted.model, fitted.preparation.slots
    if hasattr(m, "featureImportances"):
        values = m.featureImportances.toArray()
    elif hasattr(m, "coefficientMatrix"):
        values = abs(m.coefficientMatrix.toArray()[0])
    elif hasattr(m, "coefficients"):
        values = abs(m.coefficients.toArray())
    elif hasattr(m, "models"):  # one booster per class
        values = sum(x.featureImportances.toArray() for x in m.models) / len(m.models)
    else:
        raise ValueError("model has no importances; use permutation_importance")
    spark = fitted.problem.data.sparkSession
    rows = [(s, o, float(v)) for s, o, v in zip(slots, fitted.preparation.owners, values)]
    return spark.createDataFrame(rows, "feature string, source string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def shuffle_column(df: DataFrame, column: str, seed: int) -> DataFrame:
    """Permute one column over the table: two hash orders are numbered and matched."""
    rows = df.withColumn("_u", unit_hash(df.columns, seed)).withColumn("_w", unit_hash(df.columns, seed + 1))
    values = sequence_numbers(rows.select(name_col(column).alias("_v"), "_w", "_u"), [], "_w", "_seq", tie="_u")
    numbered = sequence_numbers(rows.drop(column), [], "_u", "_seq", tie="_w")
    return (
        numbered.join(values.select("_seq", "_v"), "_seq")
        .select(*[(F.col("_v").alias(c) if c == column else name_col(c)) for c in df.columns])
    )


def shifted_variants(df: DataFrame, features: list[str], repeats: int, seed: int = SEED) -> DataFrame:
    """Every row once per feature and repeat, with that feature's value taken from another row.

    Rows are numbered once along a hash. In repeat r a row's partner stands ``r`` steps further on, round the
    end; one join brings all partners. The values of a feature are thus permuted over the table.
    """
    keyed = df.withColumns({"_u": unit_hash(df.columns, seed), "_w": unit_hash(df.columns, seed + 1)})
    numbered = settle(sequence_numbers(keyed, [], "_u", "_i", tie="_w").drop("_u", "_w"), "numbered")
    n = numbered.count()
    step = max(1, n // (repeats + 1))
    places = F.array(*[F.struct(F.lit(r).alias("repeat"), (F.pmod(F.col("_i") - 1 - (r + 1) * step, F.lit(max(1, n))) + 1).alias("_i")) for r in range(repeats)])
    partners = numbered.select(F.struct(*[name_col(f).alias(f"f{k}") for k, f in enumerate(features)]).alias("_d"), F.inline(places))
    whose = F.explode(F.array(*[F.lit(k) for k in range(len(features))])).alias("_f")
    rows = numbered.join(partners, "_i").select("*", whose)
    place = {f: k for k, f in enumerate(features)}
    cells = [
        F.when(F.col("_f") == place[c], F.col("_d")[f"f{place[c]}"]).otherwise(name_col(c)).alias(c) if c in place else name_col(c) for c in df.columns
    ]
    return rows.select(*cells, F.col("_f").alias("_feature"), F.col("repeat").alias("_repeat"))


def permutation_importance(fitted: Fitted, test: DataFrame, repeats: int = 5) -> DataFrame:
    """Mean drop of the score when one source column is permuted on held-out rows.

    All features and repeats are scored in one pass; the driver gets their confusion counts or sums.
    """
    problem = fitted.problem
    base = score(problem, fitted.predict(test))
    predicted = fitted.predict(shifted_variants(test, problem.features, repeats))
    jobs = ["_feature", "_repeat"]
    scores: dict[tuple[int, int], float | None] = {}
    if problem.task == "classification":
        label = name_col(problem.target).cast("string").alias("label")
        cells: dict[tuple[int, int], list] = {}
        for r in predicted.groupBy(*jobs, label, "prediction").count().collect():  # a row per pair of classes
            cells.setdefault((r["_feature"], r["_repeat"]), []).append(r)
        scores = {job: _weighted_f1(own) for job, own in cells.items()}
    else:
        y = name_col(problem.target).cast("double")
        sums = predicted.groupBy(*jobs).agg(F.sum((y - F.col("prediction")) ** 2).alias("off"), (F.var_pop(y) * F.count(y)).alias("all"))
        scores = {(r["_feature"], r["_repeat"]): 1 - r["off"] / r["all"] if r["all"] else None for r in sums.collect()}
    drops = [base - scores[k, r] for k in range(len(problem.features)) for r in range(repeats)]
    jobs = [(c, r) for c in problem.features for r in range(repeats)]
    rows = []
    for c in problem.features:
        own = [d for (name, _), d in zip(jobs, drops) if name == c]
        rows.append((c, _mean(own), _spread(own)))
    return test.sparkSession.createDataFrame(rows, "feature string, importance double, std double").orderBy(
        F.col("importance").desc(), "feature"
    )
