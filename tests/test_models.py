import collections
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statloom.functions.trees import Forest
from statloom.operators import explain, fairness, metrics, models, preprocess, target, unsupervised
from statloom.plans import bundles


@pytest.fixture(scope="module")
def staff(spark):
    rng = np.random.default_rng(42)
    n = 120
    score = np.clip(rng.normal(3.8, 0.5, n), 1, 5)
    pdf = pd.DataFrame(
        {
            "emp_id": range(n),
            "department": rng.choice(["Eng", "HR", "Ops"], n),
            "age": rng.integers(22, 60, n).astype(float),
            "performance": score.round(2),
            "salary": (40_000 + 12_000 * score + rng.normal(0, 4_000, n)).round(0),
            "promoted": np.where(score + rng.normal(0, 0.3, n) > 4, "Yes", "No"),
        }
    )
    return spark.createDataFrame(pdf).withColumn("age", F.when(F.col("emp_id") % 9 != 0, F.col("age"))).cache()


def test_target_and_identifiers(staff):
    problem = models.frame_problem(staff, "promoted")
    assert problem.dropped == ["emp_id"] and problem.task == "classification" and problem.labels == ["No", "Yes"]
    assert target.suggest_target(staff) == "promoted"
    assert target.detect_task(staff, "salary") == "regression"


def test_one_letter_word_must_be_a_whole_part(spark):
    df = spark.createDataFrame([(i, i % 3, i % 2) for i in range(30)], "n int, salary_band int, flag int")
    assert target.suggest_target(df) == "flag"
    assert target.suggest_target(df, legacy=True) == "salary_band"


def test_too_few_rows(spark):
    with pytest.raises(ValueError):
        models.frame_problem(spark.createDataFrame([(i, i) for i in range(5)], "x int, y int"), "y")


def test_split_is_stratified_and_independent_of_partitioning(staff):
    train, test = preprocess.split(staff, "promoted", key=["emp_id"])
    again = preprocess.split(staff.repartition(7), "promoted", key=["emp_id"])[1]
    ids = {r[0] for r in test.select("emp_id").collect()}
    assert ids == {r[0] for r in again.select("emp_id").collect()}
    assert train.count() + test.count() == 120
    for r in staff.groupBy("promoted").count().collect():
        assert abs(test.filter(F.col("promoted") == r["promoted"]).count() - 0.2 * r["count"]) <= 1


def test_folds_cover_all_rows_evenly(staff):
    sizes = [r["count"] for r in preprocess.with_folds(staff, 5, "promoted", ["emp_id"]).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 120 and max(sizes) - min(sizes) <= 2


def test_preparation(spark, staff):
    prep = preprocess.fit_preparation(staff, ["age", "department"])
    assert prep.slots == ["age", "department_Eng", "department_HR", "department_Ops"]
    strange = spark.createDataFrame([(30.0, "Moon"), (None, None)], "age double, department string")
    unknown, empty = [r[0] for r in prep.transform(strange).select(vector_to_array("features")).collect()]
    assert unknown[1:] == [0.0, 0.0, 0.0]
    assert sum(empty[1:]) == 1.0
    pdf = staff.toPandas()
    filled = pdf["age"].fillna(pdf["age"].median())
    assert empty[0] == pytest.approx((pdf["age"].median() - filled.mean()) / filled.std(ddof=0))


def test_columns_with_different_numbers_of_levels(staff):
    prep = preprocess.fit_preparation(staff, ["promoted", "department"])
    assert prep.slots == ["promoted_No", "promoted_Yes", "department_Eng", "department_HR", "department_Ops"]
    sums = prep.transform(staff).select(vector_to_array("features").alias("x"))
    totals = [sums.agg(F.sum(F.col("x")[i])).first()[0] for i in range(5)]
    assert sum(totals[:2]) == sum(totals[2:]) == 120


@pytest.fixture(scope="module")
def trained(staff):
    return models.train_and_evaluate(
        staff.drop("salary"), "promoted", cv_folds=2, settings={"Random Forest": {"trees": 10}, "Gradient Boosting": {"trees": 5}}
    )


def test_leaderboard(trained):
    rows = {r["model"]: r for r in trained.leaderboard.collect()}
    assert set(rows) == set(models.CLASSIFIERS)
    assert all(0 <= r[m] <= 1 for r in rows.values() for m in ("accuracy", "f1", "roc_auc", "pr_auc"))
    assert rows[trained.best]["f1"] == max(r["f1"] for r in rows.values())
    assert rows["Logistic Regression"]["accuracy"] > 0.7
    counts = [v for r in trained.confusion().collect() for v in r[1:]]
    assert sum(counts) == trained.test.count()
    imp = [r["importance"] for r in trained.importance().collect()]
    assert imp == sorted(imp, reverse=True)


def test_attributions_add_up(trained):
    df = trained.problem.data
    for name, output in [("Logistic Regression", "rawPrediction"), ("Random Forest", "probability"), ("Gradient Boosting", "rawPrediction")]:
        fitted = trained.fitted[name]
        found = explain.explain(fitted, df, ["emp_id"])
        total = found.values.groupBy("emp_id").agg((F.sum("shap_value") + found.base).alias("t"))
        real = fitted.model.transform(fitted.preparation.transform(df)).select("emp_id", vector_to_array(output)[1].alias("o"))
        assert total.join(real, "emp_id").agg(F.max(F.abs(F.col("t") - F.col("o")))).first()[0] < 1e-9


def test_tree_attribution_matches_subset_enumeration(trained):
    fitted = trained.fitted["Random Forest"]
    nodes = explain.forest_nodes(fitted).to_pydict()
    children = collections.defaultdict(list)
    for i, p in enumerate(nodes["parent"]):
        children[p].append(i)
    row = np.array(fitted.preparation.transform(trained.problem.data.limit(1)).select(vector_to_array("features")).first()[0])
    width = len(row)

    def value(known: int, i: int = -1) -> float:
        """The output with the known features: unknown ones go both ways by their shares."""
        if i < 0:
            return sum(value(known, root) for root in children[-1])
        if not children[i]:
            return nodes["value"][i]
        f = nodes["feature"][i]
        if known >> f & 1:
            return sum(value(known, c) for c in children[i] if (row[f] <= nodes["cut"][i]) == nodes["left"][c])
        return sum(nodes["share"][c] * value(known, c) for c in children[i])

    v = [value(s) for s in range(1 << width)]
    want = np.zeros(width)
    for j in range(width):
        for s in range(1 << width):
            if not s >> j & 1:
                size = bin(s).count("1")
                weight = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                want[j] += weight * (v[s | 1 << j] - v[s])
    for most in (10**6, 10):
        groups = explain._forests(explain.forest_nodes(fitted), width, most)
        forests = [Forest(*part) for group in groups for part in explain._split(group)]
        assert np.allclose(sum(f.attribute(np.stack([row, row]))[1] for f in forests), want)
        assert np.isclose(sum(f.base for f in forests), v[0])
    assert len(groups) == 10


def test_deep_trees_over_one_feature():
    """Paths that repeat features and single nodes, against all subsets."""
    rng = np.random.default_rng(4)
    parent, feature, cut, left, share = [-1], [0], [0.0], [True], [1.0]
    open_nodes = [0]
    for _ in range(60):
        i = open_nodes.pop(rng.integers(len(open_nodes)))
        feature[i], cut[i] = int(rng.integers(3)), float(rng.normal())
        part = float(rng.uniform(0.05, 0.95))
        for lower in (True, False):
            open_nodes.append(len(parent))
            parent.append(i), feature.append(-1), cut.append(0.0), left.append(lower), share.append(part if lower else 1 - part)
    value = rng.normal(size=len(parent))
    forest = Forest(parent, feature, cut, left, share, value, 3)
    kids = collections.defaultdict(list)
    for i, p in enumerate(parent):
        kids[p].append(i)

    def output(row, known, i=0):
        if not kids[i]:
            return value[i]
        if known >> feature[i] & 1:
            return sum(output(row, known, c) for c in kids[i] if (row[feature[i]] <= cut[i]) == left[c])
        return sum(share[c] * output(row, known, c) for c in kids[i])

    rows = rng.normal(size=(20, 3))
    got = forest.attribute(rows)
    for row, phi in zip(rows, got):
        v = [output(row, s) for s in range(8)]
        for j in range(3):
            others = [s for s in range(8) if not s >> j & 1]
            want = sum((1 / 3 if bin(s).count("1") in (0, 2) else 1 / 6) * (v[s | 1 << j] - v[s]) for s in others)
            assert np.isclose(phi[j], want)
    assert np.isclose(forest.base, output(rows[0], 0))
    assert not Forest([-1], [-1], [0.0], [True], [1.0], [5.0], 2).attribute(np.zeros((3, 2))).any()


def test_regression(staff):
    t = models.train_and_evaluate(staff.drop("promoted"), "salary", cv_folds=2, models=["Linear Regression"])
    row = t.leaderboard.first()
    assert t.problem.task == "regression" and row["r2"] > 0.3 and row["rmse"] > 0


def test_shuffling_keeps_the_values(staff):
    out = models.shuffle_column(staff.select("emp_id", "salary"), "salary", 1).toPandas()
    old = staff.select("emp_id", "salary").toPandas()
    assert sorted(out["salary"]) == sorted(old["salary"]) and out["emp_id"].is_unique
    merged = out.merge(old, on="emp_id")
    assert (merged["salary_x"] != merged["salary_y"]).mean() > 0.5


def test_three_class_auc_is_weighted(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 90)
    p = rng.dirichlet([1, 1, 1], 90).round(2)
    df = spark.createDataFrame([(str(a), b.tolist()) for a, b in zip(y, p)], "y string, s array<double>")
    from pyspark.ml.functions import array_to_vector

    got = metrics.weighted_ovr_auc(df.withColumn("v", array_to_vector("s")), "y", "v", ["0", "1", "2"]).first()[0]
    want = 0.0
    for k in range(3):
        pos, neg = p[y == k, k], p[y != k, k]
        auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
        want += auc * len(pos) / 90
    assert got == pytest.approx(want)


def test_pca_and_clusters(staff):
    c = unsupervised.run_pca(staff, names=["performance", "salary", "age"])
    shares = [r["explained_variance"] for r in c.variance.collect()]
    assert shares == sorted(shares, reverse=True) and sum(shares) == pytest.approx(1, abs=1e-3)
    k = unsupervised.run_clustering(staff, k_max=3, starts=1, names=["performance", "salary"])
    assert sum(r["size"] for r in k.profiles.collect()) == 120 and 2 <= k.k <= 3
    with pytest.raises(ValueError):
        unsupervised.numeric_matrix(staff.select("age", "promoted"))


def test_fairness_matches_by_key(spark):
    rows = [(i, "m" if i % 2 else "f", i % 3 == 0, i % 2 == 0) for i in range(60)]
    df = spark.createDataFrame([(i, g, int(y), int(p)) for i, g, y, p in rows], "id int, sex string, y int, p int")
    report = fairness.run_fairness_analysis(df.select("id", "sex").repartition(5), df.select("id", "y", "p"), ["id"], "y", "p")
    assert report.sensitive_column == "sex"
    groups = {r["group"]: r for r in report.groups.collect()}
    assert groups["f"]["selection_rate"] == 1.0 and groups["m"]["selection_rate"] == 0.0
    assert not report.summary.first()["overall_pass"]


def test_analysis_bundle(staff):
    found = bundles.analyze(staff, "promoted", models=["Logistic Regression"], cv_folds=2)
    assert [r["topic"] for r in found["findings"].orderBy("position").collect()] == ["size", "cleaning", "relationship", "model", "drivers"]
    assert found["profile_cleaned"].first()["missing_cells"] == 0


def test_contexts(spark):
    rows = {r["dataset"]: r for r in bundles.contexts_for(spark.createDataFrame([("Heart-Disease",), ("other",)], "dataset string")).collect()}
    assert rows["Heart-Disease"]["sensitive_column"] == "sex"
    assert rows["other"]["title"] == "Data Science Analysis" and rows["other"]["target_column"] is None


def test_every_variant_permutes_one_feature(staff):
    """All features and repeats: the other columns stay, the own one is the same values in another order."""
    df = staff.select("emp_id", "age", "department", "salary")
    out = models.shifted_variants(df, ["age", "department"], 3).toPandas()
    old = df.toPandas().set_index("emp_id")
    assert len(out) == 2 * 3 * len(old)
    for (f, _), part in out.groupby(["_feature", "_repeat"]):
        part = part.set_index("emp_id").loc[old.index]
        own, other = [("age", "department"), ("department", "age")][f]
        assert (part[other].fillna(-1) == old[other].fillna(-1)).all() and (part["salary"] == old["salary"]).all()
        assert sorted(part[own].fillna(-1).astype(str)) == sorted(old[own].fillna(-1).astype(str))
        assert (part[own] != old[own]).mean() > 0.3
    assert models.shifted_variants(df.limit(0), ["age"], 2).count() == 0


def test_importance_finds_the_feature_that_counts(staff):
    problem = models.frame_problem(staff.select("department", "age", "promoted", "performance"), "promoted")
    fitted = models.fit_model(problem, problem.data, "Logistic Regression")
    rows = models.permutation_importance(fitted, problem.data, 3).collect()
    assert [r["feature"] for r in rows][0] == "performance" and rows[0]["importance"] > 0.1
    assert {r["feature"] for r in rows} == set(problem.features)
