import itertools

import numpy as np
import pandas as pd
import pytest

from statloom.functions.exprs import p_text
from statloom.operators import correlation, describe, inference, profile


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=300).round(1), "b": rng.integers(0, 9, 300).astype(float)})
    pdf["c"] = (pdf["a"] * 2 + rng.normal(size=300)).round(1)
    pdf.loc[::7, "c"] = np.nan
    pdf["k"] = 4.0
    return pdf, spark.createDataFrame(pdf)


def test_descriptive_matches_pandas(numbers):
    pdf, df = numbers
    got = {r["feature"]: r for r in describe.descriptive_stats(df).collect()}
    for c in pdf:
        s = pdf[c].dropna()
        assert got[c]["count"] == len(s) and got[c]["missing"] == len(pdf) - len(s)
        for name, want in [("mean", s.mean()), ("std", s.std()), ("median", s.median()), ("skewness", s.skew()), ("kurtosis", s.kurt())]:
            assert got[c][name] == pytest.approx(want, abs=1e-4), (c, name)


@pytest.mark.parametrize("n, skewness, kurtosis", [(1, None, None), (2, None, None), (3, "x", None), (4, "x", "x")])
def test_short_columns(spark, n, skewness, kurtosis):
    row = describe.descriptive_stats(spark.createDataFrame([(float(x * x),) for x in range(n)], "a double")).first()
    assert (row["skewness"] is None) == (skewness is None)
    assert (row["kurtosis"] is None) == (kurtosis is None)


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert describe.descriptive_stats(empty).count() == 0
    assert profile.profile_dataset(empty).first()["n_rows"] == 0
    assert describe.outlier_summary(empty).count() == 0
    assert profile.categorical_summary(empty).count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "a double")
    assert describe.descriptive_stats(nulls).count() == 0


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations_match_brute_force(numbers, method):
    pdf, df = numbers
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.correlation_pairs(df, method).collect()}
    want = _kendall(pdf) if method == "kendall" else pdf.corr(method=method)
    for a, b in itertools.combinations(pdf.columns, 2):
        if "k" in (a, b):
            assert got[a, b] is None
        else:
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)


def _kendall(pdf):
    out = pd.DataFrame(index=pdf.columns, columns=pdf.columns, dtype=float)
    for a, b in itertools.combinations(pdf.columns, 2):
        both = pdf[[a, b]].dropna().to_numpy()
        dx = np.sign(both[:, None, 0] - both[None, :, 0])
        dy = np.sign(both[:, None, 1] - both[None, :, 1])
        ties = np.sqrt((dx != 0).sum() * (dy != 0).sum())
        out.loc[a, b] = (dx * dy).sum() / ties if ties else np.nan
    return out


def test_wide_tables_use_the_gram_matrix(spark, monkeypatch, numbers):
    pdf, _ = numbers
    df = spark.createDataFrame(pdf[["a", "b", "k"]])
    plain = {tuple(r[:2]): r["r"] for r in correlation.correlation_pairs(df).collect()}
    monkeypatch.setattr(correlation, "PAIRS_PER_SCAN", 1)
    wide = {tuple(r[:2]): r["r"] for r in correlation.correlation_pairs(df).collect()}
    assert wide["a", "b"] == pytest.approx(plain["a", "b"])
    assert wide["a", "k"] is None and wide["b", "k"] is None


def test_matrix_is_square_with_unit_diagonal(numbers):
    _, df = numbers
    rows = {(r[0], r[1]): r[2] for r in correlation.correlation_matrix(df.drop("k")).collect()}
    assert len(rows) == 9
    assert all(rows[c, c] == 1.0 for c in "abc") and rows["a", "b"] == rows["b", "a"]


def test_significance_skips_constants(numbers):
    _, df = numbers
    rows = correlation.correlation_significance(df).collect()
    assert {r["feature_a"] for r in rows} | {r["feature_b"] for r in rows} == {"a", "b", "c"}
    assert [abs(r["r"]) for r in rows] == sorted([abs(r["r"]) for r in rows], reverse=True)
    assert rows[0]["significant"] == "significant"


def test_independent_two_by_two(spark):
    rows = [(x, y) for x in "ab" for y in "cd" for _ in range(25)]
    r = inference.chi_square_independence(spark.createDataFrame(rows, "x string, y string"), "x", "y").first()
    assert (r["chi2"], r["dof"], r["p_value"], r["cramers_v"]) == (0.0, 1, 1.0, 0.0)


def test_group_tests_need_two_usable_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    assert inference.compare_groups(df, "v", "g").count() == 0


@pytest.mark.parametrize("method", ["bonferroni", "fdr_bh"])
def test_adjusted_p_values(spark, method):
    p = [0.001, 0.02, 0.03, 0.04, 0.04, 0.5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "i int, p_value double")
    rows = {r["i"]: r for r in inference.correct_pvalues(df, method=method).collect()}
    n = len(p)
    if method == "bonferroni":
        want = [min(1.0, x * n) for x in p]
    else:
        want = [min(min(1.0, q * n / (j + 1)) for j, q in enumerate(p) if j >= i) for i in range(n)]
    assert [rows[i]["p_adjusted"] for i in range(n)] == pytest.approx(want)
    assert all(rows[i]["reject"] == (want[i] < 0.05) for i in range(n))


def test_assumption_advice(spark):
    rng = np.random.default_rng(2)
    rows = [("a", x) for x in rng.normal(0, 1, 80).tolist()] + [("b", x) for x in rng.normal(0, 9, 80).tolist()]
    r = inference.assumption_checks(spark.createDataFrame(rows, "g string, v double"), "v", "g").first()
    assert r["all_groups_normal"] and not r["equal_variance"] and r["recommended_test"] == "Welch t-test"
    rows += [("c", x) for x in rng.exponential(1, 80).tolist()]
    r = inference.assumption_checks(spark.createDataFrame(rows, "g string, v double"), "v", "g").first()
    assert r["recommended_test"].startswith("Kruskal-Wallis")


def test_confidence_interval(spark):
    r = inference.confidence_intervals(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,)], "x double")).first()
    assert (r["low"], r["high"]) == pytest.approx((1.0368, 4.9632), abs=1e-4)


def test_p_text(spark):
    df = spark.createDataFrame([(0.0001,), (0.0234,), (None,)], "p double")
    assert [r[0] for r in df.select(p_text(df["p"])).collect()] == ["<0.001", "0.023", None]


def test_duplicates_survive_null_shifts(spark):
    # rows that share a hash because NULLs do not enter it must not count as copies
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), (None, None)], "x string, y string")
    assert profile.profile_dataset(df).first()["duplicate_rows"] == 1


def test_warnings(spark):
    wide = spark.createDataFrame([tuple(range(51))], ", ".join(f"c{i} int" for i in range(51)))
    found = {r["warning"] for r in profile.health_warnings(wide).collect()}
    assert found == {"wide_table", "few_rows"}
