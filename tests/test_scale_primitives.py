"""The two-level plans must give the same answers as the obvious one-task versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.functions import quantiles
from statloom.functions.prefix import fill_along, prefix_sums, sequence_numbers, with_range
from statloom.functions.quantiles import column_quantiles, group_quantiles, select_quantiles
from statloom.functions.skew import attach_by_key


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    n = 6000
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 40, n).astype(str)),
            "t": rng.integers(0, 3000, n),
            "x": np.where(rng.random(n) < 0.35, 7.0, rng.normal(0, 50, n).round(2)),
            "v": np.where(rng.random(n) < 0.5, np.nan, rng.integers(0, 9, n)),
        }
    )


def _frame(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


@pytest.mark.parametrize("accuracy", [200, 50_000])
def test_selected_quantiles_match_pandas(spark, skewed, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", accuracy)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = _frame(spark, skewed)
    got = column_quantiles(df, ["x", "t"], probs, limit=10)
    for c in ("x", "t"):
        assert np.allclose(got[c], skewed[c].quantile(probs).to_numpy())
    by_key = {r["k"]: r["q"] for r in group_quantiles(df, ["k"], "x", probs, limit=10).collect()}
    want = skewed.groupby("k")["x"].quantile(probs).unstack()
    assert set(by_key) == set(want.index)
    for k, q in by_key.items():
        assert np.allclose(q, want.loc[k].to_numpy())


def test_missed_brackets_are_ordered_in_full(spark, skewed, monkeypatch):
    monkeypatch.setattr(quantiles, "_brackets", lambda probs: [0.6] * len(probs) + [0.61] * len(probs))
    probs = [0.25, 0.5]
    df = _frame(spark, skewed)
    assert np.allclose(column_quantiles(df, ["x"], probs, limit=10)["x"], skewed["x"].quantile(probs))
    by_key = {r["k"]: r["q"] for r in select_quantiles(df.select("k", "x"), ["k"], "x", probs, 41).collect()}
    want = skewed.groupby("k")["x"].quantile(probs).unstack()
    assert all(np.allclose(by_key[k], want.loc[k]) for k in want.index)


def test_ranges_follow_the_order(spark, skewed):
    df = with_range(_frame(spark, skewed), "x", ranges=16)
    spans = df.groupBy("_range").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_range").collect()
    assert len(spans) > 4
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_prefix_sums(spark, skewed):
    df = _frame(spark, skewed).groupBy("t").agg(F.count("*").alias("n"))
    got = prefix_sums(df, "t", ["n"], ranges=9).toPandas().sort_values("t")
    assert (got["n_upto"].to_numpy() == got["n"].cumsum().to_numpy()).all()


def test_sequence_numbers(spark, skewed):
    got = sequence_numbers(_frame(spark, skewed), ["k"], "t", tie="id", ranges=9).toPandas()
    want = skewed.sort_values(["t", "id"]).groupby("k").cumcount() + 1
    assert (got.set_index("id")["seq"].sort_index() == want.sort_index()).all()


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("backward", [False, True])
def test_fill_along(spark, skewed, keys, backward):
    got = fill_along(_frame(spark, skewed), "v", "t", keys, backward, tie="id", ranges=9).toPandas()
    ordered = skewed.sort_values(["t", "id"])
    grouped = ordered.groupby("k")["v"] if keys else ordered["v"]
    want = (grouped.bfill() if backward else grouped.ffill()).sort_index()
    have = got.set_index("id")["v"].sort_index()
    assert len(have) == len(want)
    assert ((have == want) | (have.isna() & want.isna())).all()


def test_fill_keeps_rows_with_null_keys_and_orders(spark):
    df = spark.createDataFrame(
        [(None, 1, 5.0), (None, 2, None), ("a", None, 1.0), ("a", 1, None)], "k string, t int, v double"
    )
    got = fill_along(df, "v", "t", ["k"], ranges=2)
    assert sorted(map(str, got.collect())) == sorted(
        map(str, [_row("a", None, 1.0), _row("a", 1, 1.0), _row(None, 1, 5.0), _row(None, 2, 5.0)])
    )


def _row(k, t, v):
    from pyspark.sql import Row

    return Row(k=k, t=t, v=v)


def test_attach_by_key_keeps_every_row(spark, skewed):
    df = _frame(spark, skewed)
    lookup = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("t").alias("s"))
    got = attach_by_key(df, lookup, ["k"], "n", df.count()).toPandas()
    assert len(got) == len(skewed)
    want = skewed.groupby("k")["t"].sum()
    assert (got["s"] == got["k"].map(want)).all()


ORDERS = {
    "text": "concat('k', lpad(cast(id % 37 as string), 3, '0'))",
    "date": "date_add(date'2020-01-01', cast(id % 37 as int))",
    "timestamp": "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 37)",
    "timestamp_ntz": "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 37)",
    "decimal": "cast(id % 37 as decimal(20, 3)) / 7",
    "long": "9007199254740992 + id % 37",
    "binary": "unhex(lpad(hex(id % 37), 4, '0'))",
    "nulls": "if(id % 3 = 0, null, id % 37)",
}


@pytest.mark.parametrize("kind", sorted(ORDERS))
@pytest.mark.parametrize("ranges", [1, 3])
def test_scans_along_any_order_type(spark, kind, ranges):
    df = spark.range(300).selectExpr("id", "id % 4 as k", f"{ORDERS[kind]} as o", "if(id % 5 = 0, id, null) as v")
    rows = df.orderBy("o", "id").collect()
    seen, last, want_seq, want_fill = {}, {}, {}, {}
    for r in rows:
        seen[r.k] = seen.get(r.k, 0) + 1
        last[r.k] = r.v if r.v is not None else last.get(r.k)
        want_seq[r.id], want_fill[r.id] = seen[r.k], last[r.k]
    numbered = sequence_numbers(df, ["k"], "o", tie="id", ranges=ranges, size="n")
    assert {r.id: (r.seq, r.n) for r in numbered.collect()} == {i: (s, 75) for i, s in want_seq.items()}
    filled = fill_along(df, "v", "o", ["k"], tie="id", ranges=ranges)
    assert {r.id: r.v for r in filled.collect()} == want_fill


def test_one_order_value_is_spread_over_ranges(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 7, id) as o")
    sizes = [r["count"] for r in with_range(df, "o", ranges=8, tie="id").groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1200


@pytest.mark.parametrize("kind", ["double", "string", "timestamp", "date", "decimal(20,3)", "binary", "bigint", "boolean"])
def test_searched_limits_are_the_compared_ones(spark, monkeypatch, kind):
    """Beyond a few limits a binary search in constant arrays finds the range that the tree of conditions finds."""
    from statloom.functions import prefix

    base = spark.range(3000).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL ELSE (id * 7919) % 3001 - 1500 END AS n")
    value = {
        "timestamp": "timestamp_micros(n * 1000003)",
        "date": "date_add(date'2000-01-01', CAST(n AS INT))",
        "binary": "CAST(CAST(n AS STRING) AS BINARY)",
        "boolean": "n > 0",
    }.get(kind, f"CAST(n / 4 AS {kind})")
    df = base.selectExpr("id", f"{value} AS x")
    monkeypatch.setattr(prefix, "IN_LINE", 1000)
    tree = {r["id"]: r["_range"] for r in with_range(df, "x", ranges=100, tie="id").collect()}
    monkeypatch.setattr(prefix, "IN_LINE", 1)
    searched = with_range(df, "x", ranges=100, tie="id")
    assert {r["id"]: r["_range"] for r in searched.collect()} == tree
    assert max(tree.values()) == 99
    spans = searched.groupBy("_range").agg(F.min(F.struct("x", "id")).alias("lo"), F.max(F.struct("x", "id")).alias("hi")).orderBy("_range")
    joined = spans.withColumn("before", F.lag("hi").over(Window.orderBy("_range")))
    assert joined.where("before >= lo").count() == 0
    assert "TakeOrdered" not in searched._jdf.queryExecution().executedPlan().toString()


def test_sample_for_limits_is_bounded(spark, monkeypatch):
    """About as many rows as wanted, whatever the partitions; long texts are cut."""
    from statloom.functions import prefix

    df = spark.range(200_000).selectExpr("concat(repeat('y', 300), id) AS x").repartition(50)
    limits = prefix._sampled(df, ["x"], 8, 200_000)
    assert all(len(v) <= prefix.LONGEST for (v,) in limits)
    numbers = prefix._sampled(spark.range(200_000).repartition(50), ["id"], 8, 200_000)
    assert len(numbers) == 7 and all(abs(int(v) - 25_000 * (i + 1)) < 30_000 for i, (v,) in enumerate(numbers))
