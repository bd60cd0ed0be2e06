"""Rows that share an id or have none, vectors of several lengths, and crowded buckets led by one row."""

import collections
import random

import numpy as np
import pytest

pytest.importorskip("statloom.llm.queries")
import corpus_pipeline  # noqa: E402
from statloom.llm import blocks, chunks, graph, itq, simhash  # noqa: E402
from statloom.llm.common import maybe_among, told_apart  # noqa: E402


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgh')}{rng.randrange(4000)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_numbers_of_documents(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (2, "c"), (None, "a"), (None, "a"), (None, None), (3, None), (3, "")]
    got = told_apart(frame(spark, rows), "k").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id, r.text].add(r.k)
    assert by[1, "a"] == {1} and by[3, None] == by[3, ""] == {3}
    assert len(by[None, "a"]) == 2 and len(by[2, "b"]) == len(by[2, "c"]) == 1 and by[2, "b"] != by[2, "c"]
    assert all(r.k > 3 for r in got if r.doc_id in (None, 2))
    assert told_apart(frame(spark, rows).limit(0), "k").collect() == []


def test_a_text_loses_its_own_passages_only(spark):
    shared, first, other = prose(1, 120), prose(2, 200), prose(3, 200)
    rows = [(1, f"{first} {shared}"), (2, f"{prose(4, 150)} {shared} {prose(5, 50)}"), (2, other), (None, f"{prose(6, 90)} {shared}"), (None, prose(7, 80)), (4, "é ü " * 5)]
    before = frame(spark, rows)
    after = [r.text for r in chunks.without_repeats(before).collect()]
    assert len(after) == len(rows)
    for text in (rows[0][1], other, prose(7, 80), "é ü " * 5):
        assert text in after  # of these nothing repeats
    assert sum(shared in t for t in after) == 1
    spans = chunks.repeats(before).collect()
    assert {r.doc_id for r in spans} == {1, 2, None} and {r.first_doc for r in spans} == {1}


def test_copies_without_an_id(spark):
    a, b = prose(1, 100), prose(2, 100)
    rows = [(None, a), (None, a), (5, a), (None, b), (None, b), (7, prose(3, 50)), (7, prose(3, 50)), (7, prose(4, 50)), (8, prose(4, 50))]
    kept = corpus_pipeline.near_copies(spark, frame(spark, rows), "")
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(5, a), (None, b), (7, prose(3, 50)), (8, prose(4, 50))], key=str)


def test_vectors_of_two_lengths(spark):
    rng = np.random.default_rng(5)
    rows = []
    for width, n in ((3, 40), (2, 30), (64, 200), (5, 1)):
        base = rng.standard_normal((n, width))
        base[n // 2 :] = base[: n - n // 2] + 0.05 * rng.standard_normal((n - n // 2, width)) if n > 1 else base[n // 2 :]
        rows += [(len(rows) + k, [float(x) for x in v]) for k, v in enumerate(base)]
    rows += [(9000, None), (9001, []), (9002, [0.0, 0.0]), (9003, [1.0, float("nan")]), (None, [1.0, 2.0])]
    got = {r.vec_id: r for r in itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    sound = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and i < 9000}
    links = {(a, b) for a in sound for b in sound if a != b and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= 0.9}
    exact = collections.Counter(a for a, _ in links)
    assert all(got[i].n_links <= exact[i] for i in sound)
    for width in (2, 3, 64):
        own = [i for i in sound if len(sound[i]) == width]
        assert sum(got[i].n_links for i in own) >= 0.9 * sum(exact[i] for i in own) > 0
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (9000, 9001, 9002, 9003))


@pytest.mark.parametrize("block", [4, 16])
def test_crowded_buckets_lose_no_link(spark, block):
    """Rows of 8 numbers are linked if 6 agree; two keys, one of them crowded with several groups."""
    rng = np.random.default_rng(block)
    rows = []
    for group in range(9):
        centre = rng.integers(0, 50, 8)
        for _ in range([60, 1, 2, 25, 1, 1, 7, 3, 40][group]):
            v = centre.copy()
            v[rng.integers(0, 8)] = rng.integers(0, 50)
            rows.append((len(rows), 1, v.astype(np.uint8).tobytes(), [0 if group < 8 else 1, int(rng.integers(0, 6))]))
    df = spark.createDataFrame(rows, "rep long, mult long, payload binary, codes array<int>")

    def decide(a, b):
        x, y = (np.stack([np.frombuffer(v, np.uint8) for v in p]) for p in (a, b))
        return (x[:, None] == y[None]).sum(axis=2) >= 6

    links = blocks.joined(df, decide, block=block)
    got = {r.node: r.component for r in graph.components(links.selectExpr("rep as a", "root as b")).collect()}
    parent = list(range(len(rows)))
    for i, (_, _, p, c) in enumerate(rows):
        for j in range(i):
            if any(x == y for x, y in zip(c, rows[j][3])) and decide([p], [rows[j][2]])[0, 0]:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if x == high else x for x in parent]
    assert all(got.get(i, i) == parent[i] for i in range(len(rows)))
    assert len(set(parent)) < len(rows) - 50


def test_one_template_costs_its_rows(spark):
    """Of n rows like their leader about n pairs are decided, not their square."""
    seen = spark.sparkContext.accumulator(0)

    def decide(a, b):
        seen.add(len(a) * len(b))
        return np.ones((len(a), len(b)), dtype=bool)

    df = spark.range(3000).selectExpr("id as rep", "1L as mult", "binary(cast(id as string)) as payload", "array(7) as codes")
    assert blocks.joined(df, decide, block=64).where("root = 0").select("rep").distinct().count() == 3000
    assert seen.value < 4 * 3000


def test_a_row_and_its_leader_meet_once(spark):
    """However many tables bring rows together, what is alike is sent and decided once."""
    seen = spark.sparkContext.accumulator(0)

    def decide(a, b):
        seen.add(len(a) + len(b))
        return np.ones((len(a), len(b)), dtype=bool)

    df = spark.range(300).selectExpr("id as rep", "1L as mult", "binary(cast(id as string)) as payload", "array_repeat(id div 3, 18) as codes")
    got = {(r.rep, r.root) for r in blocks.joined(df, decide).collect()}
    assert got == {(i, i - i % 3) for i in range(300)}
    assert seen.value == 300


def test_rows_apart_from_their_leader_meet_each_other(spark):
    """A leader unlike the rest of its buckets: the others are compared, also in buckets of three."""
    rows = [(0, b"x", [1, 5, 9]), (1, b"y", [1, 6, 8]), (2, b"y", [1, 7, 9]), (3, b"z", [2, 5, 8]), (4, b"z", [3, 5, 9]), (5, b"y", [4, 4, 9])]
    df = spark.createDataFrame([(i, 1, p, c) for i, p, c in rows], "rep long, mult long, payload binary, codes array<int>")
    links = blocks.joined(df, lambda a, b: np.array(a)[:, None] == np.array(b)[None, :])
    got = {r.node: r.component for r in graph.components(links.selectExpr("rep as a", "root as b")).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 3: 3, 4: 3}


def test_rows_that_are_surely_not_meant(spark):
    ids = spark.range(0, 30000, 3).selectExpr("id * 1000003 - 9000000 as i")
    df = spark.range(30000).selectExpr("id * 1000003 - 9000000 as `a.b`", "id % 3 = 0 as meant")
    got = maybe_among(df, "a.b", ids, "maybe")
    counts = {(r.meant, r.maybe): r["count"] for r in got.groupBy("meant", "maybe").count().collect()}
    assert counts[True, True] == 10000 and (True, False) not in counts
    assert counts.get((False, True), 0) < 100
    assert maybe_among(df, "a.b", ids.limit(0), "maybe").where("maybe").count() == 0


def moved(df, column):
    """Rows that the exchanges of a finished plan have written with this column."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        if kind == "ShuffleExchangeExec" and column in names:
            total += node.metrics().apply("shuffleRecordsWritten").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_texts_in_no_group_are_not_shuffled(spark):
    """Where no table of a join is small enough to be broadcast, only what may go is moved with its text."""
    rows = [(i, prose(i, 80)) for i in range(300)] + [(1000 + i, prose(i, 80)) for i in range(20)] + [(7, prose(7, 80))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_copies(spark, frame(spark, rows), "")
        n = moved(kept, "text")
        assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < n < 2 * 40


def test_texts_without_a_repeat_are_not_shuffled(spark):
    shared = prose(1, 120)
    rows = [(i, prose(100 + i, 80)) for i in range(300)] + [(1000 + i, f"{prose(500 + i, 60)} {shared}") for i in range(10)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = chunks.without_repeats(frame(spark, rows))
        n = moved(after, "text")
        assert sum(shared in r.text for r in after.collect()) == 1 and after.count() == 310
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < n < 40


def test_hub_of_a_component(spark):
    star = spark.range(1, 5000).selectExpr("id as a", "0L as b").unionByName(spark.range(5000, 5010).selectExpr("id as a", "id - 1 as b"))
    got = graph.components(star).collect()
    assert len(got) == 5010 and all(r.component == 0 for r in got)


def test_similar_groups_of_a_large_template(spark):
    base = prose(9, 200).split()
    rows = [(i, " ".join([*base[: 10 + i % 3], f"n{i}", *base[10 + i % 3 :]])) for i in range(700)]
    rows += [(1000 + i, prose(100 + i, 150)) for i in range(20)]
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame(spark, rows)).collect()}
    assert all(got[i] == 0 for i in range(700)) and all(got[1000 + i] == 1000 + i for i in range(20))
