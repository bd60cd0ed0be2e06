"""The pipeline against plain versions of its stages."""

import collections
import re

import pyarrow as pa
import pytest

pytest.importorskip("statloom.llm.queries")
import corpus_pipeline  # noqa: E402
from statloom.llm import bpe, packing, queries, simhash, subword  # noqa: E402
from statloom.llm.common import BATCH_KEY, arrow_rows, batches_of, read  # noqa: E402


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs = read(spark, sf, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def test_columns(stages):
    for _, docs in stages[1:-1]:
        assert docs.dtypes == stages[0][1].dtypes


def test_quality_stage(stages, spark, sf):
    before, after = stages[0][1], stages[1][1]
    scores = queries.QUERIES["op7_quality"](spark, sf).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.predicted}
    labels = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    kept = {r.doc_id for r in after.collect()}
    here = {r.doc_id for r in before.collect()}
    assert all(i in kept for i, q in labels.items() if q == 1 and i in here)
    assert sum(i in kept for i, q in labels.items() if q == 0 and i in here) <= 0.1 * sum(q == 0 for q in labels.values())


def test_near_copies_stage(stages):
    texts = {r.doc_id: r.text for r in stages[1][1].collect()}
    kept = {r.doc_id for r in stages[2][1].collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    likeness = {}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for group in holders.values():
        for k, a in enumerate(group):
            for b in group[:k]:
                likeness[a, b] = likeness.get((a, b), 0) + 1
    likeness = {p: n / len(sets[p[0]] | sets[p[1]]) for p, n in likeness.items()}
    alike = [p for p, j in likeness.items() if j >= 0.85]
    assert alike and not any(a in kept and b in kept for a, b in alike)
    # whoever goes is like some other document
    near = collections.defaultdict(float)
    for (a, b), j in likeness.items():
        near[a], near[b] = max(near[a], j), max(near[b], j)
    assert all(near[i] >= 0.65 for i in set(texts) - kept)


def test_passages_stage(stages):
    before = {r.doc_id: r.text for r in stages[2][1].collect()}
    after = {r.doc_id: r.text for r in stages[3][1].collect()}
    size = 60
    holders = collections.defaultdict(set)
    for i, t in after.items():
        w = t.lower().split()
        for k in range(len(w) - size + 1):
            run = tuple(w[k : k + size])
            if len(set(run)) > 20:
                holders[run].add(i)
    assert not any(len(h) > 1 for h in holders.values())
    for i, t in after.items():  # nothing is added, and what goes stands in another document
        if t != before[i]:
            assert len(t) < len(before[i])
        for line in re.findall(r"\S+", t)[:5]:
            assert line in before[i]


def test_run_is_the_last_stage(stages, spark, sf):
    from_run = corpus_pipeline.run(spark, sf)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    key = lambda df: sorted(map(tuple, df.select("doc_id", "doc_tokens").distinct().collect()))
    assert key(from_run) == key(stages[-1][1])
    assert set(columns) <= set(from_run.columns)
    assert {r.doc_id for r in from_run.collect()} == {r.doc_id for r in stages[3][1].collect()}


def test_threshold_in_bits():
    assert 38 <= simhash.angle_bits(0.8, 256) <= 40
    assert subword.KEEP == 0.7


def altered(rng, words, low, high):
    """Copies of a text: its tail cut, foreign text behind it, and single words changed, with their likeness in the given range."""
    own = shingles(" ".join(words))
    likeness = lambda w: len(own & (s := shingles(" ".join(w)))) / len(own | s)
    fresh = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    scattered = list(words)
    for _ in words:
        if likeness(scattered) < high:
            break
        scattered[rng.randrange(len(words))] = fresh(1)[0]
    cut = next(words[: len(words) - k] for k in range(len(words)) if likeness(words[: len(words) - k]) < high)
    tail = fresh(len(words))
    longer = next(words + tail[:k] for k in range(len(words)) if likeness(words + tail[:k]) < high)
    return [w for w in (cut, longer, scattered) if low <= likeness(w) < high]


def paired(spark, low, high):
    """For copies in the range of likeness, each of one document: whether they hang together with it."""
    import random

    rng = random.Random(11)
    rows, owner = [], {}
    for i in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 600))]
        rows.append((i, " ".join(words)))
        for w in altered(rng, words, low, high):
            owner[10**6 + len(owner)] = i
            rows.append((10**6 + len(owner) - 1, " ".join(w)))
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[copy] == i for copy, i in owner.items()]


def test_cut_and_extended_copies_are_near_copies(spark):
    linked = paired(spark, 0.8, 0.84)
    assert len(linked) > 350 and all(linked)


def test_texts_below_the_threshold_stay(spark):
    for low, high in ((0.72, 0.8), (0.64, 0.7)):
        linked = paired(spark, low, high)
        assert len(linked) > 350 and not any(linked)


def test_whoever_goes_is_alike_by_the_threshold(stages):
    texts = {r.doc_id: r.text for r in stages[1][1].collect()}
    kept = {r.doc_id for r in stages[2][1].collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    gone = set(texts) - kept
    assert gone
    for i in gone:
        assert any(len(sets[i] & s) / len(sets[i] | s) >= 0.8 for k, s in sets.items() if k != i)


def test_fingerprints_within_two_bits_meet_by_the_ring(spark):
    """Without any other table all pairs alike whose fingerprints are within two bits hang together, no others."""
    import random

    rng = random.Random(4)
    rows = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(200, 600))]
        for n in (0, 1, 1, 2, 30):  # words changed at the end
            rows.append((len(rows), " ".join([*words[: len(words) - n], *[f"x{rng.randrange(10**9)}" for _ in range(n)]])))
    sets = [simhash.shingle_set(t.encode(), 5) for _, t in rows]
    prints = [simhash.majority(s) for s in sets]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]}):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if x == high else x for x in parent]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame, tables=0).collect()}
    assert [got[i] for i in range(len(rows))] == parent
    assert 0 < sum(parent[i] != i for i in range(len(rows))) < 4 * 60


def test_workers_give_the_vocabulary_back(spark):
    """A worker that has tokenised doesn't hold the tables beside the next stage's work."""
    docs = spark.range(64).selectExpr("id as doc_id", "'some words of a text' as text").repartition(8)
    assert packing.pack(docs, queries.vocabulary_path()).count() == 64

    def step(batch):
        return {"doc_id": batch.column("doc_id"), "kept": [len(bpe._LOADED)] * batch.num_rows}

    kept = [r.kept for r in arrow_rows(docs, "doc_id long, kept int", step, "text").collect()]
    assert kept == [0] * 64


def test_passages_are_cut_out_once(spark, sf):
    """One worker per task: run for the filter as well, the function would take two, which stay for the next stage."""
    out = corpus_pipeline.repeated_passages(spark, read(spark, sf, "documents"), sf)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    docs = spark.range(0, 512, 1, 1).selectExpr("id as doc_id", "repeat('word ', 4000) as text")  # 10 MB in a task

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    def sizes():
        return docs.mapInArrow(run, "n long, size long").collect()

    assert len(sizes()) == 1 and spark.conf.get(BATCH_KEY, None) is None
    with batches_of(spark, 1 << 20):
        got = sizes()
    assert sum(r.n for r in got) == 512 and max(r.size for r in got) <= 2 << 20
    with pytest.raises(ZeroDivisionError), batches_of(spark, 1 << 20):
        1 / 0  # noqa: B018
    assert spark.conf.get(BATCH_KEY, None) is None and len(sizes()) == 1


def test_packing_is_sent_small_batches(spark, monkeypatch):
    sent = []
    settle = packing.settle
    monkeypatch.setattr(packing, "settle", lambda df, label: sent.append(spark.conf.get(BATCH_KEY, None)) or settle(df, label))
    docs = spark.range(8).selectExpr("id as doc_id", "'some words of a text' as text")
    assert packing.pack(docs, queries.vocabulary_path()).count() == 8
    assert sent == [str(packing.BATCH)] and spark.conf.get(BATCH_KEY, None) is None
