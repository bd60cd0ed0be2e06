"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import pytest

pytest.importorskip("statloom.llm.queries")
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from statloom.llm import bpe, chunks, itq, licenses, packing, queries, simhash, sketch, subword, urlrules, warc  # noqa: E402

LONG = "alpha beta gamma delta " * 30_000
PROSE = " ".join(f"word{i} and{i % 7} thing{i % 11}" for i in range(60))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, PROSE),
    (4, PROSE),
    (4, PROSE),
    (5, PROSE + " tail"),
    (6, LONG),
    (7, "one"),
    (None, None),
    (8, "x" * 100_000),
    (9, "Ünïcode ẞ ≠ 👍 MIT License"),
]
# names that the operators use inside
CLASH = ["range", "rep", "fp", "start", "spans", "doc", "key", "n", "component_id", "sequence_id", "label", "_statloom_x"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    return frame.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASH], F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


ALL = ids({"doc_id": i} for i, _ in ROWS)


def test_simhash(docs, empty):
    got = simhash.groups(docs).collect()
    assert ids(got) == ALL
    component = {(r.doc_id, r.fp): r.component_id for r in got}
    assert {c for (i, f), c in component.items() if f == 0} == {1}  # NULL and blank texts are one group
    prose = [r.component_id for r in got if r.doc_id == 4 or (r.doc_id is None and r.fp != 0)]
    assert prose == [4, 4, 4]
    assert simhash.groups(empty).collect() == []


def test_similar_groups(docs, empty):
    got = simhash.similar_groups(docs).collect()
    assert ids(got) == [x for x in ALL if not x[0]]
    label = {r.doc_id: r.component_id for r in got}
    assert label[5] == 4 and label[1] == label[2] == label[3] == 1
    assert all(label[i] == i for i in (6, 7, 8, 9))
    assert simhash.similar_groups(empty).collect() == []


def test_repeats(docs, empty):
    got = {(r.doc_id, r.kept): r for r in chunks.repeats(docs).collect()}
    assert set(got) == {(4, True), (5, False), (None, False)}  # a copy without an id is one as well
    assert got[5, False].first_doc == 4 and got[5, False].words >= 150
    assert chunks.repeats(empty).collect() == []


def test_without_repeats(docs, empty):
    out = chunks.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    gone = [(i, t) for i, t in ROWS if i is None and t == PROSE]  # held by document 4, every word
    assert ids(rows) == ids({"doc_id": i} for i, t in ROWS if (i, t) not in gone) and len(gone) == 1
    assert texts[1] is None and texts[4] == PROSE and texts[6] == LONG
    assert 0 < len(texts[5]) < 200 and "tail" in texts[5]
    assert chunks.without_repeats(empty).collect() == []


def test_copies_of_a_whole_text_leave_one_row(spark):
    frame = spark.createDataFrame([(2, PROSE), (1, PROSE), (3, PROSE)], "doc_id long, text string")
    assert [(r.doc_id, r.text) for r in chunks.without_repeats(frame).collect()] == [(1, PROSE)]


def test_packing(docs, empty):
    got = packing.pack(docs, queries.vocabulary_path()).collect()
    tokens = {i: n for i, n in ((r.doc_id, r.doc_tokens) for r in got) if i is not None}
    assert tokens[1] == tokens[2] == tokens[3] == 1 and tokens[6] == 120_001
    assert sum(r.length for r in got if r.doc_id == 4) == 2 * tokens[4]
    assert {len(bytes(r.ids)) == 4 * r.length for r in got} == {True}
    assert packing.pack(empty, queries.vocabulary_path()).collect() == []


def test_licenses(docs, empty):
    got = licenses.scan(docs).collect()
    assert ids(got) == ALL
    row = next(r for r in got if r.doc_id == 9)
    assert (row.base_labels, row.n_base, row.first_word) == ("mit", 1, row.n_words - 2) and "mit" in row.labels.split(",")
    blank = next(r for r in got if r.doc_id == 1)
    assert (blank.n_words, blank.n_base, blank.first_word, blank.labels, blank.score) == (0, 0, None, "", 0.0)
    assert licenses.scan(empty).collect() == []


def test_url_rules(spark):
    urls = [
        (1, None, "org"),
        (2, "no scheme", ""),
        (3, "http://Example.ORG/es/x?y#z", "example.org/es/"),
        (3, "http://Example.ORG/es/x?y#z", "example.org/es/"),
        (4, "https://a.b.example.org/en/1#", "example.org/en/1"),
        (5, "http://notexample.org/es/", "org/"),
        (6, "http://org", None),
        (None, "http://x.com/fr/", "com/fr/"),
        (7, "://com/de/?", "com/de/"),
        (8, "http://examplecom/de/", None),
        (9, "http://" + "a." * 20_000 + "com/de/", "com/de/"),
        (10, "", None),
        (11, "ftp://x\n.org/a\nb", "org/"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "s") for i, u, _ in urls], "page_id long, url string, host string, sort string")
    rules = spark.createDataFrame(urlrules.RULES + [("block", None, "/"), ("allow", "org", "/")], urlrules.RULE_SCHEMA)
    for ranges in (1, 7):
        got = urlrules.judge(pages, rules, ranges=ranges).collect()
        want = sorted(str((i, None if r in ("org", "") else r)) for i, _, r in urls)
        assert sorted(str((r.page_id, r.rule)) for r in got) == want
        first = next(r for r in got if r.page_id == 1)
        assert (first.host, first.path, first.verdict) == ("", "", "allow")
        assert next(r for r in got if r.page_id == 11).path == "/a\nb"
    assert urlrules.judge(pages.limit(0), rules).collect() == []
    none = urlrules.judge(pages, rules.limit(0), default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")} and len(none) == len(urls)


def test_many_nested_rules_against_brute_force(spark):
    import random

    rng = random.Random(2)
    labels = ["a", "b", "c", "ab"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(400)]
    rules = [(rng.choice(["allow", "block"]), rng.choice(["", *hosts[:60]]), "/" + "x" * rng.randint(0, 3)) for _ in range(80)]
    pages = [(i, f"http://{h}/{'x' * rng.randint(0, 4)}") for i, h in enumerate(hosts)]
    got = urlrules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, urlrules.RULE_SCHEMA), ranges=9).collect()
    by_id = {r.page_id: r for r in got}
    for i, url in pages:
        host, _, path = url[7:].partition("/")
        fits = [
            (len(h) + len(p), len(p), v, h + p)
            for v, h, p in rules
            if (h == "" or host == h or host.endswith("." + h)) and ("/" + path).startswith(p)
        ]
        best = max(fits, default=None)
        assert by_id[i].verdict == (best[2] if best else "allow")
        assert (by_id[i].rule is None) == (best is None) and (best is None or len(by_id[i].rule) == best[0])


def test_embeddings(spark):
    one, other = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [
        (1, one), (2, [2.0, 0.0, 1.0]), (3, one), (3, one), (4, other), (5, None), (6, [0.0, 0.0, 0.0]), (7, []),
        (8, [1.0, None, 0.5]), (9, [float("nan"), 0.0, 0.0]), (10, [float("inf"), 0.0, 0.0]), (11, [1.0, 0.0]), (None, one),
    ]
    for kind in ("float", "double"):
        frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("rep", F.lit("x")).withColumn("digest", F.lit(1))
        got = itq.near_duplicates(frame).collect()
        assert len(got) == len(rows)
        links = sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in got)
        expected = {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False)}
        for (null, i), n, component, kept in links:
            assert (n, component, kept) == ((0, None, False) if null else expected.get(i, (0, i, True))), i
        assert itq.near_duplicates(frame.limit(0)).collect() == []
        assert itq.near_duplicates(frame.where("vec_id = 6")).collect()[0].n_links == 0


def test_quality(spark, docs, empty):
    good = [(i, " ".join(f"fine{j % 50} plain{(i * j) % 40} words" for j in range(40)), 1) for i in range(100, 160)]
    bad = [(i, " ".join(f"bad{(i * j) % 60}%%% $$$" for j in range(40)), 0) for i in range(200, 260)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(100, 0, 0), (None, 1, 0), (101, None, 0), (9999, 1, 0)], "doc_id long, quality int, label int")
    model = subword.fit(frame, labels)
    got = {r.doc_id: r for r in subword.scored(frame, model).collect()}
    assert all(got[i].predicted == q for i, _, q in good + bad if i != 100)
    odd = subword.scored(docs, model).collect()
    assert ids(odd) == ALL and len({r.score for r in odd if r.doc_id in (1, 2, 3)}) == 1
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in odd)
    assert subword.scored(empty, model).collect() == []
    nothing = subword.fit(empty, labels)
    assert {r.score for r in subword.scored(frame, nothing).collect()} == {0.5}


def test_sketch(docs, empty, spark):
    for ranges in (1, 5):
        got = sketch.compared_with_next(docs, ranges=ranges).collect()
        assert ids(got) == ALL
        blank = next(r for r in got if r.doc_id == 1)
        assert (blank.n_chars, blank.fingerprint) == (0, "")
        copies = [r for r in got if r.doc_id == 4]
        assert len({r.fingerprint for r in copies}) == 1 and max(r.near_next for r in copies) == 1.0
    alone = sketch.compared_with_next(docs.where("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert sketch.compared_with_next(empty).collect() == []
    assert sketch.fingerprints(empty).collect() == [] and len(sketch.fingerprints(docs).collect()) == len(ROWS)


def test_warc(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (2, "u", "same"), (None, "v", "same"), (3, "http://x/\r\nEvil: 1", None), (4, "", ""), (5, "w", "é" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("d")).withColumn("payload", F.lit(0))
    got = warc.round_trip(pages, payloads=True).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted(
        [("1", "revisit", 2, 4), ("2", "response", None, 4), ("2", "response", None, 4), ("None", "revisit", 2, 4),
         ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 400_000)]
    )
    assert bytes(next(r.payload for r in got if r.page_id == 5)).decode() == "é" * 200_000
    large = warc.round_trip(pages, min_bytes=5).collect()
    assert {r.record_type for r in large} == {"response"}
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_bpe(docs, empty):
    got = bpe.digests(docs, queries.vocabulary_path()).collect()
    assert ids(got) == ALL
    blank = {(r.n_tokens, r.ids_sha256) for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1 and next(iter(blank))[0] == 0
    whole = {r.doc_id: r.ids for r in bpe.encode(docs, queries.vocabulary_path()).collect()}
    assert len(whole[6]) == 120_000
    assert bpe.digests(empty, queries.vocabulary_path()).collect() == []


def test_pipeline_stages_on_odd_rows(docs, empty, sf, spark):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, empty):
            out = stage(spark, frame, sf)
            rows = out.collect()
            if name != "packing":
                assert out.columns == frame.columns
            assert len(rows) >= 0 and (frame is docs or rows == [])
    kept = corpus_pipeline.near_copies(spark, docs, sf).select("doc_id").collect()
    # the rows without an id are copies of documents 1 and 4
    assert ids(kept) == [(False, i) for i in (1, 4, 6, 7, 8, 9)]
