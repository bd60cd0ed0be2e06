"""Quality rules and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("statloom.llm.queries")
from oracle_compare import connect  # noqa: E402

from statloom.llm import ngramrules, queries, runs  # noqa: E402
from statloom.llm.tokens import words  # noqa: E402


@pytest.fixture(scope="module")
def texts(sf):
    return dict(connect(sf).sql("select doc_id, text from documents order by doc_id").fetchall())


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(w, least=12):
    """Every period on its own: stretches of words equal to the one a period on."""
    best = {}
    for p in range(1, len(w)):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            length = i + p - s
            if i > s and length >= max(least, 2 * p):
                best.setdefault((s, length), p)
            i = max(i, s + 1)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def collapsed(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_texts(least):
    rng = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(0, 5)):
            w = [rng.choice("abcde"[: rng.randint(1, 5)]) for _ in range(rng.randint(0, 70))]
            if w and rng.random() < 0.6:
                a, p = rng.randrange(len(w)), rng.randint(1, 12)
                w = [w[i if i < a else a + (i - a) % min(p, len(w) - a)] for i in range(len(w))]
            docs.append(w)
        table = words(pa.array([" ".join(d).encode() for d in docs], pa.binary()))
        found, begins = runs.runs_of(table, least), table.bounds
        for k, d in enumerate(docs):
            own = [(s - begins[k], n, p) for s, n, p in found.tolist() if begins[k] <= s < begins[k + 1]]
            assert own == plain_runs(d, least)


def test_runs_query(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert set(got) == set(texts)
    several = 0
    for i, text in texts.items():
        w = planted(i, plain_words(text))
        if len(w) > 2500 and zlib.crc32(str(i).encode()) % 10:
            continue  # brute force takes the square of a text's words
        found, row = plain_runs(w), got[i]
        several += len(found) > 1
        assert row.n_runs == len(found)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == want
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
    assert several


def test_runs_edges(spark):
    unit = "x y z"
    many = " ".join(f"{unit} {unit} {unit} {unit} w{i}" for i in range(300))
    rows = [(1, None), (1, ""), (None, "\t a " * 20), (2, "a " * 11), (2, "a " * 11), (3, "b " * 100000), (4, "é " * 12 + "ü"), (5, many), (6, "A a " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as collapsed", "3 as h")
    got = runs.periodic_runs(df).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append([(x.start, x.length, x.period) for x in r.runs])
    assert by[1] == [[], []] and by[None] == [[(0, 20, 1)]] and by[2] == [[], []] and by[3] == [[(0, 100000, 1)]]
    assert by[4] == [[(0, 12, 1)]] and by[6] == [[(0, 12, 2)]]
    assert by[5] == [plain_runs(many.split())] and len(by[5][0]) == 300
    assert {r.collapsed for r in got if r.doc_id == 4} == {"é ü"}
    assert runs.periodic_runs(df.limit(0)).collect() == []
    assert queries.with_period(df).count() == len(rows)


def test_period_planting(spark, sf, texts):
    got = {r.doc_id: r.text for r in queries.with_period(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    changed = [i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0]
    assert changed and all(plain_words(got[i]) == planted(i, plain_words(texts[i])) for i in texts)


def plain_rules(text):
    w = plain_words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if plain_words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(w) < 50 or 100 * len(inside) > 50 * len(w),
    }


def slow_score(text, ratios):
    """The mean log ratio, one n-gram after the other."""
    import xxhash

    mask, total, n, before = 2**64 - 1, 0.0, 0, None
    for word in plain_words(text):
        h = xxhash.xxh3_64_intdigest(word.encode())
        mixed = [h * 0x9E3779B97F4A7C15 & mask]
        if before is not None:
            pair = ((before * 0xC2B2AE3D27D4EB4F & mask) ^ (before >> 29)) + h & mask
            mixed.append(pair * 0x9E3779B97F4A7C15 & mask)
        total, n, before = total + sum(ratios[m >> 48] for m in mixed), n + len(mixed), h
    return total / n if n else 0.0


def test_rules_query(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op11_quality_rules(spark, sf).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        want = plain_rules(text)
        assert {k: got[i][k] for k in want} == want
        assert got[i].kept == (not want["base_failed"] and got[i].score >= ngramrules.LEAST)
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ratios = ngramrules.fit(documents, labels)
    for i in list(texts)[:60]:
        assert got[i].score == pytest.approx(slow_score(texts[i], ratios), abs=1e-9)


def test_rules_counts_are_of_all_texts(spark, sf, texts, monkeypatch):
    """Trusted and raw counts by brute force, with the broadcast and with the join."""
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    raw, target = np.zeros(ngramrules.BUCKETS), np.zeros(ngramrules.BUCKETS)
    for i, text in texts.items():
        bucket, _ = ngramrules.grams(words(pa.array([text.encode()], pa.binary())))
        np.add.at(raw, bucket, 1)
        np.add.at(target, bucket, i in good)
    want = ngramrules.log_ratios(target, raw)
    assert np.array_equal(ngramrules.fit(documents, labels), want)
    monkeypatch.setattr(ngramrules, "TRUSTED_BYTES", 0)
    assert np.array_equal(ngramrules.fit(documents, labels), want)


def test_rules_part_good_from_bad(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op11_quality_rules(spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    right = [r.kept == bool(labels[r.doc_id]) for r in rows]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_rules_edges(spark):
    rows = [(1, None), (1, ""), (None, "a b c " * 40), (2, " \n\t\n"), (3, "x\n" * 5000), (4, "ä# ß|\nä# ß|"), (5, " ".join(f"w{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "true as trusted", "1 as kept", "2 as bucket")
    labels = spark.createDataFrame([(5, 1), (5, 1), (None, 1), (1, 0), (1, 1), (9, 1)], "doc_id long, quality int")
    ratios = ngramrules.fit(df, labels)
    got = sorted(ngramrules.judged(df, ratios).collect(), key=str)
    assert len(got) == len(rows)
    for r in got:
        assert any(plain_rules(t) == {k: r[k] for k in plain_rules(t)} for i, t in rows if i == r.doc_id)
    assert [r.kept for r in got if r.doc_id == 5] == [True]
    assert not ngramrules.fit(df, labels.limit(0)).any() and not ngramrules.fit(df.limit(0), labels).any()
    assert ngramrules.judged(df.limit(0), ratios).collect() == []
