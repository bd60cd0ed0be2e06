"""Collocations against brute force, and the double array against a dictionary."""

import collections
import random
import re

import numpy as np
import pytest

pytest.importorskip("statloom.llm.queries")
from statloom.llm import collocations as c  # noqa: E402
from statloom.llm.doublearray import build  # noqa: E402


def plain(rows, least, top):
    """``rows(lang, text)``: counts of all windows, every cut, every longer phrase."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = collections.defaultdict(int)
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    for (lang, w), a in candidates.items():
        if 100 * inside[lang, w] >= 100 * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        found[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, all_of in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(all_of)[:top], 1)
    )


@pytest.mark.parametrize(("least", "top", "most"), [(20, 2000, 1 << 18), (8, 30, 1 << 18), (8, 2000, 40)])
def test_documents(spark, sf, least, top, most):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    got = c.collocations(documents, least=least, top=top, most=most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain([(r.lang, r.text) for r in documents.collect()], least, top)
    assert len(want) > 30 and sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    rng = random.Random(3)
    rows = [
        (None, "new york. NEW York; new\tyork\x0bnew " * 5),
        ("und", "new york city"),
        ("de", None),
        ("de", ""),
        ("", "a b a b a b a b"),
        ("é", "ä ß ü ä ß ü ä ß ü Ä"),
        ("de", " ".join(rng.choice("abc") for _ in range(30000))),
        ("de", "x " * 4000),
        ("de", "same line here\n" * 50),
    ]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as phrase", "2 as f", "3 as word")
    for least in (1, 3, 300):
        assert sorted(map(tuple, c.collocations(df, least=least).collect())) == plain(rows, least, 2000)
    assert c.collocations(df.limit(0)).collect() == []
    one = spark.createDataFrame([("en", "alone")], "lang string, text string")
    assert c.collocations(one, least=1).collect() == []


def test_products_beyond_64_bits(spark):
    """The score's product of 1000, a and n passes 64 bits; counts come as tables here."""
    a, n, left, right = 99_999_999_999, 10**13 + 7, 3_333_333_333, 10**12 + 9
    frame = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert frame.selectExpr(f"{c.SCORE} as s").first().s == 1000 * a * n // (left * right)


@pytest.mark.parametrize("seed", range(6))
def test_double_array(seed):
    rng = np.random.default_rng(seed)
    symbols, n = [3, 50, 254, 2, 200, 7][seed], [30, 400, 3000, 1, 2000, 0][seed]
    rows = {tuple(rng.integers(0, symbols, rng.integers(1, 7)).tolist()) for _ in range(n)}
    listed = sorted(rows, key=lambda r: hash((seed, r)))
    paths = np.full((len(listed), 6), -1, dtype=np.int64)
    for i, r in enumerate(listed):
        paths[i, : len(r)] = r
    trie = build(paths)
    tried = [*listed, *(tuple(rng.integers(-1, symbols + 2, rng.integers(1, 7)).tolist()) for _ in range(500))]
    known = {r: i for i, r in enumerate(listed)}
    prefixes = {r[:k] for r in listed for k in range(1, len(r) + 1)}
    state = np.zeros(len(tried), dtype=np.int64)
    for k in range(6):
        symbol = np.array([r[k] if k < len(r) else -1 for r in tried])
        state = np.where(state >= 0, trie.step(np.maximum(state, 0), symbol), -1)
        for r, s in zip(tried, state.tolist()):
            if len(r) > k:
                assert (s >= 0) == (r[: k + 1] in prefixes and min(r[: k + 1]) >= 0)
                if s >= 0:
                    assert trie.accept[s] == known.get(r[: k + 1], -1)
    live = trie.check[trie.check >= 0]
    assert len(live) == len(prefixes)
