"""The ten queries against brute force, round trips, the tokenizers library and held-out labels."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

pytest.importorskip("statloom.llm.queries")
from oracle_compare import compare, connect  # noqa: E402

from statloom.llm import queries  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("select doc_id, text from documents order by doc_id").fetchall())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def result(spark, sf, name, key="doc_id"):
    frame = queries.QUERIES[name](spark, sf).toPandas()
    return frame.set_index(key, drop=False) if key else frame


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))


def plain_shingles(text, k):
    w = plain_words(text)
    if not w:
        return []
    return [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)]


def plain_fingerprint(text):
    s = plain_shingles(text, 3)
    votes = collections.Counter(b for x in s for b in range(64) if xxhash.xxh64_intdigest(x, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(s))


def plain_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_simhash(spark, sf, texts):
    got = result(spark, sf, "op1_simhash")
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert set(got.index) == set(texts)
    assert {i: got.fingerprint[i] for i in texts} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(texts)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert near
    assert {i: got.component_id[i] for i in ids} == plain_components(ids, near)


def test_substring_dedup(spark, sf, texts):
    got = result(spark, sf, "op2_substring_dedup", None)
    size = 12
    holders = collections.defaultdict(set)
    for i, t in texts.items():
        w = plain_words(t)
        for k in range(len(w) - size + 1):
            holders[tuple(w[k : k + size])].add(i)
    for row in got.itertuples():  # whatever is reported does repeat across documents
        span = texts[row.doc_id].encode()[row.start : row.start + row.length]
        w = plain_words(span.decode())
        assert len(w) == row.words >= 24
        assert all(len(holders[tuple(w[k : k + size])]) > 1 for k in range(0, len(w) - size + 1, size))
        assert row.kept == (row.doc_id == row.first_doc) and row.first_doc <= row.doc_id
    longest = {}
    for i, t in texts.items():
        w = plain_words(t)
        flags = [len(holders[tuple(w[k : k + size])]) > 1 and len(set(w[k : k + size])) > 6 for k in range(len(w) - size + 1)]
        runs = [len(r) for r in "".join("x" if f else " " for f in flags).split()]
        longest[i] = max(runs, default=0) + size - 1 if runs else 0
    holding = {i for i, n in longest.items() if n >= 60}
    assert holding and holding <= set(got.doc_id)


def test_packing(spark, sf, texts, library):
    got = result(spark, sf, "op3_packing", None)
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4") for i, t in texts.items()}
    assert set(got.doc_id) == set(ids)
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        at = 0
        for p in pieces.itertuples():
            assert p.start == at and p.doc_tokens == len(ids[doc])
            assert p.ids_crc32 == zlib.crc32(ids[doc][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[doc])
    fills = []
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        at = 0
        for p in pieces.itertuples():
            assert p.offset == at
            at += p.length
        assert at <= 4096
        fills.append(at)
    assert len(fills) <= -(-sum(fills) // 4096) + 2


def test_license_scan(spark, sf, texts):
    got = result(spark, sf, "op4_license_scan")
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        places = [
            (k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()
        ]
        row = got.loc[i]
        assert (row.n_words, row.n_base) == (len(w), len(places))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(row.labels.split(","))
        if places:
            assert (row.first_word, row.last_word) == (min(places)[0], max(places)[0])
        assert 0 <= row.score <= 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, sf, con, name):
    assert compare(queries.QUERIES[name](spark, sf), con, queries.ORACLE[name]) == []


def test_embeddings(spark, sf, con):
    got = result(spark, sf, "op6_embedding_dedup", "vec_id")
    rows = con.sql("select vec_id, embedding from embeddings order by vec_id").fetchall()
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    exact = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = got.n_links[[r[0] for r in rows]].to_numpy()
    assert (found <= exact).all() and found.sum() >= 0.9 * exact.sum()
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_quality(spark, sf, con):
    got = result(spark, sf, "op7_quality")
    labels = dict(con.sql("select doc_id, quality from labels").fetchall())
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    unseen = [i for i in got.index if got.held_out[i] and i in labels]
    assert len(unseen) > 10 and np.mean([got.predicted[i] == labels[i] for i in unseen]) >= 0.9


def test_sketch(spark, sf, texts):
    got = result(spark, sf, "op8_sketch")
    ids = sorted(texts, reverse=True)
    errors = []
    for k, i in enumerate(ids):
        own, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        row = got.loc[i]
        assert row.n_chars == len(own) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((row.near_edited, edited), (row.near_next, after)):
            a, b = set(plain_shingles(own, 5)), set(plain_shingles(other, 5))
            if len(a | b) >= 200:
                errors.append(abs(near - len(a & b) / len(a | b)))
    assert np.mean(errors) < 0.03 and max(errors) < 0.25
    by_text = {}
    for i, t in texts.items():
        assert by_text.setdefault(t, got.fingerprint[i]) == got.fingerprint[i]


def test_bpe(spark, sf, texts, library):
    got = result(spark, sf, "op10_bpe")
    assert set(got.index) == set(texts)
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        row = got.loc[i]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
