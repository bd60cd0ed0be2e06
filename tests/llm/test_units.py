"""Parts of the operators against slow and plain versions of themselves."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("statloom.llm.queries")
from statloom.llm import blocks, bpe, chunks, itq, licenses, packing, queries, simhash, sketch, subword, warc  # noqa: E402
from statloom.llm.graph import components  # noqa: E402


@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.vocabulary_path(), "rb") as f:
        return bpe.Bpe(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def test_bpe_on_every_code_point(vocabulary, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + chr(c) + "b1" + chr(c) + chr(c) + " " + chr(c) for c in points]
    flat, counts = vocabulary.encode(texts)
    ends = np.cumsum(counts)
    for at in range(0, len(texts), 50_000):
        some = library.encode_batch(texts[at : at + 50_000], add_special_tokens=False)
        for k, encoding in enumerate(some, at):
            assert encoding.ids == flat[ends[k] - counts[k] : ends[k]].tolist(), hex(points[k])


ODD = [
    "",
    " \n\t ",
    "Hello world's it's they're don't we'll 'sab ''s !'s 's's I'd'm 123 a1b2",
    "<|endoftext|>x<|ENDOFTEXT|> <|startoftext|><|endoftext|>",
    "ΟΔΥΣΣΕΥΣ ΣΑΣ İstanbul é é ﬁ ½²³ \x1c\x1d x\x85y",
    "日本語テキスト 한국어 👍🏽 👍",
    "' x' 're 'r 'v x've''ve",
    "a" * 500 + " " + "ab" * 300 + "é" * 100,
]


@pytest.mark.parametrize("text", ODD)
def test_bpe_on_odd_texts(vocabulary, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert vocabulary.encode([text])[0].tolist() == ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_batch_is_the_same_as_single_texts(vocabulary):
    flat, counts = vocabulary.encode(ODD)
    singles = [vocabulary.encode([t])[0] for t in ODD]
    assert counts.tolist() == [len(s) for s in singles]
    assert flat.tolist() == np.concatenate(singles).tolist()


def test_bpe_long_text_is_cut_between_words(vocabulary):
    text = "lorem ipsum, " * 150_000
    once = vocabulary.encode(["lorem ipsum, "])[0].tolist()
    assert vocabulary.encode([text])[0].tolist() == once * 150_000


def test_bpe_long_words_merge_alike(vocabulary):
    rng = random.Random(1)
    for _ in range(200):
        word = bytes(rng.choice(b"etaoinshrdlu\xc3\xa9") for _ in range(rng.randint(1, bpe.SHORT)))
        assert vocabulary.merge_short([word])[0].tolist() == vocabulary.merge_long(word).tolist()


def test_bpe_forgets_words_without_a_change(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 50)
    texts = [" ".join(f"word{i * j}" for j in range(40)) for i in range(30)]
    assert vocabulary.encode(texts)[0].tolist() == np.concatenate([vocabulary.encode([t])[0] for t in texts]).tolist()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    edges += [(2000, i) for i in range(2001, 2300)]
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert {r.node: r.component for r in got} == label and len(got) == len(label)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("crowd", [0, 1, 64, 10_000])
def test_links_join_all_near_pairs(spark, crowd):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(20)]
    values = set(centres)
    for c in centres:
        for _ in range(30):
            values.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    values = sorted(simhash.signed(v) for v in values)
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), crowd=crowd).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in got)

    def groups(pairs):
        label = {v: v for v in values}
        for _ in range(30):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert groups(near) == groups([(r.a, r.b) for r in got])


@pytest.mark.parametrize("block", [4, 512])
def test_blocks_count_every_pair_once(spark, block):
    rng = np.random.default_rng(5)
    points = rng.integers(0, 30, 300)
    rows = [(i, 1 + i % 3, bytes([int(p)]), [int(p) // 7, 0, int(p) // 5]) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "rep long, mult long, payload binary, codes array<int>")
    got = blocks.linked(frame, lambda a, b: a[:, 0][:, None] == b[:, 0][None, :], block=block).toPandas()
    counts = got.groupby("rep").n.sum().to_dict()
    for i, p in enumerate(points):
        assert counts.get(i, 0) == sum(1 + j % 3 for j, q in enumerate(points) if q == p and j != i)
    assert ((points[got["rep"]] == points[got["root"]]) & (got["root"] <= got["rep"])).all()


def test_cuts_resist_insertions():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(3000)]
    text = " ".join(words).encode()
    moved = b"some other beginning, quite long. " + text[:9000] + b" inserted words here " + text[9000:]

    def pieces(t):
        starts, ends, n = chunks.cuts(np.frombuffer(t, dtype=np.uint8))
        assert starts[0] == 0 and ends[-1] == len(t) and (starts[1:] == ends[:-1]).all()
        assert n.sum() == len(t.split()) and n.max() <= chunks.MOST + 1
        return [t[a:b] for a, b in zip(starts, ends)]

    a, b = pieces(text), pieces(moved)
    assert len(set(a) - set(b)) <= 4 and len(a) > 300


@pytest.mark.parametrize("text", [b"", b"   ", b"one", b"x" * 5000, "ü".encode() * 3000, b"und " * 4000, b"\n\nword \t"])
def test_cuts_of_odd_texts(text):
    starts, ends, n = chunks.cuts(np.frombuffer(text, dtype=np.uint8))
    assert b"".join(text[a:b] for a, b in zip(starts, ends)) == text and n.sum() == len(text.split())
    for a in starts:
        assert not a or text[a] & 0xC0 != 0x80


def test_cut_out():
    assert chunks.cut_out(b"abcdefgh", [(5, 2), (0, 2), (1, 2)]) == b"deh"
    assert chunks.cut_out(b"abc", []) == b"abc"


def test_windows_hold_every_token_once():
    rng = random.Random(7)
    state = packing.Windows(100, 4, 8)
    taken = {}
    for _ in range(500):
        length = rng.choice([1, 3, 60, 99, 100, 101, 250, rng.randint(1, 400)])
        at = 0
        for start, size, window, offset in state.place(length):
            assert start == at and size > 0 and taken.get(window, 0) == offset
            at += size
            taken[window] = offset + size
            assert taken[window] <= 100 and len(state.fill) <= 4
            assert taken[window] in (100, state.fill.get(window)) or taken[window] > 92  # open, or emitted next
        assert at == length
    assert {w: f for w, f in taken.items() if f < 100 and w in state.fill} == state.fill
    closed = [f for w, f in taken.items() if w not in state.fill]
    assert min(closed) > 100 - 8


def test_merged_windows():
    import pandas as pd

    rng = random.Random(8)
    frame = pd.DataFrame([(p, w, rng.randint(1, 99)) for p in range(20) for w in range(5)], columns=["part", "window", "fill"])
    got = packing.merge(frame, 100).merge(frame, on=["part", "window"])
    assert len(got) == 100
    for _, host in got.sort_values("base").groupby(["host_part", "host_window"]):
        assert host.base.tolist() == [0, *host.fill.cumsum().tolist()[:-1]] and host.fill.sum() <= 100
    assert got.groupby(["host_part", "host_window"]).ngroups <= frame.fill.sum() / 100 * 1.2 + 1


def test_templates():
    made = licenses.compile_template("t", "alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> delta <<var;name=x;words=1-3>> omega")

    def spans(text):
        return made.spans(licenses.words_of(text.encode()))

    assert spans("alpha delta x omega") == [(0, 4)]
    assert spans("see Alpha, beta; delta x y z omega!") == [(1, 8)]
    assert spans("alpha beta gamma delta x omega alpha delta y omega") == [(0, 6), (6, 10)]
    assert spans("alpha gamma delta x omega") == []  # the inner part needs the outer one
    assert spans("alpha delta omega") == [] and spans("alpha delta a b c d omega") == []
    assert made.anchor.strip() in (b"alpha", b"delta", b"omega")
    for bad in ("<<beginOptional>>a", "a<<endOptional>>", "<<what>>a", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises((ValueError, AttributeError)):
            licenses.compile_template("bad", bad)


def test_every_template_accepts_its_own_wording():
    import re

    for label, template in licenses.TEMPLATES.items():
        made = licenses.compile_template(label, template)
        full = re.sub(r"<<var;[^>]*words=(\d+)-(\d+)>>", lambda m: " some" * max(1, int(m[1])), template)
        full = re.sub(r"<<(begin|end)Optional>>", " ", full)
        short = template
        while "beginOptional" in short:
            short = re.sub(r"<<beginOptional>>(?:(?!<<beginOptional>>|<<endOptional>>).)*<<endOptional>>", " ", short, flags=re.S)
        short = re.sub(r"<<var;[^>]*words=(\d+)-(\d+)>>", lambda m: " some" * int(m[1]), short)
        for text in (full, short):
            assert made.spans(licenses.words_of(("before " + text + " after").encode())), (label, text)


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(6000)]
    whole, part = " ".join(words).encode(), " ".join(words[:500]).encode()
    a, b = sketch.sketch(whole), sketch.sketch(part)
    assert sketch.containment(b, a) == 1.0 and abs(sketch.containment(a, b) - 496 / 5996) < 0.03
    assert (sketch.merged(a, b) == a).all()
    assert (sketch.parsed(sketch.written(a)) == a).all()
    assert sketch.similarity(sketch.sketch(b""), sketch.sketch(b" ")) == 1.0
    assert sketch.similarity(sketch.sketch(b""), a) == 0.0 and len(sketch.sketch(b"word")) == 1


def test_warc_records_survive_any_block_size():
    records = [(1, "http://a/ü\nx", b"payload\r\n\r\nmore", None, False), (2, None, b"", None, False), (3, "u", b"x" * 99_999, 1, True), (None, "v", b"\xff\x00", None, False)]
    data = b"".join(warc.member(warc.record(*r)) for r in records)
    for size in (1, 7, 1000, len(data)):
        stream = (data[i : i + size] for i in range(0, len(data), size))
        got = [warc.parse(m, True) for m in warc.members(stream)]
        assert [g["page_id"] for g in got] == [1, 2, 3, None] and all(g["verified"] for g in got)
        assert [g["payload"] for g in got] == [b"payload\r\n\r\nmore", b"", None, b"\xff\x00"]
        assert (got[2]["payload_bytes"], got[2]["refers_to"], got[2]["record_type"]) == (99_999, 1, "revisit")


def test_warc_notices_damage():
    good = warc.record(1, "u", b"some payload", None, False)
    bad = warc.member(good.replace(b"some payload", b"same payload"))
    assert not warc.parse(next(warc.members(iter([bad]))), True)["verified"]
    with pytest.raises(ValueError):
        [list(m) for m in warc.members(iter([warc.member(good)[:-20]]))]
    with pytest.raises(ValueError):
        warc.parse(next(warc.members(iter([warc.member(good[:-10])]))), True)


def test_rotations_are_orthogonal_and_recall_holds():
    rng = np.random.default_rng(10)
    x = itq._unit(rng.standard_normal((500, 16)))
    centre, matrix = itq.learn(x, 40)
    assert matrix.shape == (16, 40)
    assert np.allclose(matrix[:, :16].T @ matrix[:, :16], np.eye(16))
    bits, tables = itq.sizes(50_000)
    assert bits == 12 and tables >= 18


def test_features_do_not_depend_on_the_cut(monkeypatch):
    text = " ".join(f"word{i} word{i}" for i in range(3000)).encode()
    whole = np.bincount(subword.features(text), minlength=subword.BUCKETS + 1)
    monkeypatch.setattr(subword, "_CHUNK", 1000)
    parts = np.bincount(subword.features(text), minlength=subword.BUCKETS + 1)
    assert (whole == parts).all() and whole[subword.REPEAT] == 3000


def test_training_without_both_classes():
    one = [(np.array([1, 2]), np.array([1.0, 1.0], dtype=np.float32))]
    assert subword.train([], []).score(b"any text") == 0.5
    assert subword.train(one * 20, [1] * 20).score(b"any text") > 0.5


def test_crc_of_ids():
    assert zlib.crc32(b"7") % 4 in range(4)


@pytest.mark.parametrize("common", [0.0, 0.8, 0.9, 0.97])
def test_embedding_links_with_a_common_component(spark, common):
    rng = np.random.default_rng(12)
    mean = np.eye(32)[0] * common
    spread = lambda v: mean + np.sqrt(1 - common**2) * np.pad(itq._unit(v), ((0, 0), (1, 0)))
    noise = rng.standard_normal((1600, 31))
    x = spread(noise)
    # partners of the first 400 in the same cloud, at a cosine of 0.90 to 0.93
    least = 1 - (1 - rng.uniform(0.9, 0.93, 400)) / (1 - common**2)
    v = itq._unit(noise[:400])
    away = rng.standard_normal((400, 31))
    away = itq._unit(away - (away * v).sum(axis=1)[:, None] * v)
    turn = np.maximum(least, -1)[:, None]
    x = np.concatenate([x, spread(turn * v + np.sqrt(1 - turn**2) * away)]).astype(np.float32)
    y = itq._unit(x.astype(np.float64))
    true = (y @ y.T >= 0.9).sum(axis=1) - 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in itq.near_duplicates(frame).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.95 * true.sum() and true.sum() >= 700


MIT = """Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""


@pytest.mark.parametrize(
    "label, text, old, new",
    [
        ("mit-text", MIT, "shall be included", "need not be included"),
        ("mit-text", MIT, "OTHER DEALINGS", "DEALINGS"),
        ("isc-text", ISC, "OR PERFORMANCE", "AND PERFORMANCE"),
        ("bsd-text", BSD_HEAD + BSD_TAIL, "must retain", "may retain"),
        ("bsd-text", BSD_HEAD + BSD_TAIL, "POSSIBILITY OF", "POSSIBILITY OR"),
        ("bsd-text", BSD_HEAD + BSD_THIRD + BSD_TAIL, "may be used", "must be used"),
    ],
)
def test_genuine_license_texts_and_altered_ones(label, text, old, new):
    made = licenses.compile_template(label, licenses.TEMPLATES[label])
    whole = licenses.words_of(text.encode())
    assert sum(b - a for a, b in made.spans(licenses.words_of(b"before it ") + whole + [b"behind"])) == len(whole)
    altered = licenses.words_of(text.replace(old, new).encode())
    assert altered != whole and not made.spans(altered)
