"""Quality classifier on supervised subword embeddings.

Features of a text are its words, the 3- to 5-byte pieces of every word with its ends marked, and a
mark for each word that repeats the one before; each is hashed to a learned vector. A document is the
average of its vectors; a softmax layer gives the class. Vectors and layer are learned together by
stochastic gradient descent in numpy, on a sample of labelled rows bounded by a parameter.

A score needs one number per feature only: the layer applied to the feature's vector. The sums over a
text are taken over arrays of its bytes, so scoring is linear in bytes and holds one text at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, col, give_back, share_package, tidy

BUCKETS = 1 << 18
WIDTH = 8
PIECES = (3, 4, 5)
PER_CLASS = 1000  # labelled rows of each class that are learned from
EPOCHS = 3
STEPS = 10_000  # at least so many single updates, over more epochs where few rows are labelled
RATE = 0.5
KEEP = 0.7  # least score that is predicted as good

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 18)
_BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_CHUNK = 1 << 18  # bytes of a text handled at once, cut between words
REPEAT = BUCKETS  # the bucket of a word that repeats the one before

_UP = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * _CHUNK, _STEP)]))
_DOWN = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * _CHUNK, _BACK)]))


def features(text: bytes) -> np.ndarray:
    """Buckets of all features of a text, repeats included."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.int64)
    out, run, size = [], [], 0
    last = None
    for word in words if len(text) > _CHUNK else []:
        run.append(word)
        size += len(word) + 1
        if size >= _CHUNK:
            out.append(_features(run, last))
            last, run, size = run[-1], [], 0
    if len(text) <= _CHUNK:
        run = words
    if run:
        out.append(_features(run, last))
    return np.concatenate(out)


def _features(words: list[bytes], last: bytes | None) -> np.ndarray:
    data = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    n = len(data)
    blank = data == 0x20
    marks = np.flatnonzero(blank)
    wide = data.astype(np.uint64)
    out = []
    for size in PIECES:
        if n < size:
            continue
        key = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            key = (key << np.uint64(8)) | wide[k : n - size + 1 + k]
        inner = np.zeros(n - size + 1, dtype=bool)  # a blank between the first and the last byte
        for k in range(1, size - 1):
            inner |= blank[k : n - size + 1 + k]
        key = key[~inner] | np.uint64(size << 44)
        out.append(((key * _MIX) >> _SHIFT).astype(np.int64))
    # words: sums of weighted bytes between the blanks
    powers_up = _UP if n < len(_UP) else np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _STEP)]))
    powers_down = _DOWN if n < len(_DOWN) else np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BACK)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * powers_up[:n])])
    starts, ends = marks[:-1] + 1, marks[1:]
    hashes = (sums[ends] - sums[starts]) * powers_down[starts]
    out.append(((hashes * _MIX) >> _SHIFT).astype(np.int64))
    again = int((hashes[1:] == hashes[:-1]).sum()) + int(last is not None and last == words[0])
    out.append(np.full(again, REPEAT, dtype=np.int64))
    return np.concatenate(out)


@dataclass
class Model:
    """``effect``: what each feature adds to the log odds, averaged over a text; ``bias``."""

    effect: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        found = features(text)
        total = float(self.effect[found].mean()) if len(found) else 0.0
        return float(1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30))))


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 5, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Learn from ``(buckets, counts)`` per document; without any every score is one half."""
    epochs = max(epochs, -(-STEPS // max(1, len(documents))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS + 1, WIDTH)).astype(np.float32)
    layer = np.zeros((2, WIDTH), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps = max(1, epochs * len(documents))
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(documents)):
            u, counts = documents[i]
            share = (counts / counts.sum()).astype(np.float32) if len(u) else counts
            speed = rate * (1 - step / steps)
            step += 1
            own = vectors[u]
            h = share @ own if len(u) else np.zeros(WIDTH, dtype=np.float32)
            z = layer @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # the gradient of the loss by the layer's output
            back = p @ layer
            layer -= speed * np.outer(p, h)
            bias -= speed * 0.1 * p
            if len(u):
                # a text's share of its features is tiny: step by the count relative to the largest
                vectors[u] = own - speed * np.outer(share / share.max(), back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
) -> Model:
    """Learn ``label_col`` (0 or 1) from at most ``per_class`` documents of each class, chosen by a hash.

    Rows that are held out, have a NULL id or label or contradicting labels aren't learned from.
    """
    known = labels.where(col(label_col).isin(0, 1)).groupBy(col(id_col).cast("long").alias("doc_id"))
    known = known.agg(F.min(col(label_col)).cast("int").alias("label"), F.max(col(label_col)).cast("int").alias("other"))
    known = known.where("doc_id is not null and label = other").where(~held_out(F.col("doc_id"))).select("doc_id", "label")
    # labels may name documents that the table doesn't hold (any more)
    known = known.join(df.select(col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct(), "doc_id", "left_semi")
    chosen = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * per_class rows of two numbers
    texts = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def step(batch):
        pairs = [np.unique(features(t), return_counts=True) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "label": batch.column("label"),
            "buckets": [u.astype(np.int32) for u, _ in pairs],
            "counts": [c.astype(np.int32) for _, c in pairs],
        }

    rows = arrow_rows(texts.join(sample, "doc_id").select("doc_id", "label", "text"), "doc_id long, label int, buckets array<int>, counts array<int>", step, "text")
    got = rows.toArrow().sort_by([("doc_id", "ascending")])
    buckets, counts = got.column("buckets").combine_chunks(), got.column("counts").combine_chunks()
    documents = [
        (buckets[i].values.to_numpy().copy(), counts[i].values.to_numpy().astype(np.float32)) for i in range(got.num_rows)
    ]
    labels_of = got.column("label").to_pylist()
    del got, buckets, counts
    model = train(documents, labels_of)
    del documents
    give_back()
    return model


def scorer(df: DataFrame, model: Model):
    """A function from a text column to a score column; the model is broadcast (about 1 MB)."""
    share_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        tidy()  # what the batch before has left
        model = shared.value
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return lambda text: score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row.

    A NULL or empty text gets the score of the bias alone; a NULL id isn't held out. Repeated rows
    keep a row each, an empty table gives none, other columns are left behind.
    """
    score = scorer(df, model)
    rows = df.select(col(id_col).cast("long").alias("doc_id"), score(col(text_col)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= keep).cast("int").alias("predicted"))
