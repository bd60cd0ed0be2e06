"""Quality rules and a verdict by hashed n-grams: trusted texts against the raw corpus.

Every word and every pair of neighbouring words falls into one of ``BUCKETS`` by a hash. Two
multinomials over the buckets are counted over whole tables: one of the trusted texts, one of all texts.
A text's score is the mean over its n-grams of the logarithm of the two probabilities' ratio, so that
long and short texts compare; it is kept if the score reaches a fixed ``LEAST``. Trusted counts are
smoothed by the raw distribution: a bucket that neither side knows well says nothing.

The rules look at characters and repeats; they fail texts whatever their score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, col, share_package, slices
from statloom.llm.tokens import BLANKS, Words, byte_set, numbered, words

BUCKETS = 1 << 16
SMOOTHING = 64  # n-grams of the usual trusted share that every bucket is taken to hold besides its own
LEAST = -0.06  # mean log ratio from which on a text is kept: its n-grams are at most 6 % rarer in trusted texts
TRUSTED_BYTES = 16 << 20  # ids of trusted texts that are broadcast at most; more are joined
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

_SYMBOLS = byte_set(b"#*$%&|<>")
_BLANK = byte_set(BLANKS)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(64 - 16)


def grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and of all pairs of neighbouring words, and the texts they stand in."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, w.names.to_pylist()), dtype=np.uint64, count=len(w.names))
    h = own[w.number]
    single = (h * _A) >> _SHIFT
    beside = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    pair = ((h[beside] * _B ^ (h[beside] >> np.uint64(29))) + h[beside + 1]) * _A >> _SHIFT
    return np.concatenate([single, pair]).astype(np.int64), np.concatenate([w.doc, w.doc[beside]])


def repeated_words(w: Words) -> np.ndarray:
    """Whether a word stands in a window of three words that its text holds twice or more."""
    out = np.zeros(len(w.number), dtype=bool)
    beside = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    if not len(beside):
        return out
    size = len(w.names)
    pair = np.full(len(w.number), -1, dtype=np.int64)
    number, count = numbered(w.number[beside] * size + w.number[beside + 1])
    often = count[number] > 1  # a window that repeats holds pairs that do
    pair[beside[often]] = number[often]
    three = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
    number, _ = numbered(pair[three] * size + w.number[three + 2])
    number, count = numbered(w.doc[three] * (int(number.max(initial=0)) + 1) + number)
    three = three[count[number] > 1]
    for k in range(3):
        out[three + k] = True
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm of trusted to raw probability; zeros without trusted texts."""
    share = target.sum() / max(1.0, raw.sum())
    if not share:
        return np.zeros(len(raw))
    return np.log((target + SMOOTHING * share) / (raw + SMOOTHING) / share)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def fit(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", good: int = 1
) -> np.ndarray:
    """The log ratios per bucket from all texts; those whose id is labelled ``good`` are trusted.

    NULL ids are never trusted; contradicting labels of an id don't make it trusted. Counts of every
    task are summed by bucket, so a task sends ``BUCKETS`` rows at most, whatever it reads.
    """
    spark = df.sparkSession
    share_package(spark)
    known = labels.where(col(label_col).isNotNull()).groupBy(col(id_col).cast("long").alias("doc_id"))
    known = known.agg(F.min(col(label_col)).alias("low"), F.max(col(label_col)).alias("high"))
    known = known.where((F.col("low") == good) & (F.col("high") == good)).select("doc_id", F.lit(True).alias("trusted"))
    small = known.count() * 8 <= TRUSTED_BYTES
    rows = _texts(df, id_col, text_col).join(F.broadcast(known) if small else known, "doc_id", "left")
    rows = rows.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"))
                bucket, doc = grams(w)
                raw += np.bincount(bucket, minlength=BUCKETS)
                trusted = part.column("trusted").to_numpy(zero_copy_only=False)
                target += np.bincount(bucket[trusted[doc]], minlength=BUCKETS)
            pa.default_memory_pool().release_unused()
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(raw[held]), pa.array(target[held])], names=["bucket", "raw", "target"])

    counts = rows.mapInArrow(count, "bucket long, raw long, target long")
    got = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    place = got.column("bucket").to_numpy()
    raw[place], target[place] = got.column("raw").to_numpy(), got.column("target").to_numpy()
    return log_ratios(target, raw)


def judged(df: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept)`` per row.

    ``score`` is the mean log ratio of the text's n-grams, 0 without any. A text is kept if it doesn't
    fail the rules (fewer than 50 words, or over half of them in repeated windows of three) and its
    score is at least ``least``. A NULL or empty text has no words and fails. NULL ids and repeated rows
    give a row each, an empty table none; other columns are left behind.
    """
    shared = df.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS numbers

    def step(batch):
        w = words(batch.column("text"))
        n = batch.num_rows
        at = np.searchsorted(w.limits, np.arange(len(w.data)), side="right") - 1 if n else np.empty(0, dtype=np.int64)
        letters = ~_BLANK[w.data] & ((w.data & 0xC0) != 0x80)  # bytes that begin a code point
        bucket, doc = grams(w)
        n_grams = np.bincount(doc, minlength=n)
        total = np.bincount(doc, weights=shared.value[bucket], minlength=n)
        again = []
        for text in batch.column("text").to_pylist():
            lines = [line for line in text.split(b"\n") if line.strip()]
            again.append(len(lines) - len(set(lines)))
        n_words = np.bincount(w.doc, minlength=n)
        n_repeat = np.bincount(w.doc[repeated_words(w)], minlength=n)
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words)
        score = total / np.maximum(1, n_grams)
        return {
            "doc_id": batch.column("doc_id"),
            "n_words": n_words,
            "word_chars": np.bincount(at[letters], minlength=n),
            "n_symbols": np.bincount(at[_SYMBOLS[w.data]], minlength=n),
            "n_dup_lines": again,
            "n_repeat_words": n_repeat,
            "base_failed": failed,
            "score": score,
            "kept": ~failed & (score >= least),
        }

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, score double, kept boolean"
    )
    return arrow_rows(_texts(df, id_col, text_col), schema, step, "text")
