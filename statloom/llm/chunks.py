"""Substring de-duplication by content-defined chunking.

A gear hash rolls over the UTF-8 bytes: ``h = (h << 1) + G[byte]`` in 16 bits, so that it depends on
the last 16 bytes only. A text may be cut after a word; it is cut where the hash there is smaller
than at the ``SPREAD`` words before and not larger than at those behind. Whether a place is a cut
thus depends on the bytes near it alone: an insertion moves the cuts around it and no others, and two
texts that share a passage have the same cuts, hence the same chunks, inside it. A stretch without a
cut, as in text that repeats one word, is cut every ``MOST`` words from the cut before it.

Chunks are compared by 128-bit digests. The first document that holds a chunk (smallest doc_id) keeps
it. Where a run of neighbouring chunks of a document is held by other documents too and is long
enough, it is reported, and removed from all but the first holder.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, col, free_name, maybe_among, settle, share_package, told_apart

WINDOW = 16  # bytes the hash depends on
SPREAD = 3  # words on either side that a cut's hash is compared with
UNIT = 64  # bytes of a word; longer ones may be cut inside
MOST = 24  # words of a chunk
KEY = "_statloom_document"
MIN_WORDS = 24  # of a repeated run: a passage of 50 words less the chunks cut by its two ends

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_GEAR = np.random.default_rng(2024).integers(0, 2**16, 256, dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte, by doubling: a sum over 2k bytes is two sums over k."""
    h = _GEAR[data]
    k = 1
    while k < WINDOW:
        moved = np.zeros_like(h)
        moved[k:] = h[:-k] << np.uint16(k)
        h = h + moved
        k *= 2
    return h


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk starts, chunk ends and words per chunk of a text's bytes."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    blank = _BLANK[data]
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))  # word starts
    h = gear(data)
    places = begins[begins > 0]
    long = np.flatnonzero(np.diff(np.append(begins, n)) > UNIT)
    if len(long):  # inside a long word: at starts of code points that the hash picks
        inside = (h[:-1] & np.uint16(7)) == 0
        inside &= (data[1:] & 0xC0) != 0x80
        picked = np.flatnonzero(inside) + 1
        owner = np.searchsorted(begins, picked, side="right") - 1
        picked = picked[(owner >= 0) & np.isin(owner, long)]
        places = np.union1d(places, picked)
    # the last bytes before a place decide; the blanks there count as well
    value = h[places - 1].astype(np.int64) if len(places) else np.empty(0, dtype=np.int64)
    is_cut = np.ones(len(places), dtype=bool)
    for k in range(1, SPREAD + 1):
        is_cut[k:] &= value[k:] < value[:-k]
        is_cut[:-k] &= value[:-k] <= value[k:]
    at = np.concatenate([[-1], np.flatnonzero(is_cut), [len(places)]])  # of the cuts among the places
    for a, b in zip(at[:-1][np.diff(at) > MOST].tolist(), at[1:][np.diff(at) > MOST].tolist()):
        is_cut[a + MOST : b : MOST] = True
    edges = np.concatenate([[0], places[is_cut], [n]])
    edges = edges[np.concatenate([[True], np.diff(edges) > 0])]
    inner = np.searchsorted(begins, edges)
    return edges[:-1], edges[1:], np.diff(inner)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, place, start, length, words, d1, d2)``: byte offsets and digests of all chunks.

    Runs of blanks and the letter case A-Z don't matter to a digest. Documents with a NULL doc_id
    are left out, as they can't be told apart; NULL and empty texts have no chunks.
    """

    def step(batch):
        out = {k: [] for k in ("doc_id", "place", "start", "length", "words", "d1", "d2")}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            text = text.lower()
            starts, ends, words = cuts(np.frombuffer(text, dtype=np.uint8))
            if not len(starts):
                continue
            digest = xxhash.xxh3_128_digest
            d = b"".join([digest(b" ".join(text[a:b].split())) for a, b in zip(starts.tolist(), ends.tolist())])
            pair = np.frombuffer(d, dtype="<i8").reshape(-1, 2)
            out["doc_id"].append(np.full(len(starts), doc))
            out["place"].append(np.arange(len(starts)))
            out["start"].append(starts)
            out["length"].append(ends - starts)
            out["words"].append(words)
            out["d1"].append(pair[:, 0])
            out["d2"].append(pair[:, 1])
        return {k: np.concatenate(v) if v else [] for k, v in out.items()}

    schema = "doc_id long, place int, start long, length int, words int, d1 long, d2 long"
    return arrow_rows(_rows(df, id_col, text_col).where("doc_id is not null"), schema, step, "text")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Spans ``(doc_id, start, length, words, first_doc, kept)`` of passages that several documents hold.

    ``start`` and ``length`` are bytes of the UTF-8 text; ``first_doc`` is the smallest doc_id that holds
    the span's first chunk. A document keeps the chunks that it holds first; a span never mixes kept
    and removable chunks. Repeats inside one document, and in rows equal in doc_id and text, aren't
    repeats across documents. Different texts with one doc_id are different documents, as are all rows
    with a NULL doc_id; they come behind all others, and their spans bear their doc_id.
    """
    key = free_name(df, KEY)
    keyed = told_apart(df, key, id_col, text_col)
    spans = _repeats(keyed, key, text_col, min_words)
    names = keyed.where(~col(id_col).cast("long").eqNullSafe(F.col(key))).select(F.col(key).alias("doc_id"), col(id_col).cast("long").alias("own")).distinct()
    names = settle(names, "names")
    if names.isEmpty():
        return spans
    first = names.select(F.col("doc_id").alias("first_doc"), F.col("own").alias("own_first"), F.lit(True).alias("renamed_first"))
    spans = spans.join(names.withColumn("renamed", F.lit(True)), "doc_id", "left").join(first, "first_doc", "left")
    doc_id = F.when(F.col("renamed"), F.col("own")).otherwise(F.col("doc_id")).alias("doc_id")
    first_doc = F.when(F.col("renamed_first"), F.col("own_first")).otherwise(F.col("first_doc")).alias("first_doc")
    return spans.select(doc_id, "start", "length", "words", first_doc, "kept")


def _repeats(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """The spans under a key that tells all documents apart."""
    rows = chunks(df, id_col, text_col)
    held = rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    held = held.where("first_doc <> last_doc").drop("last_doc")
    kept = (F.col("doc_id") == F.col("first_doc")).alias("kept")
    shared = rows.join(held, ["d1", "d2"]).select("doc_id", "place", "start", "length", "words", "first_doc", kept)
    # neighbouring chunks of a document that are all shared: place - rank is the same
    line = Window.partitionBy("doc_id", "kept").orderBy("place")
    again = F.lag("place").over(line).eqNullSafe(F.col("place"))  # the chunk of a repeated row
    runs = shared.select(
        "*", (F.col("place") - F.dense_rank().over(line)).alias("run"), F.when(again, 0).otherwise(F.col("words")).alias("counted")
    )
    spans = runs.groupBy("doc_id", "kept", "run").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("length")).alias("stop"),
        F.sum("counted").alias("words"),
        F.min_by("first_doc", "place").alias("first_doc"),
    )
    return spans.where(F.col("words") >= min_words).select(
        "doc_id", "start", (F.col("stop") - F.col("start")).alias("length"), "words", "first_doc", "kept"
    )


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the byte spans ``(start, length)``."""
    parts, at = [], 0
    for start, length in sorted(spans):
        parts.append(text[at : max(at, start)])
        at = max(at, start + length)
    return b"".join([*parts, text[at:]])


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with repeated passages removed from all but their first holder; columns stay.

    Untouched texts stay as they are, NULL and empty ones included; a row whose words are all held
    elsewhere goes. Documents are told apart as in ``repeats``: a text loses its own spans only.
    """
    key = free_name(df, KEY)
    keyed = told_apart(df, key, id_col, text_col)
    spans = _repeats(keyed, key, text_col, min_words).where("not kept")
    listed = settle(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("spans")), "repeats")
    # names of our own: df may have columns called alike
    own_id, own_spans = free_name(df, "_statloom_id"), free_name(df, "_statloom_spans")
    share_package(df.sparkSession)
    # texts that surely hold no repeat stay where they are
    mark = free_name(df, "_statloom_maybe")
    marked = maybe_among(keyed, key, listed.select("doc_id"), mark)
    met, untouched = marked.where(F.col(mark)), marked.where(~F.col(mark))
    listed = listed.select(F.col("doc_id").alias(own_id), F.col("spans").alias(own_spans))

    @F.pandas_udf("string")
    def edited(texts: pd.Series, lists: pd.Series) -> pd.Series:
        pairs = zip(texts, lists)
        return pd.Series([cut_out(t, [(s["start"], s["length"]) for s in found]).decode() for t, found in pairs], dtype=object)

    # a deterministic function would be run again for the filter below, by a second worker beside every task's own
    edited = edited.asNondeterministic()
    touched = met.join(listed, F.col(key) == F.col(own_id))
    rest = untouched.unionByName(met.join(listed, F.col(key) == F.col(own_id), "left_anti")).select(*[col(c) for c in df.columns])
    changed = touched.withColumn(text_col, edited(col(text_col).cast("binary"), F.col(own_spans)))
    return rest.unionByName(changed.where(col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*[col(c) for c in df.columns]))
