"""Document fingerprints as threshold-scaled sketches.

A sketch keeps the distinct hashes of a text's five-word shingles below ``2**64 / SCALE``, and the
smallest one of all, so that a text with words never has an empty sketch. The same shingles are kept
whatever document they stand in: sketches of parts merge by union, and overlap and containment of two
texts of very unequal length are estimated without bias from the shingles that both keep.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, share_package, slices, text_rows
from statloom.llm.simhash import shingle_hashes

WORDS = 5
SCALE = 4
MOST_RANGES = 1024  # the limits of the order's ranges are literals of the plan


def sketch(text: bytes, words: int = WORDS, scale: int = SCALE) -> np.ndarray:
    """The kept hashes, sorted. A text without words has none; one shorter than a shingle is one shingle."""
    hashes = np.unique(shingle_hashes(text, words))
    return hashes[: max(1, int(np.searchsorted(hashes, np.uint64(2**64 // scale))))]


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    both = np.union1d(a, b)
    return both[: max(1, int(np.searchsorted(both, np.uint64(2**64 // scale))))]


def similarity(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """Estimated Jaccard likeness of two shingle sets, 1 for two texts without words."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    union = merged(a, b, scale)
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(common, union, assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """Estimated share of a's shingles that b has as well, 1 if a has none."""
    limit = np.uint64(2**64 // scale)
    low = a[a < limit]
    if not len(low):
        low = a
    return float(np.isin(low, b, assume_unique=True).mean()) if len(low) else 1.0


def written(hashes: np.ndarray) -> str:
    """A sketch as text: 16 hex digits for each hash."""
    return hashes.astype(">u8").tobytes().hex()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, fingerprint)`` for every row; NULL and blank texts have the empty fingerprint."""

    def step(batch):
        texts = batch.column("text").to_pylist()
        return {
            "doc_id": batch.column("doc_id"),
            "n_chars": [len(t) for t in texts],
            "fingerprint": [written(sketch(t.encode("utf-8", "surrogatepass"))) for t in texts],
        }

    return arrow_rows(text_rows(df, id_col, text_col), "doc_id long, n_chars long, fingerprint string", step, "text")


def _range_of(value: Column, limits: list[int]) -> Column:
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < limits[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), F.lit(-1)).otherwise(tree(0, len(limits)))


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Every document against an edited copy of itself and against the next document.

    Documents stand in descending order of doc_id (NULL last, equal ids by text); the first follows
    the last. In the edited text the last half of the code points, rounded down, gives way to the
    first as many of the next document, or all it has. A NULL text counts as empty. Repeated rows stand
    one behind the other; a single document is its own next; an empty table gives no rows.

    The order is cut into ranges of doc_id; each range is read in order by one task and is also sent
    the first document of the range behind it, so every text is shuffled once.
    """
    spark = df.sparkSession
    share_package(spark)
    ranges = ranges or min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = text_rows(df, id_col, text_col)
    ids = rows.select("doc_id").where("doc_id is not null")
    probabilities = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx("doc_id", probabilities, 100 * ranges).alias("p")).first()["p"] if probabilities else None
    limits = sorted(set(found or []))
    placed = rows.withColumn("range", _range_of(F.col("doc_id"), limits))
    # at most a row per range: its first document in the order
    heads = {r["range"]: r["first"] for r in placed.groupBy("range").agg(F.max("doc_id").alias("first")).collect()}
    order = sorted(heads, reverse=True)
    # ranges to which the document that begins another range is sent as well
    to: dict[int | None, list[int]] = {}
    for i, r in enumerate(order):
        to.setdefault(heads[order[(i + 1) % len(order)]], []).append(r)
    pairs = [x for first, targets in to.items() if first is not None for x in (F.lit(first), F.array(*[F.lit(t) for t in targets]))]
    none = F.array().cast("array<int>")
    extra = F.try_element_at(F.create_map(*pairs), F.col("doc_id")) if pairs else none
    without_id = F.array(*[F.lit(t) for t in to[None]]) if None in to else none
    extra = F.when(F.col("doc_id").isNull(), without_id).otherwise(extra)
    own = F.struct(F.col("range"), F.lit(False).alias("ahead"))
    others = F.transform(F.coalesce(extra, none), lambda r: F.struct(r.alias("range"), F.lit(True).alias("ahead")))
    sent = placed.select("doc_id", "text", F.inline(F.concat(F.array(own), others)))
    dealt = sent.repartition(ranges, "range").sortWithinPartitions("range", "ahead", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.mapInArrow(_walk, OUT)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in OUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    before: tuple | None = None  # range, doc_id, text, sketch of the document that waits for its next
    for batch in batches:
        for some in slices(batch, "text"):
            rows = []
            columns = [some.column(c).to_pylist() for c in ("doc_id", "text", "range", "ahead")]
            for doc, text, place, ahead in zip(*columns):
                if ahead and (before is None or before[0] != place):
                    continue  # a repeated row of the document that begins the next range
                here = sketch(text.encode("utf-8", "surrogatepass"))
                if before is not None and before[0] == place:
                    rows.append(_compare(before[1], before[2], before[3], text, here))
                before = None if ahead else (place, doc, text, here)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names=names
            )


def _compare(doc: int, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode("utf-8", "surrogatepass")
    changed = sketch(edited)
    return (
        doc,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        written(own),
        written(changed),
        similarity(own, changed),
        similarity(own, other),
    )
