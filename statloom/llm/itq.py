"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

On a bounded sample the principal directions are found, and in them rotations that bring the vectors
close to the corners of a cube, so that signs lose little and bits are balanced. Every vector gets the
signs of several rotations as its code. The code is cut into substrings, one table each; two vectors
meet if they agree on a substring. Vectors that meet are reranked by the cosine of the originals in
double precision. As in multi-index hashing a substring has about the logarithm of the number of
vectors as its bits; the number of tables follows from the bits, the least cosine and the wanted recall.
Signs are those of centred vectors, whose angles are wider than the originals' if they have a component
in common; so the recall is measured on pairs of the sample at the least cosine, found and made, and
where it is too low, bits and tables are chosen anew from what was measured.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm.blocks import BLOCK, linked
from statloom.llm.common import arrow_rows, col, settle
from statloom.llm.graph import components

SEED = 42
SAMPLE_FLOATS = 1 << 20  # numbers in the sample that the rotations are learned on
RECALL = 0.97  # of pairs at the least cosine, if bits were independent
COSINE = 0.9
TRIED = 4096  # vectors and pairs of the sample that the recall is measured on
HANDLING = 64  # comparisons that a row in one more table costs as much as


def rotation(v: np.ndarray, seed: int, rounds: int = 40) -> np.ndarray:
    """The orthogonal matrix that alternates between signs and the best rotation towards them."""
    rng = np.random.default_rng(seed)
    r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return r


def learn(sample: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The centre and a matrix whose columns give at least ``bits`` signs."""
    centre = sample.mean(axis=0)
    v = sample - centre
    # all directions in order of their variance; scaled alike, so that each gives bits worth having
    values, vectors = np.linalg.eigh(v.T @ v / max(1, len(v)))
    p = vectors[:, ::-1]
    parts = [p @ rotation(v @ p, seed) for seed in range(ceil(bits / p.shape[1]))]
    return centre, np.concatenate(parts, axis=1)[:, :bits]


def sizes(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a substring and number of tables for so many vectors."""
    bits = max(8, ceil(log2(max(2, vectors))) - 4)
    agree = (1 - acos(cosine) / pi) ** bits
    return bits, ceil(log(1 - recall) / log(1 - agree))


def pairs(sample: np.ndarray, centre: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors about the least cosine: those within the sample, and made ones, a partner for each vector.

    A partner is as far from the centre as its vector, and away from it in a direction that two other vectors span.
    """
    left, right = [], []
    for at in range(0, len(sample), 512):
        likeness = sample[at : at + 512] @ sample.T
        i, j = np.nonzero((likeness >= cosine) & (likeness < cosine + 0.3 * (1 - cosine)))
        ahead = np.flatnonzero(i + at < j)[: 1 << 14]
        left.append(i[ahead] + at)
        right.append(j[ahead])
    i, j = np.concatenate(left), np.concatenate(right)
    some = np.unique(np.linspace(0, len(i) - 1, TRIED).astype(np.int64)) if len(i) else np.empty(0, dtype=np.int64)
    found = (sample[i[some]], sample[j[some]])
    rng = np.random.default_rng(SEED)
    x = sample[:TRIED]
    v = x - centre
    square = (v * v).sum(axis=1)
    apart = sample[rng.integers(0, len(sample), len(x))] - sample[rng.integers(0, len(sample), len(x))]
    fine = (square > 1e-12) & ((1 - cosine) / 2 <= square)  # else no vector so near the centre is that far away
    x, v, square, apart = x[fine], v[fine], square[fine], apart[fine]
    apart -= ((apart * v).sum(axis=1) / square)[:, None] * v
    length = np.sqrt((apart * apart).sum(axis=1))
    fine = length > 1e-9
    x, v, square, apart = x[fine], v[fine], square[fine], apart[fine] / length[fine, None]
    turn = 1 - (1 - cosine) / square
    made = centre + turn[:, None] * v + (np.sqrt(np.maximum(0, 1 - turn**2) * square))[:, None] * apart
    return [p for p in (found, (x, made)) if len(p[0]) >= 100]


def measured(tried: list, centre: np.ndarray, matrix: np.ndarray, bits: int) -> float:
    """The least share of pairs, over the kinds of pairs, that agree on all bits of some table."""
    return min(
        (((x - centre) @ matrix >= 0) == ((y - centre) @ matrix >= 0)).reshape(len(x), -1, bits).all(axis=2).any(axis=1).mean() for x, y in tried
    )


def plan(sample: np.ndarray, vectors: int, cosine: float, recall: float) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Bits, tables, centre and matrix that have the wanted recall on pairs of the sample; no bits: all rows meet."""
    bits, tables = sizes(vectors, cosine, recall)
    centre, matrix = learn(sample, bits * tables)
    if vectors <= BLOCK:  # one block: all pairs cost no more than a table
        return 0, 1, centre, matrix[:, :0]
    tried = pairs(sample, centre, cosine)
    if not tried or measured(tried, centre, matrix, bits) >= recall:
        return bits, tables, centre, matrix
    agree = [(((x - centre) @ matrix >= 0) == ((y - centre) @ matrix >= 0)).mean(axis=1) for x, y in tried]

    def needed(bits: int) -> int:
        tables = 1
        while min((1 - (1 - q**bits) ** tables).mean() for q in agree) < recall:
            tables = ceil(tables * 1.1)
            if tables > vectors:
                break
        return tables

    costs = {b: needed(b) * (1 + vectors / 2**b / HANDLING) for b in range(bits + 1)}
    bits = min(costs, key=lambda b: (costs[b], -b))
    if not bits:
        return 0, 1, centre, matrix[:, :0]
    tables = needed(bits)
    while True:
        centre, matrix = learn(sample, bits * tables)
        if measured(tried, centre, matrix, bits) >= recall:
            return bits, tables, centre, matrix
        tables = ceil(tables * 1.1)
        if tables > vectors:  # no number of tables is cheaper than all pairs
            return 0, 1, centre, matrix[:, :0]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Links join vectors found with a cosine of at least ``cosine``; none joins vectors below it.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable, ``kept`` says that it is the row's own. Vectors of different lengths have no cosine; every
    length is indexed on its own. Vectors that are NULL, zero, or hold NULL or non-finite components link
    with nothing, nor do rows with a NULL vec_id, whose component is NULL and which aren't kept. Equal
    vectors are compared once and count as often as they occur. An empty table gives no rows.
    """
    wide = isinstance(df.schema[vector_col].dataType, T.ArrayType) and isinstance(df.schema[vector_col].dataType.elementType, T.DoubleType)
    kind = "double" if wide else "float"
    fine = "v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)"
    rows = df.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast(f"array<{kind}>").alias("v"))
    good = rows.where("vec_id is not null").where(F.expr(fine))
    number = np.dtype("<f8" if wide else "<f4")
    joint = F.coalesce(F.col("vec_id").isNotNull() & F.expr(fine), F.lit(False))
    out = rows.where(~joint).select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    # a row per length; a vector that is alone with its length has no partner
    lengths = {r["size"]: r["n"] for r in good.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    single = [size for size, n in lengths.items() if n == 1]
    if single:
        out = out.unionByName(good.where(F.size("v").isin(single)).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    for width in sorted(size for size, n in lengths.items() if n > 1):
        out = out.unionByName(_of_length(good.where(F.size("v") == width), width, number, cosine, recall))
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _of_length(good: DataFrame, width: int, number: np.dtype, cosine: float, recall: float) -> DataFrame:
    """``(vec_id, n_links, component_id)`` of sound vectors ``(vec_id, v)`` of one length; NULL without links."""
    spark = good.sparkSession

    def packed(batch):
        values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(number).reshape(-1, width)
        return {"vec_id": batch.column("vec_id"), "payload": [v.tobytes() for v in values]}

    packed_rows = arrow_rows(good.select("vec_id", "v", F.lit(b"").alias("size")), "vec_id long, payload binary", packed, "size")
    whole = settle(packed_rows.withColumn("digest", F.md5("payload")), "vectors")
    distinct = whole.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("payload").alias("payload"))
    distinct = settle(distinct, "distinct-vectors")
    total = distinct.count()
    # every vector is indexed; the sample is bounded by its numbers, and so is what is moved for it:
    # rows whose hash lies below a share of the range, about as many as wanted whatever the partitions
    wanted = max(256, SAMPLE_FLOATS // width)
    below = F.lit(min(1.0, wanted / max(1, total)) * 2.0**32)
    some = distinct.where(F.shiftrightunsigned(F.xxhash64("digest"), 32) < below).select("digest", "payload").toArrow().sort_by("digest")
    if some.num_rows < 2:
        some = distinct.select("digest", "payload").limit(2).toArrow().sort_by("digest")
    sample = np.frombuffer(b"".join(some.column("payload").to_pylist()), dtype=number).reshape(-1, width).astype(np.float64)
    bits, tables, centre, matrix = plan(_unit(sample), total, cosine, recall)
    shared = spark.sparkContext.broadcast((centre, matrix))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def coded(batch):
        centre, matrix = shared.value
        x = _unit(np.frombuffer(b"".join(batch.column("payload").to_pylist()), dtype=number).reshape(-1, width).astype(np.float64))
        signs = ((x - centre) @ matrix >= 0).reshape(len(x), tables, bits)
        return {
            "rep": batch.column("rep"),
            "mult": batch.column("mult"),
            "payload": batch.column("payload"),
            "codes": list((signs * weights).sum(axis=2).astype(np.int32)),
        }

    codes = arrow_rows(distinct.select("rep", "mult", "payload"), "rep long, mult long, payload binary, codes array<int>", coded, "payload")

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = _unit(np.ascontiguousarray(a).view(number).astype(np.float64))
        y = _unit(np.ascontiguousarray(b).view(number).astype(np.float64))
        return x @ y.T >= cosine

    parts = settle(linked(codes, close), "links")
    counts = parts.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(parts.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    found = distinct.select("digest", "rep", "mult").join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.where("mult > 1 or n is not null").select(
        "digest", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    return whole.select("vec_id", "digest").join(found, "digest", "left").select("vec_id", "n_links", "component_id")


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that large and small numbers neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
