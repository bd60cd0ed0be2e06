"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are cut into ``m`` segments on a ring. If two fingerprints differ in at most
``t`` bits, then from some segment on every run of l segments differs in at most l * t / m bits
(strong form of the pigeonhole principle on a ring). The first segments of such a chain must agree
exactly, so a row is looked up once per start under those bits; the longer runs of the chain prune
the candidates before the full Hamming check. Equal fingerprints are one row before anything else.

A key shared by many different fingerprints isn't compared pair by pair: its fingerprints are linked
through the values that differ from them in one bit, 65 rows each, whatever the size of the group.
"""

from __future__ import annotations

from fractions import Fraction
from math import pi

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.blocks import joined
from statloom.llm.common import arrow_rows, col, maybe_among, settle
from statloom.llm.graph import components

SEED = 42
SEGMENTS = 5
DISTANCE = 2
CROWD = 64  # fingerprints under one key that are still compared with each other


def shingle_hashes(text: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words, A-Z lower-cased; of the whole sequence if it is shorter."""
    parts = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    stops = np.cumsum([len(p) + 1 for p in parts])
    ends = (stops[words - 1 :] - 1).tolist()
    starts = [0, *stops[:-words].tolist()]
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(doc_id, fp)``: the 64-bit fingerprint as a long. NULL and blank texts have fingerprint 0."""
    rows = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def step(batch):
        fps = [signed(majority(shingle_hashes(t, words))) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "fp": fps}

    return arrow_rows(rows, "doc_id long, fp long", step, "text")


def _ring(segments: int) -> list[tuple[int, list[int]]]:
    """For each start: how far to rotate, and the bits of the runs of 1, 2, ... segments from there."""
    sizes = [64 // segments + (i < 64 % segments) for i in range(segments)]
    out = []
    for i in range(segments):
        turned = sizes[i:] + sizes[:i]
        out.append((sum(sizes[:i]), np.cumsum(turned).tolist()))
    return out


def links(nodes: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``fp`` that join all pairs within ``distance`` bits.

    Pairs that share a crowded key are joined through their one-bit neighbours instead of directly,
    which is exact for ``distance`` 2: two values differ in at most two bits if and only if some value
    differs from each in at most one.
    """
    if distance != 2:
        raise ValueError("crowded keys are linked exactly for a distance of 2 only")
    ring = _ring(segments)
    budget = [(n + 1) * distance // segments for n in range(segments)]
    exact = sum(b == 0 for b in budget)
    starts = []
    for i, (turn, runs) in enumerate(ring):
        turned = f"shiftleft(fp, {turn}) | shiftrightunsigned(fp, {64 - turn})" if turn else "fp"
        starts.append(f"struct({i} as start, shiftrightunsigned({turned}, {64 - runs[exact - 1]}) as key, {turned} as turned)")
    keyed = nodes.select("fp", F.expr(f"inline(array({', '.join(starts)}))"))
    crowded = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("start", "key")
    calm = keyed.join(crowded, ["start", "key"], "left_anti")
    a, b = calm.select("start", "key", F.col("fp").alias("a"), F.col("turned").alias("ta")), calm.select(
        "start", "key", F.col("fp").alias("b"), F.col("turned").alias("tb")
    )

    def within(runs: list[int], n: int) -> Column:
        mask = signed(((1 << runs[n]) - 1) << (64 - runs[n]))
        return F.expr(f"bit_count((ta ^ tb) & {mask}L) <= {budget[n]}")

    chain = F.expr(f"bit_count(ta ^ tb) <= {distance}")
    for n in range(exact, segments - 1):
        lengths = [runs for _, runs in ring]
        passes = F.lit(False)
        for i, runs in enumerate(lengths):
            passes = passes | ((F.col("start") == i) & within(runs, n))
        chain = passes & chain
    near = a.join(b, ["start", "key"]).where(F.col("a") > F.col("b")).where(chain).select("a", "b")
    hot = keyed.join(crowded, ["start", "key"], "left_semi").select("fp").distinct()
    variants = ", ".join(["fp", *[f"fp ^ {signed(1 << i)}L" for i in range(64)]])
    around = hot.select("fp", F.expr(f"explode(array({variants})) as v"))
    centre = around.groupBy("v").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = around.join(centre, "v").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return near.unionByName(star)


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)``: texts whose fingerprints are linked have the same component.

    ``component_id`` is the smallest doc_id reachable. Rows with a NULL doc_id take part and get the
    component of their group, NULL if no row of it has an id. NULL and blank texts share fingerprint
    0 and are one group. Repeated rows keep a row each; an empty table gives none.
    """
    rows = settle(fingerprints(df, id_col, text_col, words), "simhash")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    joined = components(links(nodes.select("fp")))
    # only texts that share a fingerprint or are linked need a lookup
    shared = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").where("n > 1 or component is not null")
    shared = shared.select("fp", "first", F.coalesce("component", "fp").alias("component"))
    first = shared.groupBy("component").agg(F.min("first").alias("component_id"))
    lookup = shared.select("fp", "component").join(first, "component").select("fp", "component_id")
    return rows.join(lookup, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


# ---- near-duplicates by the similarity of five-word shingles ----

TABLES = 18
ROWS = 4  # least hashes in a table's key: 0.8 ** 4 of the tables agree at the threshold, all miss in 1 of 13,000 pairs
_RNG = np.random.default_rng(SEED)
_SALTS = _RNG.integers(0, 2**64, TABLES * ROWS, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 2**64, TABLES * ROWS, dtype=np.uint64) | np.uint64(1)


def angle_bits(similarity: float, bits: int) -> float:
    """Expected differing bits of two shingle sets of equal size with this Jaccard similarity."""
    return bits * float(np.arccos(2 * similarity / (1 + similarity))) / pi


def minima(hashes: np.ndarray) -> np.ndarray:
    """A key per table: its ROWS least values over the set, each under a hash of its own (MinHash)."""
    least = np.full(TABLES * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 12):
        part = (hashes[None, at : at + (1 << 12)] ^ _SALTS[:, None]) * _FACTORS[:, None]
        part ^= part >> np.uint64(32)
        least = np.minimum(least, (part * _FACTORS[::-1, None]).min(axis=1))
    mixed = (least * _FACTORS).reshape(TABLES, ROWS)
    return np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(29)), axis=1).view(np.int64)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.array(sorted({xxhash.xxh3_64_intdigest(p) for p in shingles(text, words)[1]}), dtype="<u8")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], columns: int = 1 << 12) -> np.ndarray:
    """How many values every set of ``a`` shares with every set of ``b``."""
    if len(a) == len(b) == 1:
        return np.array([[len(np.intersect1d(a[0], b[0], assume_unique=True))]])
    left, right = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(left, right)
    total = np.zeros((len(a), len(b)), dtype=np.int64)

    def cells(sets, values):
        row, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(both, values)
        at = np.minimum(at, max(0, len(both) - 1))
        held = both[at] == values if len(both) else np.zeros(len(values), dtype=bool)
        return row[held], at[held]

    (ra, ca), (rb, cb) = cells(a, left), cells(b, right)
    for low in range(0, len(both), columns):
        x, y = np.zeros((len(a), columns), dtype=np.float32), np.zeros((len(b), columns), dtype=np.float32)
        for m, r, c in ((x, ra, ca), (y, rb, cb)):
            here = (c >= low) & (c < low + columns)
            m[r[here], c[here] - low] = 1
        total += np.rint(x @ y.T).astype(np.int64)
    return total


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the Jaccard similarity of packed shingle sets is at least so large, exactly."""
    x, y = [np.frombuffer(v, dtype="<u8") for v in a], [np.frombuffer(v, dtype="<u8") for v in b]
    n, m = np.array([len(v) for v in x])[:, None], np.array([len(v) for v in y])[None, :]
    common = shared_counts(x, y)
    # as a fraction, so that four of five is 0.8 whatever the rounding
    exact = Fraction(similarity).limit_denominator(10**6)
    return common * exact.denominator >= exact.numerator * (n + m - common)


def shingles(text: bytes, words: int) -> tuple[list[bytes], list[bytes]]:
    """Words and shingles of a text, A-Z lower-cased."""
    parts = text.lower().split()
    if len(parts) <= words:
        return parts, [b" ".join(parts)] if parts else []
    joined = b" ".join(parts)
    stops = np.cumsum([len(p) + 1 for p in parts])
    ends = (stops[words - 1 :] - 1).tolist()
    return parts, [joined[a:b] for a, b in zip([0, *stops[:-words].tolist()], ends)]


def similar_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, tables: int = TABLES
) -> DataFrame:
    """``(doc_id, component_id)``: groups of texts whose shingle sets are at least so similar.

    Texts meet whose fingerprints over their distinct shingles hang together by ``links``, that is
    within two bits, found by the ring. Others at the threshold are further apart than any ring could look
    up; they meet if their least shingle hashes agree in one of ``tables`` tables, which depends on the
    similarity alone, not on where a text was changed. Of pairs at the threshold 1 in 13,000 doesn't
    meet there, of closer ones fewer. Pairs that meet are linked if the sets of their shingles are alike
    enough, exactly; only texts that share a key are read again for their sets. Texts without words are
    one group, as are texts with equal shingles. Rows with a NULL doc_id are left out. Repeated rows
    keep a row each.
    """
    rows = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = rows.where("doc_id is not null")

    def step(batch):
        out = {"doc_id": batch.column("doc_id"), "digest": [], "fp": [], "codes": []}
        for text in batch.column("text").to_pylist():
            hashes = shingle_set(text, words)
            out["fp"].append(signed(majority(hashes)))
            out["codes"].append(minima(hashes)[:tables])
            out["digest"].append(xxhash.xxh3_128_digest(b" ".join(text.lower().split())))
        return out

    def sets(batch):
        texts = batch.column("text").to_pylist()
        digests = [xxhash.xxh3_128_digest(b" ".join(t.lower().split())) for t in texts]
        return {"doc_id": batch.column("doc_id"), "digest": digests, "payload": [shingle_set(t, words).tobytes() for t in texts]}

    prints = settle(arrow_rows(rows, "doc_id long, digest binary, fp long, codes array<long>", step, "text"), "prints")
    distinct = prints.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("codes").alias("codes"))
    distinct = settle(distinct, "distinct")
    # the first key is the group of fingerprints that a text's own one belongs to
    ring = components(links(distinct.select("fp").distinct())).withColumnRenamed("node", "fp")
    distinct = distinct.join(ring, "fp", "left").select(
        "digest", "rep", F.concat(F.array(F.coalesce("component", "fp")), "codes").alias("codes")
    )
    keyed = distinct.select("rep", F.posexplode("codes").alias("t", "key"))
    # the least and the greatest differ: a key of several texts
    met = keyed.groupBy("t", "key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("t", "key")
    meeting = settle(keyed.join(met, ["t", "key"], "left_semi").groupBy("rep").agg(F.count("*").alias("n")).drop("n"), "meeting")
    # texts stay where they are; the few too many share no key, so they are compared with none
    texts = maybe_among(rows, "doc_id", meeting, "meets").where("meets").drop("meets")
    held = arrow_rows(texts, "doc_id long, digest binary, payload binary", sets, "text")
    held = held.groupBy("doc_id", "digest").agg(F.first("payload").alias("payload")).withColumnRenamed("doc_id", "rep")
    candidates = settle(distinct.join(held, ["rep", "digest"]).select("rep", F.lit(1).cast("long").alias("mult"), "payload", "codes"), "candidates")
    parts = settle(joined(candidates, lambda a, b: alike(a, b, similarity)), "alike")
    hang = components(parts.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    first = prints.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    found = first.join(hang.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    return prints.select("doc_id", "digest").join(found, "digest").select("doc_id", "component_id")
