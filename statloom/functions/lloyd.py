"""Many k-means fits of one table at a time: every pass over the rows serves all of them.

The fits are MLlib's row by row: the same seeded k-means||, the same iterations and stopping rule, so a fit's
centres are those of ``KMeans(k, seed)`` on the same partitions, up to the order of sums. A pass returns sums per
centre, never rows; what reaches the driver besides are the candidate centres of the start, about 4 k per fit.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.session import share_package

# MLlib's defaults, and how many distances one step of a task holds.
ITERATIONS = 20
TOLERANCE = 1e-4
START_STEPS = 2
LOCAL_ITERATIONS = 30
HELD = 1 << 19

_M32, _M64 = (1 << 32) - 1, (1 << 64) - 1


@dataclass(frozen=True)
class Fit:
    centers: np.ndarray  # a row per centre
    cost: float  # summed squared distances in the last iteration


# ---- the random numbers of Spark ------------------------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 (32 bits) of whole words."""
    turn = lambda x, r: ((x << r) | (x >> (32 - r))) & _M32
    h = seed
    for (word,) in struct.iter_unpack("<I", data):
        h = (turn(h ^ (turn(word * 0xCC9E2D51 & _M32, 15) * 0x1B873593 & _M32), 13) * 5 + 0xE6546B64) & _M32
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & _M32
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & _M32
    return h ^ (h >> 16)


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


def _step(x: int) -> int:
    x ^= x << 21 & _M64
    x ^= x >> 35
    return x ^ (x << 4 & _M64)


def _hashed(seed: int) -> int:
    data = struct.pack(">q", _signed(seed, 64))
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


class XorShift:
    """Spark's XORShiftRandom."""

    def __init__(self, seed: int) -> None:
        self.state = _hashed(seed)

    def _next(self, bits: int) -> int:
        self.state = _step(self.state)
        return self.state & ((1 << bits) - 1)

    def integer(self) -> int:
        return _signed(self._next(32), 32)

    def double(self) -> float:
        high = self._next(26)
        return ((high << 27) + self._next(27)) * 2.0**-53

    def doubles(self, n: int) -> np.ndarray:
        """The next ``n`` doubles: steps are linear over bits, so a run of states is carried on by its own length."""
        if not n:
            return np.empty(0)
        states = np.array([_step(self.state)], np.uint64)
        power = 0
        while len(states) < 2 * n:
            tables, out = _jump(power), np.zeros(len(states), np.uint64)
            for byte in range(8):
                out ^= tables[byte][(states >> np.uint64(8 * byte)) & np.uint64(255)]
            states, power = np.concatenate([states, out]), power + 1
        states = states[: 2 * n]
        self.state = int(states[-1])
        high, low = states[::2] & np.uint64((1 << 26) - 1), states[1::2] & np.uint64((1 << 27) - 1)
        return ((high << np.uint64(27)) + low) * 2.0**-53


def _applied(columns: list[int], x: int) -> int:
    out = 0
    for bit in range(64):
        if x >> bit & 1:
            out ^= columns[bit]
    return out


@cache
def _columns(power: int) -> list[int]:
    """What ``2 ** power`` steps make of every bit."""
    if not power:
        return [_step(1 << bit) for bit in range(64)]
    half = _columns(power - 1)
    return [_applied(half, c) for c in half]


@cache
def _jump(power: int) -> np.ndarray:
    columns = _columns(power)
    return np.array([[_applied(columns, v << 8 * byte) for v in range(256)] for byte in range(8)], np.uint64)


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self, bits: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> (48 - bits), 32)

    def integer(self) -> int:
        return self._next(32)

    def long(self) -> int:
        high = self._next(32)
        return _signed((high << 32) + self._next(32), 64)

    def double(self) -> float:
        high = self._next(26)
        return ((high << 27) + self._next(27)) * 2.0**-53

    def below(self, bound: int) -> int:
        r = self._next(31)
        if not bound & (bound - 1):
            return (bound * r) >> 31
        while r - r % bound + bound - 1 >= 1 << 31:
            r = self._next(31)
        return r % bound


def sampled_place(sizes: list[int], seed: int) -> tuple[int, int]:
    """(partition, row) that ``takeSample(False, 1, seed)`` takes from partitions of these sizes."""
    total, rand = sum(sizes), JavaRandom(seed)
    if total <= 1:
        return next(i for i, n in enumerate(sizes) if n), 0
    gamma = -math.log(1e-4) / total
    share = min(1.0, max(1e-10, 1 / total + gamma + math.sqrt(gamma * gamma + 2 * gamma / total)))
    places: list[tuple[int, int]] = []
    while not places:
        seeds = JavaRandom(rand.integer())
        for i, n in enumerate(sizes):
            own = XorShift(seeds.long())
            if share >= 1:
                places += [(i, j) for j in range(n)]
            elif share > 0.4:
                places += [(i, int(j)) for j in np.flatnonzero(own.doubles(n) <= share)]
            else:
                gap = lambda own=own: int(math.log(max(own.double(), 5e-11)) / math.log1p(-share))
                j = gap()
                while j < n:
                    places.append((i, j))
                    j += 1 + gap()
    for i in range(len(places) - 1, 0, -1):
        j = rand.below(i + 1)
        places[i], places[j] = places[j], places[i]
    return places[0]


# ---- passes over the rows ------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Some rows at a time, ``width`` distances a row being held at most."""
    rows = max(16, HELD // max(1, width))
    for batch in batches:
        x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
        for at in range(0, len(x), rows):
            yield x[at : at + rows]


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, a row per centre."""
    if x.shape[1] <= 8:
        out = np.zeros((len(centers), len(x)))
        for d in range(x.shape[1]):
            off = centers[:, d, None] - x[None, :, d]
            off *= off
            out += off
        return out
    out = centers @ x.T
    out *= -2.0
    out += (centers * centers).sum(1)[:, None]
    out += (x * x).sum(1)[None, :]
    return np.maximum(out, 0.0, out=out)


def _closest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the first of the closest centres, and its squared distance."""
    off = _distances(x, centers)
    best, where = off[0], np.zeros(len(x), np.int32)
    for j in range(1, len(centers)):
        np.copyto(where, j, where=off[j] < best)
        np.minimum(best, off[j], out=best)
    return where, best


def _gains(x: np.ndarray, centers: list[np.ndarray]) -> np.ndarray:
    """Sums of a block by centre: per centre rows, distances and coordinates, of all fits one after the other."""
    out = []
    facts = np.column_stack([np.ones(len(x)), np.empty(len(x)), x])
    for c in centers:
        where, facts[:, 1] = _closest(x, c)
        member = (where == np.arange(len(c), dtype=np.int32)[:, None]).astype(float)
        out.append((member @ facts).ravel())
    return np.concatenate(out)


def _summed(points: DataFrame, width: int, gains: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of what ``gains`` returns for blocks of rows; one value per place reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches, width):
            own = gains(x)
            total = own if total is None else total + own
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], len(total)))], ["place", "value"])

    found = points.mapInArrow(run, "place long, value double")
    # place -1 holds the number of places
    values = found.groupBy("place").agg(F.when(F.col("place") < 0, F.max("value")).otherwise(F.sum("value")).alias("value")).collect()
    of = {r["place"]: r["value"] for r in values}
    out = np.zeros(int(of.pop(-1)))
    for at, value in of.items():
        out[at] = value
    return out


def _rows(points: DataFrame, width: int, taken: Callable[[int], Callable[[int, np.ndarray], list[tuple[int, np.ndarray]]]]) -> list[tuple]:
    """``(owner, partition, row, vector)`` of the rows that ``taken`` picks, in this order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        pick = taken(part)
        for x in _blocks(batches, width):
            for owner, rows in pick(at, x):
                if len(rows):
                    same = lambda v, n=len(rows): pa.array(np.full(n, v), pa.int64())
                    vectors = pa.array(list(x[rows]), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([same(owner), same(part), pa.array(at + rows, pa.int64()), vectors], ["owner", "part", "row", "x"])
            at += len(x)

    found = points.mapInArrow(run, "owner long, part long, row long, x array<double>").collect()
    return sorted((r["owner"], r["part"], r["row"], tuple(r["x"])) for r in found)


def _sizes(points: DataFrame) -> list[int]:
    """Rows of every partition; vectors have to be finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = odd = 0
        for x in _blocks(batches, 1):
            rows, odd = rows + len(x), odd + int((~np.isfinite(x)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (TaskContext.get().partitionId(), rows, odd)], ["part", "rows", "odd"])

    found = points.mapInArrow(run, "part long, rows long, odd long").collect()  # a row per partition
    if any(r["odd"] for r in found):
        raise ValueError("vectors must not hold NaN or infinity")
    of = {r["part"]: r["rows"] for r in found}
    return [of.get(i, 0) for i in range(max(of, default=-1) + 1)]


# ---- starts --------------------------------------------------------------------------------


def _locally(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k-means++ and k-means of the weighted candidates."""
    rand = JavaRandom(0)
    reached = lambda v, r: int(np.searchsorted(np.cumsum(v), r, side="left")) + 1 if r > 0 else 0
    first = min(reached(weights, rand.double() * weights.sum()), len(points)) - 1
    centers = [points[first]]
    costs = _distances(points, points[first][None])[0]
    for _ in range(1, k):
        j = min(reached(weights * costs, rand.double() * (weights * costs).sum()), len(points))
        centers.append(points[max(j - 1, 0)])
        costs = np.minimum(costs, _distances(points, centers[-1][None])[0])
    out, old = np.array(centers), None
    for _ in range(LOCAL_ITERATIONS):
        where, _ = _closest(points, out)
        same, old = old is not None and bool((where == old).all()), where
        counts = np.bincount(where, weights, k)
        sums = np.column_stack([np.bincount(where, weights * points[:, d], k) for d in range(points.shape[1])])
        for j in range(k):
            out[j] = sums[j] / counts[j] if counts[j] else points[rand.below(len(points))]
        if same:
            break
    return out


def starts(points: DataFrame, jobs: list[tuple[int, int]], sizes: list[int]) -> list[np.ndarray]:
    """The first centres of every ``(k, seed)``: k-means||, all fits in the same passes."""
    seeds = list(dict.fromkeys(s for _, s in jobs))
    own = {s: XorShift(s).integer() for s in seeds}
    place = [sampled_place(sizes, own[s]) for s in seeds]

    def first(part: int):
        return lambda at, x: [(i, np.array([row - at])) for i, (p, row) in enumerate(place) if p == part and at <= row < at + len(x)]

    firsts = {seeds[owner]: np.array(x) for owner, _, _, x in _rows(points, 1, first)}
    centers = [firsts[s][None] for _, s in jobs]
    for step in range(START_STEPS):
        now, width = list(centers), max(map(len, centers))
        total = _summed(points, width, lambda x: np.array([_closest(x, c)[1].sum() for c in now]))

        def chosen(part: int, now=now, total=total, step=step):
            rand = {s: XorShift(_signed(own[s] ^ (step << 16) ^ part, 32)) for s in seeds}

            def pick(at: int, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
                drawn = {s: rand[s].doubles(len(x)) for s in seeds}
                out = []
                for i, (k, s) in enumerate(jobs):
                    if total[i] > 0:
                        out.append((i, np.flatnonzero(drawn[s] < 2.0 * _closest(x, now[i])[1] * k / total[i])))
                return out

            return pick

        found = _rows(points, width, chosen)
        centers = [np.array([*c, *[x for owner, _, _, x in found if owner == i]]) for i, c in enumerate(centers)]
    centers = [np.array(list(dict.fromkeys(map(tuple, c)))) for c in centers]
    many = [i for i, (k, _) in enumerate(jobs) if len(centers[i]) > k]
    if many:
        candidates = [centers[i] for i in many]
        counts = _summed(points, max(map(len, candidates)), lambda x: np.concatenate([np.bincount(_closest(x, c)[0], minlength=len(c)) for c in candidates]).astype(float))
        ends = np.cumsum([len(c) for c in candidates])
        for i, c, end in zip(many, candidates, ends):
            centers[i] = _locally(c, counts[end - len(c) : end], jobs[i][0])
    return centers


# ---- iterations ------------------------------------------------------------------------------


def fit_all(vectors: DataFrame, jobs: list[tuple[int, int]]) -> dict[tuple[int, int], Fit]:
    """K-means for every ``(k, seed)`` over the one array column of ``vectors``; read once per pass, so persist it."""
    share_package(vectors.sparkSession)
    sizes = _sizes(vectors)
    if not sum(sizes):
        raise ValueError("no rows to cluster")
    centers = starts(vectors, jobs, sizes)
    costs, active = [0.0] * len(jobs), list(range(len(jobs)))
    for _ in range(ITERATIONS):
        if not active:
            break
        now = [centers[i] for i in active]
        found = _summed(vectors, max(map(len, now)), lambda x: _gains(x, now))
        at, going = 0, []
        for i, c in zip(active, now):
            own = found[at : at + len(c) * (c.shape[1] + 2)].reshape(len(c), -1)
            at += own.size
            full = own[:, 0] > 0  # a centre without rows stays
            moved = c.copy()
            moved[full] = own[full, 2:] / own[full, :1]
            centers[i], costs[i] = moved, float(own[:, 1].sum())
            if (((moved - c) ** 2).sum(1) > TOLERANCE**2).any():
                going.append(i)
        active = going
    return {job: Fit(c, cost) for job, c, cost in zip(jobs, centers, costs)}


def cluster_sizes(vectors: DataFrame, centers: list[np.ndarray]) -> list[np.ndarray]:
    """Rows per centre of every set of centres."""
    found = _summed(vectors, max(map(len, centers)), lambda x: np.concatenate([np.bincount(_closest(x, c)[0], minlength=len(c)) for c in centers]).astype(float))
    ends = np.cumsum([len(c) for c in centers])
    return [found[e - len(c) : e] for c, e in zip(centers, ends)]
