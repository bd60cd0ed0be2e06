"""Compare rows that share a bucket of a multi-table index, block by block.

Rows enter once per table under their key there. A bucket of more than ``BLOCK`` rows is dealt to
blocks by a hash of the row, and every pair of blocks is a unit of work of its own, so no task holds
more than two blocks and no pair of rows is missed. What leaves a unit grows with its rows, not with
its pairs: for every row the number of rows it is linked with (each pair counted in the first table
that brings it together), and one link to the smallest row that it hangs together with in the unit.

Where only the links' components matter, a bucket begins with its smallest row, the leader: every
row is compared with it, once for all the tables in which the two meet, and of two rows that are linked
with it nothing is left to find. A bucket is compared further only if a row of it isn't, a crowded one
only in pairs of which one isn't, so a bucket of one template costs as much as it has rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import settle, share_package, tidy

BLOCK = 512
SQUARE, LED, CROSS = 0, 1, 2  # units: two blocks of a bucket, a leader and a block, rows apart from it and a block
ROW = ("rep", "mult", "payload", "codes")

Decide = Callable[[np.ndarray, np.ndarray], np.ndarray]  # rows of bytes a, b -> boolean matrix


def _roots(n: int, left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For every row the smallest name that it is joined with through the pairs."""
    low = names.copy()
    while True:
        before = low.copy()
        both = np.minimum(low[left], low[right])
        np.minimum.at(low, left, both)
        np.minimum.at(low, right, both)
        if (low == before).all():
            return low


def _unit(rep, mult, payload, codes, first, table: int, decide: Decide) -> tuple | None:
    """Counts and roots within one unit; ``first`` is None inside a block, else marks the first block's rows."""
    if first is None:
        left, right = np.nonzero(np.triu(decide(payload, payload), 1))
    else:
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        if not len(a) or not len(b):
            return None
        left, right = np.nonzero(decide(payload[a], payload[b]))
        left, right = a[left], b[right]
    if table and len(left):
        fresh = np.ones(len(left), dtype=bool)
        for at in range(0, len(left), 1 << 16):
            part = slice(at, at + (1 << 16))
            fresh[part] = ~(codes[left[part], :table] == codes[right[part], :table]).any(axis=1)
        counted = fresh
    else:
        counted = np.ones(len(left), dtype=bool)
    if not counted.any():
        return None  # its links have been found in earlier tables
    left, right = left[counted], right[counted]
    count = np.bincount(left, weights=mult[right], minlength=len(rep)) + np.bincount(right, weights=mult[left], minlength=len(rep))
    root = _roots(len(rep), left, right, rep)
    touched = np.flatnonzero(count > 0)
    return rep[touched], count[touched].astype(np.int64), root[touched]


def linked(rows: DataFrame, decide: Decide, block: int = BLOCK) -> DataFrame:
    """``(rep, n, root)`` parts from ``rows(rep long, mult long, payload binary, codes array<int>)``.

    ``codes`` are a row's keys, one per table; all rows have as many, and payloads of one length.
    The sum of ``n`` by ``rep`` is the weight of the rows linked with it; the links ``rep - root`` join
    whatever is linked. ``rep`` is distinct.
    """
    share_package(rows.sparkSession)
    whole = rows.select("rep", "mult", "payload", "codes", F.posexplode("codes").alias("t", "key"))
    crowded = whole.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    crowded = crowded.select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    # written first, so that its size is known: the rows move for the join only if it is large
    crowded = settle(crowded, "crowded")
    dealt = whole.join(crowded, ["t", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return _compared(_squared(dealt), decide, varied=False)


def joined(rows: DataFrame, decide: Decide, block: int = BLOCK) -> DataFrame:
    """``(rep, root)`` links that join whatever is linked, from ``rows`` as in ``linked``.

    Payloads may differ in length; ``decide`` gets arrays of bytes objects. Rows alone under a key stay
    where they are. A row and a leader are compared once, in however many tables they meet; a bucket
    whose rows are all linked with its leader moves no payload beyond that.
    """
    share_package(rows.sparkSession)
    keyed = rows.select("rep", F.posexplode("codes").alias("t", "key"))
    # payloads may be large, and most rows meet others in few tables
    shared = keyed.groupBy("t", "key").agg(F.min("rep").alias("leader"), F.max("rep").alias("high"), F.count("*").alias("n"))
    shared = shared.where("leader <> high").drop("high")
    within = settle(keyed.join(shared, ["t", "key"]).where("rep <> leader"), "within")
    pairs = settle(within.select("leader", "rep").distinct(), "leaders")
    long = pairs.groupBy("leader").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1")
    dealt = pairs.join(settle(long, "long-leaders"), "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    followers = dealt.select("rep", F.col("leader").alias("key"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("low"), F.lit(False).alias("first"))
    leaders = dealt.select("leader", "blocks").distinct()
    leaders = leaders.select(F.col("leader").alias("rep"), F.col("leader").alias("key"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("low"), F.lit(True).alias("first"))
    led = rows.join(followers.unionByName(leaders), "rep")
    led = led.select(F.lit(0).alias("t"), "key", F.lit(LED).alias("kind"), "low", F.lit(-1).alias("high"), "first", *ROW)
    led = settle(_compared(led, decide, varied=True).select("rep", "root"), "led")
    found = led.select("rep", F.col("root").alias("leader"))
    apart = settle(within.join(found, ["rep", "leader"], "left_anti").select("t", "key", "rep"), "apart")
    # in a bucket of two nothing is left to compare
    sizes = within.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = apart.groupBy("t", "key").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    sizes = settle(sizes.join(parts, ["t", "key"]), "open-buckets")
    if sizes.isEmpty():
        return led
    left = within.select("t", "key", "rep").join(sizes, ["t", "key"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    calm = _squared(rows.join(left.where("blocks = 1"), "rep"))
    crowds = left.where("blocks > 1")
    if sizes.where(F.col("n") > block).isEmpty():
        return led.unionByName(_compared(calm, decide, varied=True).select("rep", "root"))
    members = rows.join(crowds.join(apart.withColumn("apart", F.lit(True)), ["t", "key", "rep"], "left"), "rep")
    out, rest = members.where("apart"), members.where("apart is null")
    among = _squared(out.withColumn("blocks", F.col("parts")))
    part, own = (F.pmod(F.xxhash64("rep"), F.col(c)).cast("int") for c in ("parts", "blocks"))
    sent = out.withColumn("high", F.explode(F.expr("sequence(0, blocks - 1)"))).select("t", "key", F.lit(CROSS).alias("kind"), part.alias("low"), "high", F.lit(True).alias("first"), *ROW)
    met = rest.withColumn("low", F.explode(F.expr("sequence(0, parts - 1)"))).select("t", "key", F.lit(CROSS).alias("kind"), "low", own.alias("high"), F.lit(False).alias("first"), *ROW)
    units = calm.unionByName(among).unionByName(sent).unionByName(met)
    return led.unionByName(_compared(units, decide, varied=True).select("rep", "root"))


def _squared(dealt: DataFrame) -> DataFrame:
    """Units of all pairs of blocks of a bucket, of which there are ``blocks``."""
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    return dealt.select("t", "key", F.lit(SQUARE).alias("kind"), low, high, (F.col("own") <= F.col("other")).alias("first"), *ROW)


def _compared(units: DataFrame, decide: Decide, varied: bool) -> DataFrame:
    """The counts and links of all units; a unit is what agrees in its first five columns."""
    unit = ["t", "key", "kind", "low", "high"]
    ranges = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(ranges, *unit).sortWithinPartitions(*unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        rest: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = got if rest is None else pa.concat_tables([rest, got])
            del batch, got
            out, rest = work(rest, False)
            if out is not None:
                yield out
            tidy()
        if rest is not None and rest.num_rows:
            out, _ = work(rest, True)
            if out is not None:
                yield out

    def work(table: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
        marks = [table.column(c).to_numpy() for c in unit]
        change = np.zeros(table.num_rows, dtype=bool)
        for m in marks:
            change[1:] |= m[1:] != m[:-1]
        edges = np.concatenate([[0], np.flatnonzero(change), [table.num_rows]])
        starts, ends = edges[:-1], edges[1:]
        if not last:  # the last unit may go on in the next batch
            starts, ends = starts[:-1], ends[:-1]
        keep = ends - starts > 1
        found = []
        if keep.any():
            rep, mult = table.column("rep").to_numpy(), table.column("mult").to_numpy().astype(np.float64)
            first = table.column("first").to_numpy()
            for s, e in zip(starts[keep].tolist(), ends[keep].tolist()):
                part = table.slice(s, e - s)
                values = part.column("payload").to_pylist()
                payload = np.array([*values, None], dtype=object)[:-1] if varied else np.frombuffer(b"".join(values), dtype=np.uint8).reshape(e - s, -1)
                codes = part.column("codes").combine_chunks().flatten().to_numpy().reshape(e - s, -1)
                within = marks[2][s] == SQUARE and marks[3][s] == marks[4][s]
                # a leader's links all count: they say who needn't be compared with others
                table_of = 0 if marks[2][s] == LED else int(marks[0][s])
                got = _unit(rep[s:e], mult[s:e], payload, codes, None if within else first[s:e], table_of, decide)
                if got is not None:
                    found.append(got)
        out = None
        if found:
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=pa.int64()) for c in zip(*found)], names=["rep", "n", "root"])
        return out, table.slice(int(edges[-2]) if not last and len(edges) > 1 else table.num_rows)

    return units.mapInArrow(run, "rep long, n long, root long")
