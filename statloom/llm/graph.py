"""Connected components of a link table, by alternating star contraction.

Each round replaces every node's links by links to its smallest neighbour, first among larger
neighbours, then among smaller ones, until only stars remain. A round is two joins on a node and a
salt, so that the links of a hub are read by several tasks, and its least neighbour is combined before it
moves. The joins are merge joins: no table of a round goes through the driver. Every round is cut by a
reliable checkpoint, so a lost executor costs one round at most. Nothing but three sums per round reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import checkpointed


SALTS = 8  # parts that a node's links are dealt to


def _salted(links: DataFrame, node: str, other: str, lows: DataFrame) -> DataFrame:
    """``links`` with the row of ``lows`` for their ``node``, which is sent to every part."""
    dealt = links.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    everywhere = lows.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return dealt.join(everywhere.hint("merge"), [node, "salt"]).drop("salt")


def _facts(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))"), F.expr("bit_xor(xxhash64(b, a))")).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    NULL ends and self-links are ignored, repeated links count once, no links give no rows.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = checkpointed(ordered.distinct())
    before = _facts(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted(both, "u", "v", nearest).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = _salted(large, "a", "b", lowest).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        after = _facts(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
