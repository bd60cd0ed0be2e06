"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a key is hot when it holds more than 1/HOT_SHARE of the rows


def attach_by_key(df: DataFrame, lookup: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of rows with a one-row-per-key table that knows each key's row count.

    At most ``HOT_SHARE`` keys can be hot, so the hot part of the lookup has a proven
    size and is broadcast; every other key is shuffled and small.
    """
    hot = lookup.filter(F.col(count) * HOT_SHARE > total).drop(count)
    cold = lookup.filter(F.col(count) * HOT_SHARE <= total).drop(count)
    hot_rows = df.join(F.broadcast(hot), keys)
    cold_rows = df.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return hot_rows.unionByName(cold_rows)
