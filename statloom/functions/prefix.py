"""Running sums, ranks and fills over one global order without a one-task window.

The order column is cut into value ranges; each range (per key) is scanned by its
own task and receives the totals of the ranges before it. Range limits are
constants, so a recomputed task always reproduces the same assignment.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.exprs import SEED, name_col

MAX_RANGES = 1 << 16
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 20
LONGEST = 256  # characters or bytes of a limit
IN_LINE = 64  # limits that are compared one by one, as a tree of conditions


def range_count(rows: int) -> int:
    """How many ranges keep about ``ROWS_PER_RANGE`` rows each."""
    return min(MAX_RANGES, int(rows) // ROWS_PER_RANGE + 1)


def _sampled(df: DataFrame, names: list[str], ranges: int, rows: int) -> list[tuple]:
    """Texts of the range limits, from about ``SAMPLES_PER_RANGE`` rows per range of the whole table.

    A row is taken with the same chance wherever it is, so the sample is as large however many
    partitions there are. Of long values the beginning decides: a limit needn't be a value that occurs.
    """
    cells = []
    for i, n in enumerate(names):
        dtype = df.schema[n].dataType
        text = F.hex(F.substring(name_col(n), 1, LONGEST)) if isinstance(dtype, T.BinaryType) else name_col(n).cast("string")
        short = F.substring(name_col(n), 1, LONGEST) if isinstance(dtype, (T.StringType, T.BinaryType)) else name_col(n)
        cells += [short.alias(f"c{i}"), (F.substring(text, 1, LONGEST) if isinstance(dtype, T.StringType) else text).alias(f"t{i}")]
    wanted = SAMPLES_PER_RANGE * ranges
    sample = df.select(*cells)
    if rows > wanted:
        sample = sample.where(F.rand(SEED) < wanted / rows)
    keys = [f"c{i}" for i in range(len(names))]
    # bounded: one task orders the sample, and every so many rows one goes to the driver
    placed = sample.withColumn("i", F.row_number().over(Window.orderBy(*keys))).withColumn("n", F.count("*").over(Window.partitionBy()))
    picked = placed.where(F.floor(F.col("i") * ranges / F.col("n")) > F.floor((F.col("i") - 1) * ranges / F.col("n")))
    rows_of = picked.where("i < n").orderBy("i").select(*[f"t{i}" for i in range(len(names))]).collect()
    return list(dict.fromkeys(tuple(r) for r in rows_of))


def _literal(value: str | None, dtype: T.DataType) -> Column:
    """A value of ``dtype`` from its text, the same in every session time zone."""
    if value is None:
        return F.lit(None).cast(dtype)
    return F.unhex(F.lit(value)) if isinstance(dtype, T.BinaryType) else F.lit(value).cast(dtype)


def _listed(values: list[str | None], dtype: T.DataType) -> Column:
    """An array of ``dtype`` from texts: one literal, whatever their number."""
    if isinstance(dtype, T.BinaryType):  # JSON has binary values in base64
        values = [None if v is None else base64.b64encode(bytes.fromhex(v)).decode() for v in values]
        return F.from_json(F.lit(json.dumps(values)), T.ArrayType(T.BinaryType()))
    return F.from_json(F.lit(json.dumps(values)), T.ArrayType(T.StringType())).cast(T.ArrayType(dtype))


def _range_of(place: Column, rows: list[tuple], types: list[T.DataType]) -> Column:
    """How many limits are not above ``place``."""
    if len(rows) <= IN_LINE:
        limits = [F.struct(*[_literal(v, t) for v, t in zip(row, types)]) for row in rows]

        def tree(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(place < limits[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

        return tree(0, len(limits))
    # binary search in constant arrays: from the highest power of two down, step on while the limit there isn't above
    columns = [_listed([r[i] for r in rows], t) for i, t in enumerate(types)]
    steps = F.array(*[F.lit(1 << k) for k in range(len(rows).bit_length() - 1, -1, -1)])

    def further(at: Column, step: Column) -> Column:
        limit = F.struct(*[F.get(c, at + step - 1) for c in columns])
        return F.when((at + step <= len(rows)) & (place >= limit), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def with_range(
    df: DataFrame, order: str, out: str = "_range", ranges: int | None = None, tie: str | None = None
) -> DataFrame:
    """Tag rows with their range of ``(order, tie)``; ranges hold about equally many rows.

    Any type that has an order will do; NULL comes first. With a ``tie`` a single order value that
    many rows share is cut as well.
    """
    rows = None
    if ranges is None:
        rows = df.count()
        ranges = range_count(rows)
    if ranges < 2:
        return df.withColumn(out, F.lit(0))
    names = [c for c in (order, tie) if c]
    limits = _sampled(df, names, ranges, df.count() if rows is None else rows)
    place = F.struct(*[name_col(n) for n in names])
    return df.withColumn(out, _range_of(place, limits, [df.schema[n].dataType for n in names]))


def _keyed(tagged: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Fold the keys into one struct, so that rows with a NULL key join as well."""
    if not keys:
        return tagged, ["_range"]
    return tagged.withColumn("_key", F.struct(*[name_col(k) for k in keys])), ["_key", "_range"]


def _attach(tagged: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    # Without keys there is one row per range, at most MAX_RANGES of them.
    return tagged.join(totals if "_key" in on else F.broadcast(totals), on)


def _before(on: list[str], descending: bool = False):
    step = F.col("_range").desc() if descending else F.col("_range")
    return Window.partitionBy(*on[:-1]).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)


def prefix_sums(
    df: DataFrame, order: str, sums: list[str], keys: list[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``<c>_upto``: the sum of ``c`` over all rows with order <= the row's (per key).

    ``df`` should already be aggregated to one row per (keys, order) value.
    """
    tagged, on = _keyed(with_range(df, order, ranges=ranges), list(keys))
    totals = tagged.groupBy(*on).agg(*[F.sum(name_col(c)).alias(f"_t_{c}") for c in sums])
    offsets = totals.select(
        *on, *[F.coalesce(F.sum(f"_t_{c}").over(_before(on)), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    inside = Window.partitionBy(*on).orderBy(name_col(order))
    return _attach(tagged, offsets, on).select(
        *[name_col(c) for c in df.columns],
        *[(F.sum(name_col(c)).over(inside) + F.col(f"_o_{c}")).alias(f"{c}_upto") for c in sums],
    )


def suffix_minimum(
    df: DataFrame, order: str, value: str, out: str, keys: list[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``out``: the minimum of ``value`` over all rows with order >= the row's (per key)."""
    tagged, on = _keyed(with_range(df, order, ranges=ranges), list(keys))
    lows = tagged.groupBy(*on).agg(F.min(name_col(value)).alias("_low"))
    later = lows.select(*on, F.min("_low").over(_before(on, descending=True)).alias("_later"))
    inside = Window.partitionBy(*on).orderBy(name_col(order).desc())
    return _attach(tagged, later, on).select(
        *[name_col(c) for c in df.columns],
        F.least(F.min(name_col(value)).over(inside), F.col("_later")).alias(out),
    )


def sequence_numbers(
    df: DataFrame,
    keys: list[str],
    order: str,
    out: str = "seq",
    tie: str | None = None,
    ranges: int | None = None,
    size: str | None = None,
) -> DataFrame:
    """Row numbers per key along ``order`` where one key may hold most of the rows.

    With ``size`` the key's number of rows is added as well.
    """
    tagged, on = _keyed(with_range(df, order, ranges=ranges, tie=tie), list(keys))
    counts = tagged.groupBy(*on).agg(F.count("*").alias("_n"))
    whole = F.sum("_n").over(Window.partitionBy(*on[:-1]))
    offsets = counts.select(
        *on, F.coalesce(F.sum("_n").over(_before(on)), F.lit(0)).alias("_o"), whole.alias("_size")
    )
    inside = Window.partitionBy(*on).orderBy(*[name_col(c) for c in (order, tie) if c])
    return _attach(tagged, offsets, on).select(
        *[name_col(c) for c in df.columns],
        (F.row_number().over(inside) + F.col("_o")).cast("long").alias(out),
        *([F.col("_size").alias(size)] if size else []),
    )


def fill_along(
    df: DataFrame,
    column: str,
    order: str,
    keys: list[str] = (),
    backward: bool = False,
    tie: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Carry the nearest earlier (or later) non-null value along ``order``."""
    tagged, on = _keyed(with_range(df, order, ranges=ranges, tie=tie), list(keys))
    place = F.struct(*[name_col(c) for c in (order, tie) if c])
    value = name_col(column)
    # min_by / max_by skip NULL positions and combine map-side: a hot key costs one
    # row per task here, and its rows are scanned by as many tasks as it has ranges.
    nearest = (F.min_by if backward else F.max_by)(value, F.when(value.isNotNull(), place))
    edges = tagged.groupBy(*on).agg(nearest.alias("_edge"))
    carry = edges.select(
        *on, F.last("_edge", ignorenulls=True).over(_before(on, descending=backward)).alias("_carry")
    )
    inside = Window.partitionBy(*on).orderBy(place.desc() if backward else place)
    local = F.last(value, ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = _attach(tagged, carry, on).withColumn("_local", local)
    return filled.select(
        *[F.coalesce("_local", "_carry").alias(c) if c == column else name_col(c) for c in df.columns]
    )
