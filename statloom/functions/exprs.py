"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALPHA = 0.05
SEED = 42


def name_col(name: str) -> Column:
    """Column by exact name, safe for names holding dots, blanks or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def rnd(c: Column, digits: int) -> Column:
    """Half-even rounding by scaling, as array libraries do it."""
    scale = float(10**digits)
    return F.rint(c.cast("double") * scale) / scale


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of an error for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def as_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Double view of a numeric column where NaN counts as missing."""
    c = c.cast("double")
    if dtype is None or isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast("double"))
    return c


def number(df: DataFrame, name: str) -> Column:
    return as_number(name_col(name), df.schema[name].dataType)


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, type kept."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(name_col(name), F.lit(None).cast(dtype))
    return name_col(name)


def finite_or_null(c: Column) -> Column:
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL, timestamps and dates to ISO text."""
    out = []
    for field in df.schema.fields:
        c = name_col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = finite_or_null(c)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(field.name))
    return df.select(*out)


def p_text(p: Column) -> Column:
    """Display form of a p-value: three decimals, or ``<0.001``."""
    return F.when(p.isNull() | F.isnan(p), None).when(p < 0.001, "<0.001").otherwise(
        F.format_string("%.3f", p)
    )


def verdict(p: Column, alpha: float = ALPHA) -> Column:
    return F.when(p < alpha, "significant").otherwise("not significant")


def stack_rows(df: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """Turn one wide row into a row per entry of ``rows`` (no shuffle, no join)."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def melt(df: DataFrame, names: list[str], value: str, keep: list[str] = (), text: bool = False) -> DataFrame:
    """Long form ``(keep..., feature, value)`` of several columns, NULLs dropped."""
    cells = [
        F.struct(
            F.lit(n).alias("feature"),
            (present(df, n).cast("string") if text else number(df, n)).alias(value),
        )
        for n in names
    ]
    kept = [name_col(k) for k in keep]
    long = df.select(*kept, F.explode(F.array(*cells)).alias("cell"))
    return long.select(*kept, "cell.feature", f"cell.{value}").filter(F.col(value).isNotNull())


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the values of a one-row table (an ungrouped aggregate) to every row.

    The other side is a single row by construction, so this is a projection in effect:
    nothing is shuffled and no pairs are formed.
    """
    return df.crossJoin(F.broadcast(one_row))
