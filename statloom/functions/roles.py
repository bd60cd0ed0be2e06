"""Column roles and readable type names, derived from the schema alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LOW_CARDINALITY = 20


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_categorical(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.BooleanType))


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_categorical(f.dataType)]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_datetime(f.dataType)]


def friendly_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if is_numeric(dtype):
        return "float"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if is_datetime(dtype):
        return "datetime"
    return "string"


def role(dtype: T.DataType) -> str:
    if is_numeric(dtype):
        return "numeric"
    if is_categorical(dtype):
        return "categorical"
    if is_datetime(dtype):
        return "datetime"
    return "other"


def column_roles(df: DataFrame) -> DataFrame:
    """One row per column with its position, role and readable type."""
    rows = [
        (i, f.name, role(f.dataType), friendly_type(f.dataType)) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, role string, dtype string")
