"""Joins, paging, replay and roll-ups over session, run and event tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import name_col
from statloom.functions.prefix import fill_along, sequence_numbers


def with_children(parents: DataFrame, children: DataFrame, key: str, child_key: str | None = None) -> DataFrame:
    """Every parent with its children, also parents without any."""
    child_key = child_key or key
    side = children.withColumnRenamed(child_key, key) if child_key != key else children
    return parents.join(side, key, "left")


def ordered_children(parents: DataFrame, children: DataFrame, key: str, display: list[str]) -> DataFrame:
    """One parent's parts in display order."""
    return parents.join(children, key, "left").orderBy(name_col(key), *[name_col(c) for c in display])


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of an ordered listing."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def replay(events: DataFrame, condition: Column, order: list[str]) -> DataFrame:
    """The events of one session in their order."""
    return events.filter(condition).orderBy(*[name_col(c) for c in order])


def concatenate(tables: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(name_col(column)).filter(name_col(column).isNotNull()).distinct()


def session_rollup(sessions: DataFrame, tokens: str, done: Column) -> DataFrame:
    """One row: sessions, summed tokens, completed sessions."""
    return sessions.agg(
        F.count("*").alias("sessions"),
        F.coalesce(F.sum(name_col(tokens)), F.lit(0)).alias("total_tokens"),
        F.count_if(done).alias("completed"),
    )


def trace_rollup(traces: DataFrame, run: str, duration: str, tool_call: Column) -> DataFrame:
    """Per run: steps, total duration, tool calls."""
    return traces.groupBy(name_col(run)).agg(
        F.count("*").alias("steps"), F.sum(name_col(duration)).alias("total_duration"), F.count_if(tool_call).alias("tool_calls")
    )


def session_sequence(events: DataFrame, session: str, order: str, tie: str | None = None) -> DataFrame:
    """Number the events of every session from 1; one session may hold most of them."""
    return sequence_numbers(events, [session], order, "sequence_num", tie)


def sequence_gaps(events: DataFrame, session: str, number: str) -> DataFrame:
    """Sessions whose numbers are not consecutive, with missing and repeated counts."""
    n = name_col(number)
    per_number = events.groupBy(name_col(session), n).agg(F.count("*").alias("_c"))
    return (
        per_number.groupBy(name_col(session))
        .agg(
            F.min(n).alias("first_num"),
            F.max(n).alias("last_num"),
            (F.max(n) - F.min(n) + 1 - F.count("*")).alias("missing"),
            F.sum(F.col("_c") - 1).alias("repeated"),
        )
        .filter("missing > 0 OR repeated > 0")
    )


def span_durations(events: DataFrame, key: str, kind: str, start: str, end: str, when: str, tie: str) -> DataFrame:
    """Every start event with the next end event of its key and the seconds between.

    The next end is carried backwards along time by range, so nothing is paired up and a
    hot key is spread over many tasks.
    """
    marked = events.filter(name_col(kind).isin(start, end)).withColumn(
        "_end", F.when(name_col(kind) == end, name_col(when))
    )
    filled = fill_along(marked, "_end", when, [key], backward=True, tie=tie)
    starts = filled.filter(name_col(kind) == start)
    seconds = F.unix_micros(F.col("_end").cast("timestamp")) - F.unix_micros(name_col(when).cast("timestamp"))
    return starts.select(
        name_col(key), name_col(tie), name_col(when).alias("started"), F.col("_end").alias("ended"), (seconds / 1e6).alias("seconds")
    )
