"""Choosing a target, the task, and the columns that identify rows."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.exprs import present
from statloom.functions.roles import LOW_CARDINALITY, is_categorical, is_numeric
from statloom.operators.profile import value_counts

# Words that suggest a target, and names that suggest an identifier.
TARGET_WORDS = [
    "target",
    "label",
    "outcome",
    "class",
    "result",
    "churn",
    "promoted",
    "converted",
    "default",
    "survived",
    "approved",
    "y",
]
ID_NAMES = ["id", "index", "uuid"]
ID_NAME_SHARE = 0.9
ID_VALUE_SHARE = 0.98
SKETCH_ERROR = 0.05


@dataclass(frozen=True)
class ColumnFacts:
    rows: int
    distinct: dict[str, int]


def column_facts(df: DataFrame, exact: bool = False) -> ColumnFacts:
    """Row count and distinct counts of all columns.

    A sketch pass settles every column that is clearly on one side of the limits used
    here; only the others (or all with ``exact``) are counted exactly, in one more job.
    """
    estimate = df.agg(
        F.count("*").alias("n"),
        *[F.approx_count_distinct(present(df, c), SKETCH_ERROR).alias(f"d{i}") for i, c in enumerate(df.columns)],
    ).first()
    rows = estimate["n"]
    guess = {c: estimate[f"d{i}"] for i, c in enumerate(df.columns)}
    close = 1 + 5 * SKETCH_ERROR
    few = LOW_CARDINALITY * close
    many = min(ID_NAME_SHARE, ID_VALUE_SHARE) * rows / close
    unsure = [c for c, d in guess.items() if exact or d <= few or d >= many]
    if not exact:
        # numbers are never identifiers by value, so many distinct ones need no count
        unsure = [c for c in unsure if guess[c] <= few or not is_numeric(df.schema[c].dataType) or _id_name(c)]
    if unsure:
        counts = value_counts(df, unsure).groupBy("feature").agg(F.count("value").alias("d"))
        guess.update({r["feature"]: r["d"] for r in counts.collect()})  # a row per column
    return ColumnFacts(rows, guess)


def _id_name(column: str) -> bool:
    return column.lower() in ID_NAMES or column.lower().endswith("id")


def looks_like_id(df: DataFrame, column: str, facts: ColumnFacts) -> bool:
    """Identifier by name (and mostly distinct) or by nearly distinct non-numeric values."""
    distinct, rows = facts.distinct.get(column, 0), facts.rows
    if _id_name(column) and distinct > ID_NAME_SHARE * rows:
        return True
    return not is_numeric(df.schema[column].dataType) and rows > 10 and distinct >= ID_VALUE_SHARE * rows


def identifier_columns(df: DataFrame, facts: ColumnFacts | None = None) -> DataFrame:
    """One row per column: distinct values and whether it looks like an identifier."""
    facts = facts or column_facts(df, exact=True)
    rows = [(c, facts.distinct.get(c, 0), looks_like_id(df, c, facts)) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "feature string, n_unique long, looks_like_id boolean")


def detect_task(df: DataFrame, target: str, facts: ColumnFacts | None = None) -> str:
    """Classification for text, booleans and numbers with at most 20 values."""
    if is_categorical(df.schema[target].dataType):
        return "classification"
    facts = facts or column_facts(df.select(target))
    return "classification" if facts.distinct.get(target, 0) <= LOW_CARDINALITY else "regression"


def _named_like_target(name: str, legacy: bool) -> bool:
    if legacy:
        return any(w in name.lower() for w in TARGET_WORDS)
    tokens = [t for t in re.split(r"[^a-z0-9]+", name.lower()) if t]
    return any(t == w or (len(w) > 1 and w in t) for t in tokens for w in TARGET_WORDS)


def suggest_target(df: DataFrame, facts: ColumnFacts | None = None, legacy: bool = False) -> str | None:
    """Most plausible target: by name, then the last low-cardinality column, then numbers.

    The one-letter word counts only as a whole name part; ``legacy`` accepts it anywhere.
    """
    facts = facts or column_facts(df)
    candidates = [c for c in df.columns if not looks_like_id(df, c, facts)] or list(df.columns)

    def few(c: str) -> bool:
        return 2 <= facts.distinct.get(c, 0) <= LOW_CARDINALITY

    named = [c for c in candidates if _named_like_target(c, legacy) and few(c)]
    if named:
        return named[0]
    for wanted in (is_categorical, is_numeric):
        fitting = [c for c in candidates if wanted(df.schema[c].dataType) and few(c)]
        if fitting:
            return fitting[-1]
    numbers = [c for c in candidates if is_numeric(df.schema[c].dataType)]
    return (numbers or candidates or [None])[-1]


def with_known_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(present(df, target).isNotNull())
