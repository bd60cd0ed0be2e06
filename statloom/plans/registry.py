"""Registered queries and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# ---- SQL text helpers (for the SQL side only) ---------------------------------


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding by scaling, the same arithmetic the Spark side uses."""
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def f_tail(f: str, d1: str, d2: str, steps: int = 2000) -> str:
    """P(F > f) by Simpson integration of the beta density in angle form."""
    h = f"(atan(sqrt(({d1}) * ({f}) / ({d2}))) / {2 * steps})"
    norm = f"exp(lgamma((({d1}) + ({d2})) / 2.0) - lgamma(({d1}) / 2.0) - lgamma(({d2}) / 2.0)) * 2"
    weight = f"CASE WHEN i = 0 OR i = {2 * steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = f"pow(sin(i * {h}), ({d1}) - 1) * pow(cos(i * {h}), ({d2}) - 1)"
    total = f"list_sum(list_transform(range(0, {2 * steps + 1}), lambda i: {weight} * {density}))"
    return f"greatest(0.0, 1 - {norm} * {h} / 3 * {total})"


def t_tail(t: str, nu: str) -> str:
    """Two-sided t tail: t squared is F with one numerator degree of freedom."""
    return f_tail(f"({t}) * ({t})", "1.0", nu)


def chi2_tail(x: str, k: str, steps: int = 2000) -> str:
    h = f"(sqrt({x}) / {2 * steps})"
    weight = f"CASE WHEN i = 0 OR i = {2 * steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = f"pow(i * {h}, ({k}) - 1) * exp(-(i * {h}) * (i * {h}) / 2)"
    total = f"list_sum(list_transform(range(0, {2 * steps + 1}), lambda i: {weight} * {density}))"
    norm = f"2 / (pow(2, ({k}) / 2.0) * gamma(({k}) / 2.0))"
    return f"greatest(0.0, 1 - {norm} * {h} / 3 * {total})"
