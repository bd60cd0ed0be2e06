"""Collects every registered query."""

from __future__ import annotations

from statloom.plans import (  # noqa: F401
    cleaning_queries,
    describe_queries,
    event_queries,
    model_queries,
    profile_queries,
    statistics_queries,
)
from statloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
