"""Request-style filters: ranges, wildcards and searches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from larder.functions.text import contains_ci


def within(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Inclusive ranges on several columns; an open end is None."""
    for column, (low, high) in ranges.items():
        if low is not None:
            df = df.where(F.col(column) >= F.lit(low))
        if high is not None:
            df = df.where(F.col(column) <= F.lit(high))
    return df


def matching(df: DataFrame, values: Mapping[str, str | None], wildcard: str = "All") -> DataFrame:
    """Equality per column, skipped when the value is the wildcard or None."""
    for column, value in values.items():
        if value is not None and value != wildcard:
            df = df.where(F.col(column) == F.lit(value))
    return df


def searching(df: DataFrame, queries: Mapping[str, str | None]) -> DataFrame:
    """Literal case-insensitive contains per column; empty queries are skipped."""
    for column, query in queries.items():
        if query:
            df = df.where(contains_ci(F.col(column), query))
    return df


def excluding(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """NOT IN; a null value is dropped too, as in SQL."""
    return df.where(~F.col(column).isin(list(values)))
