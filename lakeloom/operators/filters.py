"""Filters and limits, all as column expressions that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals the value."""
    return df.filter(F.col(column) == value)


def filter_greater_than(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column is strictly greater than the value; nulls are dropped."""
    return df.filter(F.col(column) > value)


def filter_equals_and_suffix(
    df: DataFrame, column: str, value, suffix_column: str, suffix: str
) -> DataFrame:
    """Rows where one column equals a value and another ends with a suffix."""
    return df.filter((F.col(column) == value) & F.col(suffix_column).endswith(suffix))


def top_rows(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order. Each task keeps ``n`` rows; no full sort takes place."""
    return df.orderBy(*order_by).limit(n)
