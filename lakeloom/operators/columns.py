"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, old to new. A column that is not there, or a clash, is an error."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    result = [names.get(name, name) for name in df.columns]
    if len(set(result)) < len(result):
        raise ValueError(f"renaming gives duplicate columns: {result}")
    return df.withColumnsRenamed(dict(names))


def drop_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns, nested ones included; names that are not there are passed over."""
    return df.drop(*names)


def constant_column(df: DataFrame, name: str, value) -> DataFrame:
    """Add a column holding one value, or overwrite the column of that name."""
    return df.withColumn(name, F.lit(value))
