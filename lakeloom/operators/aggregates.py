"""Grouped aggregations and per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns, as ordinals in SQL would."""
    return df.groupBy(*df.columns[:n])


def conditional_sums(
    df: DataFrame,
    keys: Sequence[str],
    pivot: str,
    values: Sequence[str],
    amount: str,
    total: str = "total_amount",
) -> DataFrame:
    """One ``<value>_<amount>`` sum per listed pivot value, plus the sum over all rows.

    A group without rows for a value has null, not 0. Values outside the list count only in the
    total. The list is given, so there is one aggregation and no pass to find the values.
    """
    sums = [
        F.sum(F.when(F.col(pivot) == value, F.col(amount))).alias(f"{value}_{amount}")
        for value in values
    ]
    return df.groupBy(*keys).agg(*sums, F.sum(amount).alias(total))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, which should leave no ties.

    Spark applies the limit in each task before the shuffle as well as after it, so a key moves no
    more than one row from each task, however many it has.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
