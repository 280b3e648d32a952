"""Sums of doubles that are exact until one last rounding, so that no order of the rows changes a bit.

Every value is a whole number times a power of two. Whole numbers of one power are added up as decimals, without
error and with a map-side combine; the few sums of a group are then put together and rounded once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Powers are rounded down to a multiple of this, so that a group has few of them.
STEP = 8
LOWEST = -1088


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2 ** -exponent`` in two steps, neither of which overflows or rounds."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent)


def split(value: Column) -> tuple[Column, Column]:
    """(exponent, whole): the finite double ``value`` is exactly ``whole * 2 ** exponent``; ``whole`` is a long."""
    size = F.abs(value)
    # The logarithm may be off by one near a power of two; a whole number of 54 + STEP bits has room for that, and
    # a double becomes a long without rounding.
    top = F.when(size > 0, F.floor(F.log2(size))).otherwise(0)
    exponent = F.greatest(F.floor((top - 53) / STEP) * STEP, F.lit(LOWEST)).cast("int")
    return exponent, _scaled(value, exponent).cast("long")


def _put_together() -> Callable[[list[str], list[tuple[int, int]]], float | None]:
    """Nested, so that workers need not import this package."""

    def put_together(special: list[str], sums: list[tuple[int, int]]) -> float | None:
        """The value of the sums, rounded once to the nearest double; infinities and NaN as IEEE adds them."""
        if special:
            return sum(map(float, special))
        if not sums:
            return None
        total = sum((Fraction(whole) * Fraction(2) ** exponent for exponent, whole in sums), Fraction(0))
        try:
            return float(total)
        except OverflowError:
            return math.inf if total > 0 else -math.inf

    return put_together


def exact_sum(df: DataFrame, column: str, keys: Sequence[str] = (), output: str = "total") -> DataFrame:
    """The sum of a column of doubles per group, exact and then rounded once; null values add nothing.

    A group without values has null, as for ``sum``; without keys there is one row. A group has at most some 270 different
    powers, so its last step is bounded whatever the number of its rows.
    """
    keys = list(keys)
    value = F.col(column).cast("double")
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    exponent, whole = split(value)
    parts = (
        df.select(
            *keys,
            F.when(finite, exponent).alias("_exponent"),
            F.when(finite, whole).alias("_whole"),
            F.when(value.isNotNull() & ~finite, value.cast("string")).alias("_special"),
        )
        .groupBy(*keys, "_exponent", "_special")
        .agg(F.sum(F.col("_whole").cast("decimal(20,0)")).alias("_whole"))
    )
    if not keys:
        parts = parts.withColumn("_all", F.lit(0))
    by = keys or ["_all"]
    schema = T.StructType([*[parts.schema[name] for name in by], T.StructField(output, T.DoubleType())])
    put_together, names = _put_together(), [f.name for f in schema]

    def table(key: tuple, part: pa.Table) -> pa.Table:
        special, sums = set(), []
        for exponent, text, whole in zip(*(part[name].to_pylist() for name in ("_exponent", "_special", "_whole")), strict=True):
            if text is not None:
                special.add(text)
            elif whole is not None:
                sums.append((exponent, int(whole)))
        total = pa.array([put_together(sorted(special), sums)], pa.float64())
        return pa.table([*(pa.array([value.as_py()], value.type) for value in key), total], names)

    totals = parts.groupBy(*by).applyInArrow(table, schema)
    if keys:
        return totals
    # One row also for a table without rows.
    return totals.agg(F.first(output).alias(output))
