"""Joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_on(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    clash_suffix: str | None = None,
) -> DataFrame:
    """Equi-join on differently named keys; both keys stay.

    A column name found on both sides gets ``clash_suffix`` on the right, or is an error if none
    is given. The join strategy is Spark's: a side is broadcast only under its size threshold, and
    the partitions of a hot key are split at run time.
    """
    clashes = [name for name in right.columns if name in left.columns]
    if clashes:
        if clash_suffix is None:
            raise ValueError(f"columns on both sides: {clashes}")
        right = right.withColumnsRenamed({name: name + clash_suffix for name in clashes})
        if right_key in clashes:
            right_key += clash_suffix
        if set(left.columns) & set(right.columns):
            raise ValueError(f"the suffix {clash_suffix!r} leaves duplicate columns")
    return left.join(right, left[left_key] == right[right_key], how)


def join_using(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Join on equal names, each key once in the result, with one right row per key at most: no row is multiplied.

    Without ``order`` the right side must be unique per key. It is reduced to one row per key before the join, and a key of
    several rows that a left row meets is an error that names it. With ``order`` the first row in that order is
    taken; it should leave no ties. ``how`` is ``inner``, ``left`` or ``full``; a null in a key equals nothing, and a
    full join keeps right rows with such keys as they are. Other columns on both sides are an error.

    The right side is combined in each task before its shuffle, so a key that holds a third of it moves one row
    from each task, and the join that follows has no hot key on the right.
    """
    on = list(on)
    if how not in ("inner", "left", "full"):
        raise ValueError(f"{how} is none of inner, left and full")
    if clashes := sorted((set(left.columns) & set(right.columns)) - set(on)):
        raise ValueError(f"columns on both sides: {clashes}")
    present = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in on])
    others = [name for name in right.columns if name not in on]
    row = F.struct(*others) if others else F.struct(F.lit(True).alias("_present"))
    keyed = right.where(present)
    if order is None:
        n_rows = F.count(F.lit(1)).alias("_n")
        single = keyed.groupBy(*on).agg(n_rows, F.first(row).alias("_row"))
        named = F.concat_ws(", ", *[F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in on])
        several = F.raise_error(F.concat(F.lit("more than one row on the right for "), named))
        single = single.select(*on, F.when(F.col("_n") > 1, several).otherwise(F.col("_row")).alias("_row"))
    else:
        first = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
        single = keyed.withColumn("_first", first).where("_first = 1").select(*on, row.alias("_row"))
    joined = left.join(single, on, how).select(*on, *[name for name in left.columns if name not in on], *[F.col(f"_row.{name}").alias(name) for name in others])
    if how != "full":
        return joined
    apart = right.where(~present).select(*on, *others)
    return joined.unionByName(apart, allowMissingColumns=True)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values that no parent has, with the rows they stand in: ``(key, n_rows)``.

    Null keys are no orphans. Both sides are reduced to one row per key before the shuffle, so a
    key that fills a third of the child costs one row per task.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key")).distinct()
    return keys.join(parents, "key", "left_anti")
