"""Comparison of two tables as multisets of rows, whatever their order and partitioning.

Every row gets a 64-bit hash. Two levels of digests, a count and two sums per bucket of hashes, say where the
tables differ at all: first over coarse buckets, then over fine ones within those that differ. Only rows of fine
buckets that differ are shuffled and compared by value. Tables that are equal move a few numbers per task and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COARSE_BITS = 10
FINE_BITS = 10


def orderable(value: Column, kind: T.DataType) -> Column:
    """The value with every map as its entries in order of their keys: such values can be hashed and grouped."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(orderable(e["key"], kind.keyType).alias("key"), orderable(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType) and _has_map(kind):
        return F.transform(value, lambda e: orderable(e, kind.elementType))
    if isinstance(kind, T.StructType) and _has_map(kind):
        fields = [orderable(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def _text(value: Column, kind: T.DataType) -> Column:
    """A nested value as JSON text for hashing, so that a null and its place count; others as they are."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # One zero, as in a comparison of values.
        return F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return value


def row_hash(df: DataFrame, columns: Sequence[str], seed: int = 0) -> Column:
    """64-bit hash of a row's values; equal rows have equal hashes, and nulls count by their place."""
    values = [_text(orderable(F.col(name), df.schema[name].dataType), df.schema[name].dataType) for name in columns]
    nulls = [F.when(v.isNull(), F.lit(i)) for i, v in enumerate(values)]
    return F.xxhash64(F.lit(seed), F.concat_ws(",", *[n.cast("string") for n in nulls]), *values)


def _bucket(level_bits: int, skipped_bits: int = 0) -> Column:
    return F.shiftrightunsigned(F.shiftleft("_hash", skipped_bits), 64 - level_bits).cast("int")


def _digests(left: DataFrame, right: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """The buckets whose digests differ: count, sum of the hashes, sum of another hash of them."""

    def digest(rows: DataFrame) -> DataFrame:
        low, high = F.col("_hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("_hash", 32)
        mixed = F.xxhash64(F.lit(1), "_hash").bitwiseAND(0xFFFFFFFF)
        return rows.groupBy(*buckets).agg(
            F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.sum(mixed).alias("mixed")
        )

    names = ("n", "low", "high", "mixed")
    a, b = digest(left).alias("a"), digest(right).alias("b")
    joined = a.join(b, [F.col(f"a.{name}") == F.col(f"b.{name}") for name in buckets], "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")) for name in names])
    return joined.where(~same).select(*[F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in buckets])


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that stand more often in one table than in the other, with ``n_left`` and ``n_right``.

    Columns are matched by name; other names or types are an error. Nulls equal nulls, and maps with the same
    entries are equal. Empty where both hold the same rows equally often. Four counters per task and bucket are
    shuffled, then the rows of differing buckets only, summed up before; the driver receives nothing. A difference
    stays unseen only if 64-bit hashes of its rows collide.
    """
    kinds = {f.name: f.dataType for f in left.schema}
    if kinds != (others := {f.name: f.dataType for f in right.schema}):
        raise ValueError(f"the tables have columns {_differing(kinds, others)}")
    if clashes := {"n_left", "n_right", "_hash", "_coarse", "_fine"} & set(kinds):
        raise ValueError(f"columns named {sorted(clashes)} clash with those of the result")
    columns = left.columns

    def hashed(rows: DataFrame) -> DataFrame:
        return rows.select(*columns, row_hash(rows, columns).alias("_hash")).withColumns(
            {"_coarse": _bucket(COARSE_BITS), "_fine": _bucket(FINE_BITS, COARSE_BITS)}
        )

    a, b = hashed(left), hashed(right)
    # At most 2**10, then 2**20 rows of two numbers: a proven bound.
    coarse = F.broadcast(_digests(a, b, ["_coarse"]))
    fine = F.broadcast(
        _digests(*(rows.select("_hash", "_coarse", "_fine").join(coarse, "_coarse", "left_semi") for rows in (a, b)), ["_coarse", "_fine"])
    )
    values = {name: orderable(F.col(name), kind) for name, kind in kinds.items()}
    maps = [name for name, kind in kinds.items() if _has_map(kind)]

    def counted(rows: DataFrame, left_count: int) -> DataFrame:
        inside = rows.join(fine, ["_coarse", "_fine"], "left_semi")
        kept = [F.first(name).alias(f"_kept_{name}") for name in maps]
        groups = inside.select("*", *[values[name].alias(f"_key_{name}") for name in maps])
        keys = [f"_key_{name}" if name in maps else name for name in columns]
        return groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *kept).select(
            *keys, *[f"_kept_{name}" for name in maps], (F.col("n") * left_count).alias("n_left"), (F.col("n") * (1 - left_count)).alias("n_right")
        )

    keys = [f"_key_{name}" if name in maps else name for name in columns]
    both = counted(a, 1).unionByName(counted(b, 0)).groupBy(*keys).agg(
        F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"), *[F.first(f"_kept_{name}").alias(f"_kept_{name}") for name in maps]
    )
    shown = [F.col(f"_kept_{name}").alias(name) if name in maps else F.col(name) for name in columns]
    return both.where("n_left <> n_right").select(*shown, "n_left", "n_right")


def _differing(a: dict, b: dict) -> str:
    names = [name for name in dict.fromkeys([*a, *b]) if a.get(name) != b.get(name)]
    return ", ".join(f"{name} ({a[name].simpleString() if name in a else 'none'} and {b[name].simpleString() if name in b else 'none'})" for name in names)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Do both tables hold the same rows equally often?"""
    return differing_rows(left, right).isEmpty()


def assert_same_rows(left: DataFrame, right: DataFrame, shown: int = 20) -> None:
    """An error that shows some of the rows that differ; only those come to the driver."""
    found = differing_rows(left, right).limit(shown).collect()
    if found:
        listed = "\n".join(str(row.asDict()) for row in found)
        raise AssertionError(f"the tables differ, here in up to {shown} rows:\n{listed}")
