"""Data tests. Each gives rows ``(model, column_name, test, failures)``; 0 failures is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import orphans
from lakeloom.operators.uniqueness import repeated_values


def _report(df: DataFrame, model: str, column: str, test: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        "failures",
    )


def _rows(counts: DataFrame, model: str, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Turn one row of counts into a row per test."""
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(column).alias("column_name"),
                F.lit(test).alias("test"),
                failures.cast("bigint").alias("failures"),
            )
            for column, test, failures in tests
        ]
    )
    return counts.select(F.inline(rows))


def unique(df: DataFrame, model: str, columns: str | Sequence[str]) -> DataFrame:
    """How many values, or combinations of values, occur more than once. Nulls do not count."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    present = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])
    repeated = (
        df.filter(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )
    return _report(repeated, model, ", ".join(columns), "unique", F.count(F.lit(1)))


def unique_by_hashes(df: DataFrame, model: str, columns: str | Sequence[str]) -> DataFrame:
    """:func:`unique` for a large table whose keys are mostly unique: packed hashes are shuffled, and only rows whose
    hash repeats. The first pass runs when this is called."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return _report(repeated_values(df, columns), model, ", ".join(columns), "unique", F.count(F.lit(1)))


def not_null(df: DataFrame, model: str, columns: str | Sequence[str]) -> DataFrame:
    """How many rows are null, for each of the columns, in one pass."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return _rows(counts, model, [(name, "not_null", F.col(name)) for name in columns])


def primary_key(df: DataFrame, model: str, column: str) -> DataFrame:
    """The tests ``unique`` and ``not_null`` of one column from one aggregation of the model."""
    present = F.col(column).isNotNull()
    counts = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .agg(
            F.count_if(present & (F.col("n_rows") > 1)).alias("repeated"),
            F.coalesce(F.sum(F.when(~present, F.col("n_rows"))), F.lit(0)).alias("missing"),
        )
    )
    return _rows(
        counts,
        model,
        [(column, "unique", F.col("repeated")), (column, "not_null", F.col("missing"))],
    )


def accepted_values(df: DataFrame, model: str, column: str, values: Sequence) -> DataFrame:
    """How many distinct values lie outside the list. Null passes."""
    outside = df.select(column).filter(~F.col(column).isin(*values)).distinct()
    return _report(outside, model, column, "accepted_values", F.count(F.lit(1)))


def model_tests(
    df: DataFrame,
    model: str,
    unique: Sequence[str | Sequence[str]] = (),
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The row, key and value tests of a model from one pass over it.

    ``unique`` names columns or combinations of columns, ``accepted`` the values a column may have. All are
    grouping sets of one aggregation, so the model is computed once and shuffled once, whatever the
    number of its tests; results are those of the functions for single tests.
    """
    keys = [[names] if isinstance(names, str) else list(names) for names in unique]
    accepted = dict(accepted or {})
    columns = list(dict.fromkeys([*(name for names in keys for name in names), *accepted]))
    sets = [list(names) for names in dict.fromkeys(map(tuple, [*keys, *([name] for name in accepted), []]))]
    place = {name: f"_key{i}" for i, name in enumerate(columns)}
    missing = {name: f"_null{i}" for i, name in enumerate(not_null)}
    flat = df.select(
        *[F.col(name).alias(place[name]) for name in columns],
        *[F.col(name).isNull().alias(missing[name]) for name in not_null],
    )
    counted = [F.count(F.lit(1)).alias("n_rows")]
    counted += [F.count_if(F.col(m)).alias(m) for m in missing.values()]
    if columns:
        chosen = [[F.col(place[name]) for name in names] for names in sets]
        grouped = flat.groupingSets(chosen, *[F.col(key) for key in place.values()])
        groups = grouped.agg(F.grouping_id().alias("_set"), *counted)
    else:
        groups = flat.agg(*counted).withColumn("_set", F.lit(0))

    def in_set(names: Sequence[str]) -> Column:
        mask = sum(1 << (len(columns) - 1 - i) for i, name in enumerate(columns) if name not in names)
        return F.col("_set") == mask

    tests = []
    for names in keys:
        present = reduce(lambda a, b: a & b, [F.col(place[name]).isNotNull() for name in names])
        repeated = in_set(names) & present & (F.col("n_rows") > 1)
        tests.append((", ".join(names), "unique", F.count_if(repeated)))
    for name in not_null:
        nulls = F.sum(F.when(in_set([]), F.col(missing[name])))
        tests.append((name, "not_null", F.coalesce(nulls, F.lit(0))))
    for name, values in accepted.items():
        outside = ~F.col(place[name]).isin(*values)
        tests.append((name, "accepted_values", F.count_if(in_set([name]) & outside)))
    counts = groups.agg(*[failures.alias(f"_test{i}") for i, (_, _, failures) in enumerate(tests)])
    results = [(column, test, F.col(f"_test{i}")) for i, (column, test, _) in enumerate(tests)]
    return _rows(counts, model, results)


def relationships(
    child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """How many rows have a key no parent has. Null keys pass."""
    missing = orphans(child, column, parent, parent_column)
    return _report(missing, model, column, "relationships", F.sum("n_rows"))


def report(*tests: DataFrame) -> DataFrame:
    """All tests of a run in one frame."""
    return reduce(DataFrame.unionByName, tests)
