"""Totals over JSON documents that map names to numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact_sums import exact_sum


def map_total(parsed: Column, value_type: str = "double") -> Column:
    """Sum over a map's values; 0 for an empty map, null where the map or a value is null.

    A JSON object that repeats a name counts the last value only.
    """
    names = F.map_keys(parsed)
    zero = F.lit(0).cast(value_type)
    plain = F.aggregate(F.map_values(parsed), zero, lambda total, value: total + value)
    entries = F.arrays_zip(
        names.alias("name"),
        F.sequence(F.lit(1), F.size(names)).alias("at"),
        F.map_values(parsed).alias("value"),
    )
    # Sorted by name and place, the last entry of a name is the one before another name.
    ordered = F.array_sort(entries)
    following = F.slice(ordered, 2, F.size(ordered))
    last_values = F.zip_with(
        ordered,
        following,
        lambda e, after: F.when(
            after.isNull() | (after["name"] != e["name"]), F.struct(e["value"].alias("value"))
        ),
    )
    repeated = F.aggregate(
        F.filter(last_values, lambda e: e.isNotNull()), zero, lambda total, entry: total + entry["value"]
    )
    return F.when(F.size(F.array_distinct(names)) < F.size(names), repeated).otherwise(plain)


def total_line(total: Column, text: str = "Total order value is: %.2f") -> Column:
    """The total as a line of text, with two decimals."""
    return F.format_string(text, total.cast("double"))


def json_map_totals(df: DataFrame, column: str, value_type: str = "double") -> DataFrame:
    """One row: the sum over all documents, its line of text, and how many documents count.

    Malformed documents, and those with a value that is no number, add nothing and are counted;
    null documents are only left out.
    """
    totals = _document_totals(df, column, value_type)
    return totals.agg(F.sum("document_total").alias("total_order_value"), *_counts()).withColumn(
        "message", total_line(F.col("total_order_value"))
    )


def json_map_exact_totals(df: DataFrame, column: str) -> DataFrame:
    """As :func:`json_map_totals` for doubles, whose sum over the documents is exact and rounded once.

    So the order and partitioning of the documents change no bit of the result. Within a document values are added in
    the order in which they stand.
    """
    totals = _document_totals(df, column, "double")
    total = exact_sum(totals, "document_total", output="total_order_value")
    counts = totals.agg(*_counts())
    # Two rows with different columns become one.
    both = total.unionByName(counts, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns]).withColumn("message", total_line(F.col("total_order_value")))


def _document_totals(df: DataFrame, column: str, value_type: str) -> DataFrame:
    parsed = F.from_json(F.col(column), f"map<string,{value_type}>")
    # Parsed in a step of its own: each document once, however often the total refers to it.
    return df.select(F.col(column).isNotNull().alias("given"), parsed.alias("parsed")).select(
        "given", map_total(F.col("parsed"), value_type).alias("document_total")
    )


def _counts() -> list[Column]:
    invalid = F.col("given") & F.col("document_total").isNull()
    return [F.count("document_total").alias("valid_documents"), F.count_if(invalid).alias("invalid_documents")]
