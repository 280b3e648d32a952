"""File and catalog-table readers. Every reader takes its schema; only discovery infers one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalog import quote_part

Schema = str | T.StructType

# Fixed values that stand outside text: Unicode noncharacters. The first is a null, the others are
# the separator, quote and escape of text that has none; the writers refuse values that hold them.
NULL_MARK, NO_SEPARATOR, NO_QUOTE, NO_ESCAPE = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
# They stand for a line feed and a carriage return inside a value.
ESCAPED_BREAKS = "\ufdd4\ufdd5"


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan a table of the session catalog, ``database.table``."""
    return spark.table(table)


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: Schema,
    bad_lines: str | None = None,
) -> DataFrame:
    """Scan JSON-lines files from one path or a list of paths.

    A line that is no JSON, or a value that does not fit its type, is an error. ``bad_lines`` names a
    string column that keeps the raw line instead, with nulls for what could not be read.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if bad_lines is not None:
        given = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        schema = T.StructType([*given.fields, T.StructField(bad_lines, T.StringType())])
        reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=bad_lines)
    return reader.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], schema: Schema | None = None
) -> DataFrame:
    """Scan Parquet files; a given schema saves the footer-reading job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def delimited_options(
    sep: str = ",",
    header: bool = True,
    quoted: bool = True,
    record_sep: str | None = None,
    multiline: bool = False,
) -> dict[str, str]:
    """CSV reader options that give back exactly what the writers in ``sinks`` put down.

    A quote inside a value is doubled. ``quoted=False`` reads quote characters as plain text.
    ``multiline`` allows record breaks inside quoted values; such a file cannot be split between
    tasks, so keep it for data written in bounded files.
    """
    options = {
        "sep": sep,
        "header": str(header).lower(),
        "quote": '"' if quoted else "",
        "escape": '"' if quoted else "\\",
        "multiLine": str(multiline).lower(),
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        # An empty field is null, and so is the mark that stands for null where an empty line would
        # be lost. Being no text, it keeps a quoted empty string apart from null.
        "nullValue": NULL_MARK,
        "enforceSchema": "false" if header else "true",
        "mode": "FAILFAST",
    }
    if not quoted:
        # A lone backslash is data too: the escape character is one no text file holds.
        options["escape"] = NO_ESCAPE
    if record_sep is not None:
        options["lineSep"] = record_sep
    return options


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: Schema | None = None,
    breaks: str = "quoted",
    **options,
) -> DataFrame:
    """Scan delimited text; ``options`` as in :func:`delimited_options`.

    A header that does not name the schema's columns, or a value that does not fit its type, is an
    error rather than a null. Without a schema every column is a string, named by the header.
    ``breaks="escaped"`` reads what the writer put down so: a line is a record, files are split between tasks, and
    marks inside values become record breaks again.
    """
    if breaks not in ("quoted", "escaped"):
        raise ValueError(f"breaks are 'quoted' or 'escaped', not {breaks!r}")
    paths = paths if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**delimited_options(**options))
    found = (reader if schema is None else reader.schema(schema)).csv(paths)
    if breaks == "quoted":
        return found
    texts = [field.name for field in found.schema if isinstance(field.dataType, T.StringType)]
    return found.select(
        *[F.translate(quoted, ESCAPED_BREAKS, "\n\r").alias(name) if name in texts else F.col(quoted) for name, quoted in zip(found.columns, map(quote_part, found.columns), strict=True)]
    )


def read_seed(
    spark: SparkSession,
    path: str,
    schema: Schema,
    names: Sequence[str],
    **options,
) -> DataFrame:
    """Load a seed file whose header spells its columns differently, under our own names.

    ``schema`` uses the header's spelling, ``names`` lists the new names in the same order.
    """
    return read_delimited(spark, path, schema, **options).toDF(*names)


def select_over_file(
    spark: SparkSession,
    sql: str,
    path: str,
    schema: Schema | None = None,
    view: str = "s3object",
    **options,
) -> DataFrame:
    """Run SQL straight over a delimited file, which the statement calls ``s3object``.

    Filters and the column list reach the file scan. Without a schema all columns are strings.
    """
    read_delimited(spark, path, schema, **options).createOrReplaceTempView(view)
    return spark.sql(sql)


def inline_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: Schema | Sequence[str]
) -> DataFrame:
    """A small table from literal rows, for fixtures."""
    names = schema if isinstance(schema, str | T.StructType) else list(schema)
    return spark.createDataFrame(list(rows), names)
