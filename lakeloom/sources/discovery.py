"""Schema discovery: infer the schema of a folder once and register it as a table."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalog import quote_name, quote_part, quote_text, set_table_properties
from lakeloom.storage import as_given, first_folder, subfolders

# An inferred type says what the rows seen fit in. The wider type of the same family holds the
# values that a later file may bring.
_WIDER = {T.ByteType(): T.LongType(), T.ShortType(): T.LongType(), T.IntegerType(): T.LongType(),
          T.FloatType(): T.DoubleType()}


def _widen(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_widen(data_type.elementType), True)
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _widen(f.dataType), True) for f in data_type])
    return _WIDER.get(data_type, data_type)


def infer_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
) -> T.StructType:
    """Infer the columns of a folder, ``key=value`` folder columns included.

    Text formats are read in full, so that no column and no wider type of any file is missed;
    Parquet and ORC carry their schema.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    place = as_given(path)
    if fmt not in ("csv", "json"):
        return reader.load(place).schema
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    data = _widen(reader.load(place).schema)
    folders = folder_columns(spark, path)
    if not folders:
        return data
    data = T.StructType([field for field in data if field.name not in folders])
    return spark.read.format(fmt).options(**(options or {})).schema(data).load(place).schema


def folder_columns(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names of the ``key=value`` folder levels below ``path``, by one descent."""
    names, folder = [], path.rstrip("/")
    while folder := first_folder(spark, folder, "="):
        names.append(folder.rsplit("/", 1)[1].split("=", 1)[0])
    return tuple(names)


def discover_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    description: str | None = None,
) -> DataFrame:
    """Infer the schema of ``path`` and register the files, where they lie, as ``table``.

    ``key=value`` folders become partition columns. An earlier registration of the name is replaced,
    but a table that owns its files is not: that is an error, and so is a path with pattern
    characters. Files are never touched. Text formats read in FAILFAST mode, and a file whose header
    differs from the table's columns in name or order stops the query; :func:`read_mixed_headers`
    reads such folders by name.
    """
    options = dict(options or {})
    if fmt in ("csv", "json"):
        options.setdefault("mode", "FAILFAST")
    if fmt == "csv" and str(options.get("header", "false")).lower() == "true":
        options.setdefault("enforceSchema", "false")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} owns its files; drop it before registering others by its name")
    if as_given(path) != path:
        raise ValueError(f"Spark registers no table over {path}: it would read it as a pattern")
    schema = infer_schema(spark, path, fmt, options)
    partitions = folder_columns(spark, path)
    names = quote_name(table)
    columns = ", ".join(f"{quote_part(f.name)} {f.dataType.simpleString()}" for f in schema)
    statement = f"CREATE TABLE {names} ({columns}) USING {fmt}"
    if options:
        pairs = ", ".join(f"{quote_text(k)} {quote_text(v)}" for k, v in options.items())
        statement += f" OPTIONS ({pairs})"
    if partitions:
        statement += f" PARTITIONED BY ({', '.join(map(quote_part, partitions))})"
    if description is not None:
        statement += f" COMMENT {quote_text(description)}"
    spark.sql(f"DROP TABLE IF EXISTS {names}")
    spark.sql(f"{statement} LOCATION {quote_text(path)}")
    if partitions:
        spark.sql(f"ALTER TABLE {names} RECOVER PARTITIONS")
    set_table_properties(spark, table, {"discovered_from": path})
    return spark.table(table)


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of delimited text that holds the values of both: a step of a fold in any order.

    Whole numbers widen to ``bigint`` and further to ``double``, dates to times; any other pair is text. A column
    without values is as the other.
    """
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
    pair = {_ladder(a), _ladder(b)}
    if pair <= {"whole"}:
        return T.LongType()
    if pair <= {"whole", "real"}:
        return T.DoubleType()
    if pair <= {"date", "time"}:
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()


def _ladder(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        # Spark infers a decimal for whole numbers beyond a long.
        return "real"
    names = {"whole": "tinyint smallint int bigint", "real": "float double", "date": "date", "time": "timestamp timestamp_ntz"}
    return next((name for name, kinds in names.items() if kind.simpleString() in kinds.split()), "other")


def header_groups(spark: SparkSession, folders: Sequence[str], options: Mapping[str, str] | None = None) -> dict[str, list[str]]:
    """The files of some folders of headed text by their first line; files without any line are left out.

    One distributed pass finds the first line that is not blank in each file: files are read in parallel, and a
    task sends one line per file it starts. The driver receives a path and a line per file.
    Paths come as URIs and are given back as Spark takes them.
    """
    reader = spark.read
    for name, value in (options or {}).items():
        if name.lower() in ("linesep", "pathglobfilter", "recursivefilelookup"):
            reader = reader.option(name, value)

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            paths, lines = batch.column(0), batch.column(1)
            for path in pc.unique(paths).to_pylist():
                if path not in seen:
                    seen.add(path)
                    # Splits are read in order, and the first row that is left of a file is its header.
                    at = pc.index(paths, path).as_py()
                    yield pa.RecordBatch.from_arrays([paths.slice(at, 1), lines.slice(at, 1)], ["path", "line"])

    # A file's header stands in its first block.
    lines = reader.text([as_given(folder) for folder in folders]).where("_metadata.file_block_start = 0 AND trim(value) <> ''")
    found = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    groups: dict[str, list[str]] = {}
    for row in found.mapInArrow(first_lines, "path string, line string").collect():
        groups.setdefault(row["line"].removeprefix("\ufeff"), []).append(unquote(row["path"]))
    return {line: sorted(paths) for line, paths in sorted(groups.items())}


def read_mixed_headers(
    spark: SparkSession, folders: Sequence[str], options: Mapping[str, str] | None = None
) -> DataFrame:
    """Headed text as one frame by column name, whatever the columns and order of each file's header.

    Files are grouped by header, each group's types are inferred, and types are merged by name with
    :func:`merge_types`; every group is then read with the merged types. So a folder may hold files of several headers, and
    columns that a file lacks are null for its rows. Files are read twice before the result is: for headers, for types.
    """
    settings = {"mode": "FAILFAST", "enforceSchema": "false", **(options or {}), "header": "true"}
    groups = header_groups(spark, folders, options)
    if not groups:
        return spark.createDataFrame([], T.StructType([]))
    schemas = {}
    for line, paths in groups.items():
        reader = spark.read.options(**settings).option("inferSchema", "true")
        schemas[line] = _widen(reader.csv([as_given(path) for path in paths]).schema)
    merged: dict[str, T.DataType] = {}
    for field in (field for schema in schemas.values() for field in schema):
        merged[field.name] = merge_types(merged.get(field.name, T.NullType()), field.dataType)
    frames = []
    for line, paths in groups.items():
        schema = T.StructType([T.StructField(f.name, merged[f.name]) for f in schemas[line]])
        frames.append(spark.read.options(**settings).schema(schema).csv([as_given(path) for path in paths]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def discover_tables(
    spark: SparkSession,
    database: str,
    prefix: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
) -> list[str]:
    """Register each folder right below ``prefix`` as a table named after it; gives the names.

    Folders whose name starts with ``_`` or ``.`` are passed over, as Spark does. Two folders that
    come to the same table name are an error, before anything is registered.
    """
    names: dict[str, str] = {}
    for path in subfolders(spark, prefix.rstrip("/")):
        folder = path.rsplit("/", 1)[1]
        name = f"{database}.{re.sub('[^a-z0-9_]+', '_', folder.lower())}"
        if name in names:
            raise ValueError(f"{names[name]} and {path} would both be {name}")
        names[name] = path
    for name, path in names.items():
        discover_table(spark, name, path, fmt, options)
    return list(names)
