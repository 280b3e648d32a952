"""Published tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lakeloom.catalog import (
    describe_table,
    drop_table,
    quote_name,
    quote_part,
    quote_text,
    set_table_properties,
    table_location,
    table_properties,
)
from lakeloom.storage import delete_folder, glob_paths

#: The property of a published view that names the table of its present version.
VERSION_PROPERTY = "lakeloom.version"


def publish_table(
    df: DataFrame,
    table: str,
    path: str,
    description: str | None = None,
    properties: Mapping[str, str] | None = None,
    column_comments: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` as Parquet and make it the contents of ``table``, replacing what was there.

    Each call writes a new version folder below ``path`` and registers it once the write is complete.
    So a frame that reads the table's present contents can replace them, and a failed write leaves the
    table as it was. An unpartitioned table with the same columns, description and properties is
    pointed at the new folder, and a reader sees the one version or the other; any other change drops
    the registration and creates it anew, which leaves a moment without the table, and nothing of the old
    description or properties. A table that owns its files is never replaced.

    ``partition_by`` writes ``key=value`` folders, which filters on those columns prune.
    """
    spark = df.sparkSession
    unknown = set(column_comments or {}) - set(df.columns)
    if unknown:
        raise ValueError(f"comments on columns that do not exist: {sorted(unknown)}")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} owns its files; drop it before publishing by its name")
    version = f"{path.rstrip('/')}/version-{uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(version)

    texts = (description, properties or {}, column_comments or {})
    if not partition_by and _is_same(spark, table, df, *texts):
        spark.sql(f"ALTER TABLE {quote_name(table)} SET LOCATION {quote_text(version)}")
        spark.catalog.refreshTable(table)
        return spark.table(table)
    drop_table(spark, table)
    columns = ", ".join(f"{quote_part(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    by = f" PARTITIONED BY ({', '.join(map(quote_part, partition_by))})" if partition_by else ""
    place = f"LOCATION {quote_text(version)}"
    spark.sql(f"CREATE TABLE {quote_name(table)} ({columns}) USING parquet{by} {place}")
    if partition_by:
        spark.sql(f"ALTER TABLE {quote_name(table)} RECOVER PARTITIONS")
    describe_table(spark, table, description, column_comments)
    set_table_properties(spark, table, dict(properties or {}))
    return spark.table(table)


def _is_same(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    description: str | None,
    properties: Mapping[str, str],
    column_comments: Mapping[str, str],
) -> bool:
    """Is there such an unpartitioned table, with these columns, texts and properties?"""
    if not _has_columns(spark, table, df):
        return False
    columns = spark.catalog.listColumns(table)
    if any(column.isPartition for column in columns):
        return False
    comments = {column.name: column.description for column in columns if column.description}
    held = table_properties(spark, table)
    internal = ("comment", "spark.", "transient_")
    own = {name: value for name, value in held.items() if not name.startswith(internal)}
    return (
        (spark.catalog.getTable(table).description or None) == (description or None)
        and comments == dict(column_comments)
        and own == dict(properties)
    )


def _has_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    """Is there such a table over given files, with the columns of ``df``?"""
    if not spark.catalog.tableExists(table):
        return False
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        return False
    present = [(f.name, f.dataType) for f in spark.table(table).schema]
    return present == [(f.name, f.dataType) for f in df.schema]


def expire_versions(spark: SparkSession, table: str, path: str) -> None:
    """Delete the version folders the table has left behind; their readers must be done."""
    present = table_location(spark, table).rstrip("/").rsplit("/", 1)[1]
    for folder in glob_paths(spark, f"{path.rstrip('/')}/version-*"):
        if folder.rsplit("/", 1)[1] != present:
            delete_folder(spark, folder)


def publish_view(
    df: DataFrame,
    name: str,
    path: str,
    description: str | None = None,
    properties: Mapping[str, str] | None = None,
    column_comments: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` as a new version and make ``name`` a view of it: one statement, whatever has changed.

    Each call writes a version folder below ``path``, registers it as a table of its own, named after the view with a suffix, and
    gathers its statistics. Then the view is replaced. So a reader sees the one version or the other and never none, also
    when columns, texts or partitions change, and a failure before the last statement changes nothing. Descriptions,
    properties and comments are the view's. A name that is a table is never replaced.

    ``partition_by`` writes ``key=value`` folders. ``cluster_by`` deals rows to files by ranges of those columns and sorts
    them within, so that filters on them skip files and row groups by their least and largest values; statistics of these
    columns are gathered too.
    """
    spark = df.sparkSession
    unknown = (set(column_comments or {}) | set(partition_by) | set(cluster_by)) - set(df.columns)
    if unknown:
        raise ValueError(f"columns that do not exist: {sorted(unknown)}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; drop it before publishing a view by its name")
    ident = uuid4().hex
    version, table = f"{path.rstrip('/')}/version-{ident}", f"{name}__v{ident}"
    laid = df
    if cluster_by:
        by = [*partition_by, *cluster_by]
        laid = df.repartitionByRange(*by).sortWithinPartitions(*by)
    laid.write.partitionBy(*partition_by).parquet(version)
    try:
        columns = ", ".join(f"{quote_part(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        by = f" PARTITIONED BY ({', '.join(map(quote_part, partition_by))})" if partition_by else ""
        spark.sql(f"CREATE TABLE {quote_name(table)} ({columns}) USING parquet{by} LOCATION {quote_text(version)}")
        if partition_by:
            spark.sql(f"ALTER TABLE {quote_name(table)} RECOVER PARTITIONS")
        spark.sql(f"ANALYZE TABLE {quote_name(table)} COMPUTE STATISTICS")
        if cluster_by:
            spark.sql(f"ANALYZE TABLE {quote_name(table)} COMPUTE STATISTICS FOR COLUMNS {', '.join(map(quote_part, cluster_by))}")
    except Exception:
        drop_table(spark, table)
        delete_folder(spark, version)
        raise
    comments = column_comments or {}
    listed = ", ".join(
        quote_part(c) + (f" COMMENT {quote_text(comments[c])}" if c in comments else "") for c in df.columns
    )
    text = f" COMMENT {quote_text(description)}" if description is not None else ""
    held = {**(properties or {}), VERSION_PROPERTY: table}
    pairs = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in held.items())
    names = ", ".join(map(quote_part, df.columns))
    spark.sql(
        f"CREATE OR REPLACE VIEW {quote_name(name)} ({listed}){text} TBLPROPERTIES ({pairs})"
        f" AS SELECT {names} FROM {quote_name(table)}"
    )
    return spark.table(name)


def expire_view_versions(spark: SparkSession, name: str, path: str) -> None:
    """Drop the tables and folders of versions the view has left behind; their readers must be done."""
    present = table_properties(spark, name)[VERSION_PROPERTY]
    database, _, own = name.rpartition(".")
    for table in spark.catalog.listTables(database or None):
        full = f"{database}.{table.name}" if database else table.name
        if table.name.startswith(f"{own}__v") and full != present:
            drop_table(spark, full)
    kept = present.rpartition("__v")[2]
    for folder in glob_paths(spark, f"{path.rstrip('/')}/version-*"):
        if folder.rsplit("/version-", 1)[1] != kept:
            delete_folder(spark, folder)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Give a lazy model a name SQL can use; nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df


def materialize_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Store a model and read it back by name."""
    return publish_table(df, table, path)
