"""Catalog operations: thin calls on the session catalog, no state of their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def quote_part(part: str) -> str:
    """Quote one identifier, dots and all."""
    return "`" + part.replace("`", "``") + "`"


def quote_name(name: str) -> str:
    """Quote a dotted identifier part by part."""
    return ".".join(map(quote_part, name.split(".")))


def quote_text(text: str) -> str:
    """Quote a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(
    spark: SparkSession, name: str, description: str | None = None, location: str | None = None
) -> None:
    """Create the database unless it is there; an existing one is left as it is."""
    statement = f"CREATE DATABASE IF NOT EXISTS {quote_name(name)}"
    if description is not None:
        statement += f" COMMENT {quote_text(description)}"
    if location is not None:
        statement += f" LOCATION {quote_text(location)}"
    spark.sql(statement)


def list_databases(spark: SparkSession) -> list[str]:
    return [database.name for database in spark.catalog.listDatabases()]


def database_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables of the database; session views, which Spark lists as well, are left out."""
    return [table.name for table in spark.catalog.listTables(database) if not table.isTemporary]


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(table)}")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    """Drop the database if it exists; one that still has tables needs ``cascade``."""
    mode = "CASCADE" if cascade else "RESTRICT"
    spark.sql(f"DROP DATABASE IF EXISTS {quote_name(name)} {mode}")


def table_description(spark: SparkSession, table: str) -> str | None:
    return spark.catalog.getTable(table).description


def column_descriptions(spark: SparkSession, table: str) -> dict[str, str | None]:
    return {column.name: column.description for column in spark.catalog.listColumns(table)}


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()
    return {row["key"]: row["value"] for row in rows}


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        pairs = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({pairs})")


def describe_table(
    spark: SparkSession,
    table: str,
    description: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> None:
    """Set the description of a table and of those columns that are given."""
    name = quote_name(table)
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {quote_text(description)}")
    for column, comment in (column_comments or {}).items():
        change = f"ALTER COLUMN {quote_part(column)} COMMENT {quote_text(comment)}"
        spark.sql(f"ALTER TABLE {name} {change}")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}")
    return rows.filter("col_name = 'Location'").first()["data_type"]
