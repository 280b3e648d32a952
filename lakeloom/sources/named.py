"""Named source relations: a logical name stands for files plus the columns models expect.

Models only know the logical columns. Which files and physical columns stand behind a name is
declared here, so moving a source never touches a model.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.catalog import quote_name, quote_part

# Physical columns of the tables on disk.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


@dataclass(frozen=True)
class Source:
    """A logical relation: the table it reads and a SQL expression per logical column."""

    table: str
    columns: Mapping[str, str]


SOURCES = {
    "customers": Source(
        "customer",
        {
            "id": "c_custkey",
            "first_name": "split_part(c_name, '#', 1)",
            "last_name": "split_part(c_name, '#', 2)",
        },
    ),
    "orders": Source(
        "orders",
        {
            "id": "o_orderkey",
            "user_id": "o_custkey",
            "order_date": "o_orderdate",
            "status": "o_orderstatus",
        },
    ),
    # Amounts are whole cents, so sums are exact and stay on the primitive-long fast path.
    "payments": Source(
        "lineitem",
        {
            "order_id": "l_orderkey",
            "payment_method": "l_returnflag",
            "status": "l_linestatus",
            "amount": "cast(rint(l_extendedprice * 100) as bigint)",
        },
    ),
    "persons": Source("part", {"id": "p_partkey", "name": "p_name", "brand": "p_brand"}),
    "memberships": Source(
        "lineitem",
        {
            "person_id": "l_partkey",
            "organization_id": "l_suppkey",
            "role": "l_returnflag",
            "on_behalf_of_id": "l_linestatus",
            "start_date": "l_shipdate",
        },
    ),
    "organizations": Source(
        "supplier",
        {
            "id": "s_suppkey",
            "name": "s_name",
            "other_names": "array(named_struct('lang', 'en', 'name', s_name))",
            "identifiers": "array(named_struct('scheme', 'nation', 'identifier',"
            " cast(s_nationkey as string)))",
        },
    ),
    "contacts": Source(
        "customer",
        {"customer_id": "c_custkey", "name": "c_name", "title": "c_mktsegment"},
    ),
    "balances": Source(
        "customer",
        {"customer_id": "c_custkey", "cents": "cast(rint(c_acctbal * 100) as bigint)"},
    ),
    "status_changes": Source(
        "events",
        {
            "id": "user_id",
            "status": "event_type",
            "event_id": "event_id",
            "updated_at": "ts",
        },
    ),
}


def load_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Read a table by its name on disk."""
    return spark.read.schema(TABLES[table]).parquet(f"{base}/{table}.parquet")


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read a named source; unused columns and pushed filters are settled at the scan."""
    source = SOURCES[name]
    columns = [F.expr(sql).alias(logical) for logical, sql in source.columns.items()]
    return load_table(spark, base, source.table).select(*columns)


def create_source_view(spark: SparkSession, base: str, name: str, view: str) -> None:
    """Register a named source as a catalog view over its files; no data is copied."""
    source = SOURCES[name]
    columns = ", ".join(f"{sql} AS {quote_part(name)}" for name, sql in source.columns.items())
    files = quote_part(f"{base}/{source.table}.parquet")
    spark.sql(f"CREATE OR REPLACE VIEW {quote_name(view)} AS SELECT {columns} FROM parquet.{files}")
