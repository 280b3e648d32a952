"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.catalog import create_database, database_exists, drop_table, list_databases, list_tables
from lakeloom.functions.json_maps import json_map_exact_totals, json_map_totals
from lakeloom.functions.money import cents_to_dollars as dollars
from lakeloom.functions.udfs import string_udf
from lakeloom.operators import compare, quality, reduced_joins
from lakeloom.operators.columns import constant_column
from lakeloom.operators.filters import (
    filter_equals,
    filter_equals_and_suffix,
    filter_greater_than,
    top_rows,
)
from lakeloom.operators.snapshots import SnapshotTable
from lakeloom.operators.translate import translate_column
from lakeloom.plans import jobs, models
from lakeloom.session import fit_shuffles
from lakeloom.sinks.files import write_delimited, write_json, write_parquet, write_unquoted
from lakeloom.sinks.tables import materialize_table, materialize_view, publish_table, publish_view
from lakeloom.sources import files
from lakeloom.sources.discovery import discover_table as discover
from lakeloom.sources.discovery import read_mixed_headers
from lakeloom.sources.named import TABLES, create_source_view, load, load_table
from lakeloom.storage import folder_bytes, scratch_path, set_file_times
from lakeloom.streaming.ingest import ingest_new_files, ingested
from lakeloom.streaming.ledger import LedgerIngest

# How the given tables play the models' roles: the status of a successful payment, the listed
# payment methods (a third one stays unlisted), and the accepted order statuses.
SUCCESS = "F"
METHODS = ("A", "N")
STATUSES = ("F", "O")

DATABASE = "lakeloom_scratch"

Query = Callable[[SparkSession, str], DataFrame]


def _paid(spark: SparkSession, base: str) -> DataFrame:
    return models.stg_payments(load(spark, base, "payments"), SUCCESS)


def _stub_translator() -> Callable:
    """A translator without a network; nested, so workers need not import this module."""

    def factory():
        return lambda texts: ["[en] " + text.replace("e", "E") for text in texts]

    return factory


def _scratch_database(spark: SparkSession) -> str:
    """A database for tables over given files; its own folder stays empty."""
    if not database_exists(spark, DATABASE):
        # In the warehouse, not in a scratch folder, which may be released before the database is used again.
        create_database(spark, DATABASE, "Tables of query runs")
    return DATABASE


def _sized(query: Query) -> Query:
    """The query with shuffles that fit the size of the given tables."""

    @wraps(query)
    def run(spark: SparkSession, base: str) -> DataFrame:
        fit_shuffles(spark, folder_bytes(spark, base))
        return query(spark, base)

    return run


# Staging and marts


def stg_customers(spark, base):
    return models.stg_customers(load(spark, base, "customers"))


def stg_payments(spark, base):
    return _paid(spark, base)


def stg_orders(spark, base):
    return models.stg_orders(load(spark, base, "orders"), _paid(spark, base))


def customer_order_bounds(spark, base):
    return models.customer_order_bounds(load(spark, base, "orders"))


def model_customer_orders(spark, base):
    return models.customer_orders(
        load(spark, base, "customers"), load(spark, base, "orders"), _paid(spark, base)
    )


def model_customer_orders_unique(spark, base):
    """One row per customer from a single aggregation."""
    return models.customer_orders_single(
        load(spark, base, "customers"), load(spark, base, "orders"), _paid(spark, base)
    )


def customer_orders_using(spark, base):
    """Amounts attached by customer and date."""
    return models.customer_orders_using(
        load(spark, base, "customers"), load(spark, base, "orders"), _paid(spark, base)
    )


def payment_method_pivot(spark, base):
    return models.order_payment_method_amounts(load(spark, base, "payments"), METHODS)


def payment_method_pivot_success(spark, base):
    return models.order_payment_method_amounts(
        load(spark, base, "payments"), (*METHODS, "R"), [SUCCESS]
    )


def views_sql(spark, base):
    """SQL text over the staging models as views."""
    materialize_view(stg_orders(spark, base), "stg_orders")
    materialize_view(stg_customers(spark, base), "stg_customers")
    return spark.sql(
        "SELECT status, count(*) AS n_orders, count(payment_amount) AS n_paid,"
        " sum(payment_amount) AS paid FROM stg_orders JOIN stg_customers USING (customer_id)"
        " GROUP BY 1"
    )


# Projections, filters, scalar functions


def cents_to_dollars(spark, base):
    balances = load(spark, base, "balances")
    return balances.select(
        "customer_id",
        dollars("cents").cast("double").alias("dollars"),
        dollars("cents", 1).cast("double").alias("dollars_rounded"),
    )


def filter_greater(spark, base):
    return filter_greater_than(load_table(spark, base, "lineitem"), "l_quantity", 20).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


def filter_suffix(spark, base):
    parts = load_table(spark, base, "part")
    return filter_equals_and_suffix(parts, "p_type", "ECONOMY", "p_name", "ring").select(
        "p_partkey", "p_name", "p_type"
    )


def filter_topk_constant(spark, base):
    contacts = filter_equals(load(spark, base, "contacts"), "title", "HOUSEHOLD")
    chosen = top_rows(contacts, ["customer_id"], jobs.REPORTED_ROWS)
    return constant_column(chosen, "companyname", jobs.COMPANY)


def json_map_total(spark, base):
    return json_map_totals(load_table(spark, base, "events"), "props", "bigint")


def json_map_total_double(spark, base):
    """Values of events as JSON maps of doubles; the sum is exact and rounded once."""
    events = load_table(spark, base, "events")
    document = F.to_json(F.create_map(F.col("event_type"), F.col("value")))
    totals = json_map_exact_totals(events.select(document.alias("document")), "document")
    return totals.select("total_order_value", "valid_documents", "invalid_documents")


# Joins


def entity_history(spark, base):
    return jobs.entity_history(
        load(spark, base, "persons"),
        load(spark, base, "memberships"),
        load(spark, base, "organizations"),
    )


def semi_join_reduced(spark, base):
    """The documents labelled good; their texts are not shuffled."""
    good = load_table(spark, base, "labels").filter("quality = 1")
    return reduced_joins.semi_join(load_table(spark, base, "documents"), good, ["doc_id"])


def anti_join_reduced(spark, base):
    """The order lines of parts that no household customer has ordered, by part and supplier."""
    lines, orders = load_table(spark, base, "lineitem"), load_table(spark, base, "orders")
    chosen = load_table(spark, base, "customer").filter("c_mktsegment = 'HOUSEHOLD'")
    theirs = reduced_joins.semi_join(orders, chosen, ["o_custkey"], ["c_custkey"])
    ordered = reduced_joins.semi_join(lines, theirs, ["l_orderkey"], ["o_orderkey"])
    return reduced_joins.anti_join(lines, ordered, ["l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


def compare_versions(spark, base):
    """Orders against a version with some rows changed, some left out and some twice."""
    orders = load_table(spark, base, "orders")
    key = F.col("o_orderkey")
    status = F.when(key % 97 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    times = F.when(key % 103 == 0, 2).when(key % 101 == 0, 0).otherwise(1)
    other = orders.withColumn("o_orderstatus", status).withColumn("times", times)
    other = other.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("times")))).drop("times", "copy")
    return compare.differing_rows(orders, other.repartition("o_custkey"))


# Sources, sinks, catalog


def scan_json(spark, base):
    path = scratch_path(spark, "events-json")
    write_json(load_table(spark, base, "events"), path)
    return files.read_json(spark, [path], TABLES["events"])


def nested_json_history(spark, base):
    """The history with organizations from JSON whose nested arrays the job drops."""
    path = scratch_path(spark, "organizations-json")
    write_json(load(spark, base, "organizations"), path)
    organizations = files.read_json(
        spark,
        path,
        "id bigint, name string, other_names array<struct<lang:string,name:string>>,"
        " identifiers array<struct<scheme:string,identifier:string>>",
    )
    return jobs.entity_history(
        load(spark, base, "persons"), load(spark, base, "memberships"), organizations
    )


def list_catalog(spark, base):
    """Register given tables in a database of their own, list it, and count each listed table."""
    database = "lakeloom_listed"
    create_database(spark, database)
    for name in ("customer", "orders", "part", "supplier"):
        table = f"{database}.{name}"
        drop_table(spark, table)
        schema = load_table(spark, base, name).schema
        spark.catalog.createTable(
            table, path=f"{base}/{name}.parquet", source="parquet", schema=schema
        )
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for name in list_tables(spark, database)
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_databases(spark, base):
    """Databases made for the query, found again in the list of databases, each with the rows of its tables."""
    wanted = {"lakeloom_sales": ("customer", "orders"), "lakeloom_goods": ("part", "supplier")}
    for database, names in wanted.items():
        create_database(spark, database)
        for name in names:
            table = f"{database}.{name}"
            drop_table(spark, table)
            schema = load_table(spark, base, name).schema
            spark.catalog.createTable(table, path=f"{base}/{name}.parquet", source="parquet", schema=schema)
    found = [name for name in list_databases(spark) if name in wanted]
    counts = [
        spark.table(f"{database}.{table}").agg(F.lit(database).alias("database"), F.count(F.lit(1)).alias("n"))
        for database in found
        for table in list_tables(spark, database)
    ]
    return reduce(DataFrame.unionByName, counts).groupBy("database").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("n").alias("n_rows")
    )


def scan_catalog_table(spark, base):
    table = f"{_scratch_database(spark)}.orders_files"
    drop_table(spark, table)
    schema = load_table(spark, base, "orders").schema
    spark.catalog.createTable(
        table, path=f"{base}/orders.parquet", source="parquet", schema=schema
    )
    return files.read_table(spark, table)


def load_seed(spark, base):
    path = scratch_path(spark, "customers-seed")
    seed = load(spark, base, "customers").toDF("ID", "FIRST_NAME", "LAST_NAME")
    write_delimited(seed, path, sep=",")
    return files.read_seed(
        spark,
        path,
        "ID bigint, FIRST_NAME string, LAST_NAME string",
        ["id", "first_name", "last_name"],
    )


def roundtrip_csv_pipe(spark, base):
    path = scratch_path(spark, "orders-unquoted")
    write_unquoted(load_table(spark, base, "orders"), path)
    return files.read_delimited(spark, path, TABLES["orders"], sep="|", quoted=False)


def roundtrip_csv_quoted(spark, base):
    """Documents hold separators, quotes and line breaks, which are escaped so that files can be split."""
    path = scratch_path(spark, "documents-quoted")
    write_delimited(load_table(spark, base, "documents"), path, breaks="escaped")
    return files.read_delimited(spark, path, TABLES["documents"], sep="|", breaks="escaped")


def roundtrip_parquet(spark, base):
    path = scratch_path(spark, "lineitem-parquet")
    write_parquet(load_table(spark, base, "lineitem"), path)
    return files.read_parquet(spark, path, TABLES["lineitem"])


def select_over_file(spark, base):
    path = scratch_path(spark, "orders-csv")
    write_delimited(load_table(spark, base, "orders"), path)
    return files.select_over_file(
        spark, "SELECT * FROM s3object", path, TABLES["orders"], sep="|", record_sep="\n"
    )


def roundtrip_one_text_column(spark, base):
    """Texts alone, some of them null, empty or blank: every row comes back."""
    documents = load_table(spark, base, "documents")
    odd = F.when(F.col("doc_id") % 5 == 1, F.lit("")).when(F.col("doc_id") % 5 == 2, F.lit("  "))
    text = F.when(F.col("doc_id") % 5 != 0, F.coalesce(odd, F.col("text")))
    path = scratch_path(spark, "texts")
    write_delimited(documents.select(text.alias("text")), path, breaks="escaped")
    return files.read_delimited(spark, path, "text string", sep="|", breaks="escaped")


def select_columns_over_file(spark, base):
    """A filter and a column list, which reach the scan of the text."""
    path = scratch_path(spark, "orders-csv")
    write_delimited(load_table(spark, base, "orders"), path)
    return files.select_over_file(
        spark,
        "SELECT o_orderkey, o_totalprice FROM s3object WHERE o_orderstatus = 'F'",
        path,
        TABLES["orders"],
        sep="|",
        record_sep="\n",
    )


def discover_mixed_headers(spark, base):
    """Two folders of text with the same columns in different orders."""
    parts = load_table(spark, base, "part")
    columns = ["p_partkey", "p_name", "p_size"]
    halves = [
        (parts.filter("p_partkey % 2 = 0"), columns),
        (parts.filter("p_partkey % 2 = 1"), columns[::-1]),
    ]
    paths = []
    for rows, names in halves:
        paths.append(scratch_path(spark, "part-csv"))
        write_delimited(rows.select(*names), paths[-1])
    return read_mixed_headers(spark, paths, files.delimited_options(sep="|"))


def discover_mixed_folder(spark, base):
    """One folder of files with three headers: two orders of columns, and one without the size."""
    parts = load_table(spark, base, "part")
    path = scratch_path(spark, "part-csv")
    headers = (["p_partkey", "p_name", "p_size"], ["p_size", "p_name", "p_partkey"], ["p_name", "p_partkey"])
    for i, names in enumerate(headers):
        write_delimited(parts.filter(F.col("p_partkey") % 3 == i).select(*names), path, mode="append")
    return read_mixed_headers(spark, [path], files.delimited_options(sep="|"))


def discover_table(spark, base):
    path = scratch_path(spark, "part-csv")
    write_delimited(load_table(spark, base, "part"), path)
    options = files.delimited_options(sep="|")
    return discover(spark, f"{_scratch_database(spark)}.part_files", path, "csv", options)


def publish_orders(spark, base):
    return publish_table(
        load_table(spark, base, "orders"),
        f"{_scratch_database(spark)}.orders_published",
        scratch_path(spark, "orders-published"),
        description="Orders, one row each.",
        properties={"source": "order service", "class": "sales"},
        column_comments={"o_orderkey": "Order number", "o_totalprice": "Price with tax"},
    )


def publish_partitioned(spark, base):
    """Orders in folders by status, of which a filter reads one."""
    table = publish_table(
        load_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        f"{_scratch_database(spark)}.orders_by_status",
        scratch_path(spark, "orders-by-status"),
        partition_by=["o_orderstatus"],
    )
    return table.filter("o_orderstatus = 'F'")


def publish_clustered(spark, base):
    """A view that is replaced twice, the second time with other columns; rows lie in ranges of their date."""
    orders = load_table(spark, base, "orders")
    name, path = f"{_scratch_database(spark)}.orders_view", scratch_path(spark, "orders-view")
    publish_view(orders.select("o_orderkey", "o_orderdate"), name, path, description="Orders by day.")
    columns = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"]
    view = publish_view(
        orders.select(*columns),
        name,
        path,
        description="Orders by status and day.",
        properties={"class": "sales"},
        column_comments={"o_totalprice": "Price with tax"},
        partition_by=["o_orderstatus"],
        cluster_by=["o_orderdate"],
    )
    return view.filter("o_orderdate >= '1997-01-01' AND o_orderdate < '1997-07-01'")


def materialize_model(spark, base):
    return materialize_table(
        payment_method_pivot(spark, base),
        f"{_scratch_database(spark)}.order_payment_method_amounts",
        scratch_path(spark, "order-payment-method-amounts"),
    )


# Data quality


def _models(spark, base):
    return {
        "customers": stg_customers(spark, base),
        "orders": stg_orders(spark, base),
        "mart": model_customer_orders(spark, base),
        "lines": load_table(spark, base, "lineitem"),
    }


def dq_unique(spark, base):
    m = _models(spark, base)
    return quality.report(
        quality.model_tests(m["customers"], "stg_customers", unique=["customer_id"]),
        quality.model_tests(m["orders"], "stg_orders", unique=["order_id"]),
        quality.model_tests(m["mart"], "customer_orders", unique=["customer_id"]),
        quality.model_tests(
            m["lines"], "lineitem", unique=["l_orderkey", ["l_orderkey", "l_linenumber"]]
        ),
    )


def dq_unique_by_hashes(spark, base):
    """Keys tested by hashes in two passes: some unique, some repeated here and there, one repeated throughout."""
    lines, parts = load_table(spark, base, "lineitem"), load_table(spark, base, "part")
    orders, documents = load_table(spark, base, "orders"), load_table(spark, base, "documents")
    return quality.report(
        quality.unique_by_hashes(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.unique_by_hashes(lines, "lineitem", ["l_orderkey", "l_partkey"]),
        quality.unique_by_hashes(orders, "orders", "o_orderkey"),
        quality.unique_by_hashes(orders, "orders", "o_custkey"),
        quality.unique_by_hashes(parts, "part", "p_name"),
        quality.unique_by_hashes(documents, "documents", "text"),
    )


def dq_not_null(spark, base):
    m = _models(spark, base)
    return quality.report(
        quality.model_tests(m["customers"], "stg_customers", not_null=["customer_id"]),
        quality.model_tests(
            m["orders"], "stg_orders", not_null=["order_id", "customer_id", "payment_amount"]
        ),
        quality.model_tests(
            m["mart"], "customer_orders", not_null=["customer_id", "first_order_amt"]
        ),
    )


def dq_accepted_values(spark, base):
    m = _models(spark, base)
    return quality.report(
        quality.model_tests(m["orders"], "stg_orders", accepted={"status": STATUSES}),
        quality.accepted_values(m["lines"], "lineitem", "l_returnflag", (*METHODS, "R")),
    )


def dq_relationships(spark, base):
    m = _models(spark, base)
    return quality.report(
        quality.relationships(
            m["orders"], "stg_orders", "customer_id", m["customers"], "customer_id"
        ),
        quality.relationships(m["lines"], "lineitem", "l_orderkey", m["orders"], "order_id"),
        # Orders that no payment refers to are orphans seen from the payments' side.
        quality.relationships(
            m["orders"], "stg_orders", "order_id", _paid(spark, base), "order_id"
        ),
    )


def dq_report(spark, base):
    """All tests declared for the models and their source."""
    m = _models(spark, base)
    source = load(spark, base, "orders")
    return quality.report(
        quality.primary_key(m["mart"], "customer_orders", "customer_id"),
        quality.primary_key(m["customers"], "stg_customers", "customer_id"),
        quality.model_tests(
            m["orders"],
            "stg_orders",
            unique=["order_id"],
            not_null=["order_id", "customer_id"],
            accepted={"status": STATUSES},
        ),
        quality.relationships(
            m["orders"], "stg_orders", "customer_id", m["customers"], "customer_id"
        ),
        quality.primary_key(source, "orders", "id"),
    )


# Python functions


def udf_string_column(spark, base):
    mark = string_udf(lambda role: "[en] " + role)
    return load(spark, base, "memberships").select(
        "person_id", "organization_id", "role", mark("role").alias("role_translated")
    )


def translate_distinct(spark, base):
    """All documents; English text passes through, which a translation of null texts leaves null."""
    documents = load_table(spark, base, "documents")
    foreign = F.when(~F.col("lang").eqNullSafe("en"), F.col("text"))
    store = scratch_path(spark, "text-translations")
    translated = translate_column(
        documents.withColumn("foreign", foreign), "foreign", "translated", _stub_translator(), store=store
    )
    return translated.select(
        "doc_id", "lang", F.coalesce("translated", "text").alias("text_en")
    )


def translate_roles(spark, base):
    """A column with few values, each holding a large share of the rows."""
    members = load(spark, base, "memberships").select("person_id", "organization_id", "role")
    store = scratch_path(spark, "role-translations")
    return translate_column(members, "role", "role_translated", _stub_translator(), store=store)


# Snapshots and incremental ingestion


def _snapshot_runs(spark, base, *cuts):
    """A history after one run per date over the changes before it, and one over all of them."""
    changes = load(spark, base, "status_changes")
    history = SnapshotTable(
        spark, scratch_path(spark, "history"), ["id"], "updated_at", changes.schema, buckets=4
    )
    for cut in cuts:
        history.apply(changes.filter(F.col("updated_at") < F.lit(cut).cast("timestamp_ntz")))
    history.apply(changes)
    return history


def snapshot_scd2(spark, base):
    history = _snapshot_runs(spark, base, "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return models.changed_orders(history.history())


def snapshot_changed(spark, base):
    """The last run comes so soon after the first that many keys have no change yet."""
    return _snapshot_runs(spark, base, "2024-01-30 12:00:00").changed()


def incremental_ingest(spark, base):
    """Two arrivals of files and three runs; the second files are older, the last run finds none new."""
    root = scratch_path(spark, "ingest")
    landing, target, checkpoint = (f"{root}/{part}" for part in ("landing", "target", "checkpoint"))
    events = load_table(spark, base, "events")
    cut = F.expr("ts < timestamp_ntz '2024-01-16 00:00:00'")
    times = iter((1_700_000_000_000, 1_000_000_000_000))
    for arrival in (events.filter(cut), events.filter(~cut), None):
        if arrival is not None:
            write_json(arrival, landing, mode="append")
            set_file_times(spark, landing, next(times))
        ingest_new_files(spark, landing, target, checkpoint, TABLES["events"])
    return ingested(spark, target, TABLES["events"])


def incremental_ledger(spark, base):
    """As :func:`incremental_ingest`, with a table of files taken; the second of four runs finds nothing new."""
    root = scratch_path(spark, "ledger")
    ingest = LedgerIngest(spark, f"{root}/landing", f"{root}/target", f"{root}/ledger", TABLES["events"], max_files_per_batch=2)
    events = load_table(spark, base, "events")
    cut = F.expr("ts < timestamp_ntz '2024-01-16 00:00:00'")
    write_json(events.filter(cut), f"{root}/landing/day=1")
    ingest.run()
    ingest.run()
    write_json(events.filter(~cut), f"{root}/landing/day=2")
    ingest.run()
    ingest.run()
    return ingest.rows()


# Whole jobs


def job_entity_history(spark, base):
    database = _scratch_database(spark)
    for name in ("persons", "memberships", "organizations"):
        create_source_view(spark, base, name, f"{database}.{name}_json")
    output = scratch_path(spark, "entity-history")
    jobs.history_job(spark, database, output, input_bytes=folder_bytes(spark, base))
    return files.read_parquet(spark, output)


def job_contact_export(spark, base):
    table = f"{_scratch_database(spark)}.contacts_csv"
    create_source_view(spark, base, "contacts", table)
    output = scratch_path(spark, "contacts-export")
    store = scratch_path(spark, "contact-translations")
    jobs.contact_export_job(
        spark, table, output, _stub_translator(), store=store, title="HOUSEHOLD"
    )
    schema = (
        "customer_id bigint, name string, title string, companyname string, companyname_en string"
    )
    return files.read_delimited(spark, output, schema, sep="|", quoted=False)


QUERIES: dict[str, Query] = {
    "stg_customers": stg_customers,
    "stg_payments": stg_payments,
    "stg_orders": stg_orders,
    "customer_order_bounds": customer_order_bounds,
    "model_customer_orders": model_customer_orders,
    "model_customer_orders_unique": model_customer_orders_unique,
    "payment_method_pivot": payment_method_pivot,
    "payment_method_pivot_success": payment_method_pivot_success,
    "views_sql": views_sql,
    "cents_to_dollars": cents_to_dollars,
    "filter_greater_than": filter_greater,
    "filter_suffix": filter_suffix,
    "filter_topk_constant": filter_topk_constant,
    "json_map_total": json_map_total,
    "json_map_total_double": json_map_total_double,
    "entity_history": entity_history,
    "scan_json": scan_json,
    "nested_json_history": nested_json_history,
    "list_catalog": list_catalog,
    "scan_catalog_table": scan_catalog_table,
    "load_seed": load_seed,
    "roundtrip_csv_pipe": roundtrip_csv_pipe,
    "roundtrip_csv_quoted": roundtrip_csv_quoted,
    "roundtrip_parquet": roundtrip_parquet,
    "roundtrip_one_text_column": roundtrip_one_text_column,
    "select_over_file": select_over_file,
    "select_columns_over_file": select_columns_over_file,
    "discover_mixed_headers": discover_mixed_headers,
    "discover_table": discover_table,
    "publish_table": publish_orders,
    "publish_partitioned": publish_partitioned,
    "materialize_model": materialize_model,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_report": dq_report,
    "udf_string_column": udf_string_column,
    "translate_distinct": translate_distinct,
    "translate_roles": translate_roles,
    "snapshot_scd2": snapshot_scd2,
    "snapshot_changed": snapshot_changed,
    "incremental_ingest": incremental_ingest,
    "job_entity_history": job_entity_history,
    "job_contact_export": job_contact_export,
    "customer_orders_using": customer_orders_using,
    "semi_join_reduced": semi_join_reduced,
    "anti_join_reduced": anti_join_reduced,
    "compare_versions": compare_versions,
    "catalog_databases": catalog_databases,
    "discover_mixed_folder": discover_mixed_folder,
    "publish_clustered": publish_clustered,
    "dq_unique_by_hashes": dq_unique_by_hashes,
    "incremental_ledger": incremental_ledger,
}
QUERIES = {name: _sized(query) for name, query in QUERIES.items()}
