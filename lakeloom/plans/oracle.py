"""ANSI SQL that states each registered query's result on the given tables."""

from __future__ import annotations

_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"

_PAID = f"""
    SELECT l_orderkey AS order_id, CAST(sum({_CENTS}) AS BIGINT) AS payment_amount
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey
"""

_STG_CUSTOMERS = """
    SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name
    FROM customer
"""

_STG_ORDERS = f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
           o_orderstatus AS status, p.payment_amount
    FROM orders LEFT JOIN ({_PAID}) p ON o_orderkey = p.order_id
"""

_BOUNDS = """
    SELECT o_custkey AS customer_id, min(o_orderdate) AS first_order_date,
           max(o_orderdate) AS most_recent_order_date, count(o_orderkey) AS number_of_orders
    FROM orders GROUP BY o_custkey
"""

_MART = f"""
    WITH ranked AS (
      SELECT *,
        row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS up,
        row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS down
      FROM ({_STG_ORDERS})
    ),
    summary AS (
      SELECT customer_id, min(order_date) AS first_order_date,
             max(order_date) AS most_recent_order_date,
             max(CASE WHEN up = 1 THEN payment_amount END) AS first_order_amt,
             max(CASE WHEN down = 1 THEN payment_amount END) AS most_recent_order_amt,
             count(order_id) AS number_of_orders
      FROM ranked GROUP BY customer_id
    )
    SELECT c.*, first_order_date, most_recent_order_date, first_order_amt, most_recent_order_amt,
           coalesce(number_of_orders, 0) AS number_of_orders
    FROM ({_STG_CUSTOMERS}) c LEFT JOIN summary s ON c.customer_id = s.customer_id
"""

_PIVOT = f"""
    SELECT l_orderkey AS order_id,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN {_CENTS} END) AS BIGINT) AS "A_amount",
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN {_CENTS} END) AS BIGINT) AS "N_amount",
           CAST(sum({_CENTS}) AS BIGINT) AS total_amount
    FROM lineitem GROUP BY l_orderkey
"""

_PIVOT_SUCCESS = f"""
    SELECT l_orderkey AS order_id,
           CAST(sum({_CENTS}) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS "A_amount",
           CAST(sum({_CENTS}) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS "N_amount",
           CAST(sum({_CENTS}) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS "R_amount",
           CAST(sum({_CENTS}) AS BIGINT) AS total_amount
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey
"""

_ENTITY_HISTORY = """
    SELECT s_name AS org_name, p_partkey AS id, p_name AS name, p_brand AS brand,
           l_suppkey AS organization_id, l_returnflag AS role, l_linestatus AS on_behalf_of_id,
           l_shipdate AS start_date
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""

_CONTACTS = """
    SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS title,
           'spital' AS companyname
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
"""


def _scd2(*cuts: str) -> str:
    moments = ", ".join(f"(TIMESTAMP '{cut}')" for cut in (*cuts, "9999-01-01"))
    return f"""
    WITH cuts(cut) AS (VALUES {moments}),
    states AS (
      SELECT DISTINCT user_id AS id, event_type AS status, event_id, ts AS updated_at
      FROM (
        SELECT e.*, row_number() OVER (
          PARTITION BY cut, user_id ORDER BY ts DESC, event_type DESC, event_id DESC) AS rn
        FROM events e JOIN cuts ON e.ts < cuts.cut
      ) WHERE rn = 1
    )
    SELECT *, md5(id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
           updated_at AS scd_updated_at, updated_at AS valid_from,
           lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to
    FROM states
    """


def _test(model: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test,"
        f" CAST(({failures}) AS BIGINT) AS failures"
    )


def _unique(model: str, relation: str, columns: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
    return _test(
        model,
        columns,
        "unique",
        f"SELECT count(*) FROM (SELECT {columns} FROM ({relation}) WHERE {present}"
        f" GROUP BY {columns} HAVING count(*) > 1)",
    )


def _not_null(model: str, relation: str, column: str) -> str:
    return _test(
        model, column, "not_null", f"SELECT count(*) FROM ({relation}) WHERE {column} IS NULL"
    )


def _accepted(model: str, relation: str, column: str, values: str) -> str:
    return _test(
        model,
        column,
        "accepted_values",
        f"SELECT count(DISTINCT {column}) FROM ({relation}) WHERE {column} NOT IN ({values})",
    )


def _related(model: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return _test(
        model,
        column,
        "relationships",
        f"SELECT count(*) FROM ({child}) c WHERE c.{column} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM ({parent}) p WHERE p.{parent_column} = c.{column})",
    )


def _all(*tests: str) -> str:
    return " UNION ALL ".join(tests)


_ORDERS = "SELECT o_orderkey AS id FROM orders"
_LINES = "SELECT * FROM lineitem"

ORACLE_SQL: dict[str, str] = {
    "stg_customers": _STG_CUSTOMERS,
    "stg_payments": _PAID,
    "stg_orders": _STG_ORDERS,
    "customer_order_bounds": _BOUNDS,
    "model_customer_orders": _MART,
    "model_customer_orders_unique": _MART,
    "payment_method_pivot": _PIVOT,
    "payment_method_pivot_success": _PIVOT_SUCCESS,
    "views_sql": f"""
        SELECT status, count(*) AS n_orders, count(payment_amount) AS n_paid,
               CAST(sum(payment_amount) AS BIGINT) AS paid
        FROM ({_STG_ORDERS}) o JOIN ({_STG_CUSTOMERS}) c ON o.customer_id = c.customer_id
        GROUP BY status
    """,
    "cents_to_dollars": """
        SELECT c_custkey AS customer_id, c_acctbal AS dollars,
               CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(16,1)) AS DOUBLE)
                 AS dollars_rounded
        FROM customer
    """,
    "filter_greater_than": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 20
    """,
    "filter_suffix": """
        SELECT p_partkey, p_name, p_type FROM part
        WHERE p_type = 'ECONOMY' AND p_name LIKE '%ring'
    """,
    "filter_topk_constant": f"{_CONTACTS} ORDER BY c_custkey LIMIT 5",
    "json_map_total": """
        SELECT CAST(sum(total) AS BIGINT) AS total_order_value,
               count(total) AS valid_documents,
               count(props) - count(total) AS invalid_documents,
               printf('Total order value is: %.2f', CAST(sum(total) AS DOUBLE)) AS message
        FROM (
          SELECT props, list_sum(map_values(CAST(CAST(props AS JSON) AS MAP(VARCHAR, BIGINT))))
                   AS total
          FROM events
        )
    """,
    # Values are below 2**20 and multiples of 2**-80: two whole numbers each, added up without error.
    "json_map_total_double": """
        SELECT CAST(sum(CAST(floor(value * 2**40) AS HUGEINT)) AS DOUBLE) / 2**40
                 + CAST(sum(CAST((value * 2**40 - floor(value * 2**40)) * 2**40 AS HUGEINT)) AS DOUBLE) / 2**80
                 AS total_order_value,
               count(value) AS valid_documents, count(*) - count(value) AS invalid_documents
        FROM events
    """,
    "entity_history": _ENTITY_HISTORY,
    "nested_json_history": _ENTITY_HISTORY,
    "list_catalog": """
        SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'part', count(*) FROM part
        UNION ALL SELECT 'supplier', count(*) FROM supplier
    """,
    "scan_json": "SELECT * FROM events",
    "scan_catalog_table": "SELECT * FROM orders",
    "load_seed": """
        SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name
        FROM customer
    """,
    "roundtrip_csv_pipe": "SELECT * FROM orders",
    "roundtrip_csv_quoted": "SELECT * FROM documents",
    "roundtrip_one_text_column": """
        SELECT CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE text END AS text
        FROM documents
    """,
    "roundtrip_parquet": "SELECT * FROM lineitem",
    "select_over_file": "SELECT * FROM orders",
    "select_columns_over_file": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    """,
    "discover_mixed_headers": """
        SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part
    """,
    "discover_table": "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size) FROM part",
    "publish_table": "SELECT * FROM orders",
    "publish_partitioned": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
    """,
    "materialize_model": _PIVOT,
    "dq_unique": _all(
        _unique("stg_customers", _STG_CUSTOMERS, "customer_id"),
        _unique("stg_orders", _STG_ORDERS, "order_id"),
        _unique("customer_orders", _MART, "customer_id"),
        _unique("lineitem", _LINES, "l_orderkey"),
        _unique("lineitem", _LINES, "l_orderkey, l_linenumber"),
    ),
    "dq_not_null": _all(
        _not_null("stg_customers", _STG_CUSTOMERS, "customer_id"),
        _not_null("stg_orders", _STG_ORDERS, "order_id"),
        _not_null("stg_orders", _STG_ORDERS, "customer_id"),
        _not_null("stg_orders", _STG_ORDERS, "payment_amount"),
        _not_null("customer_orders", _MART, "customer_id"),
        _not_null("customer_orders", _MART, "first_order_amt"),
    ),
    "dq_accepted_values": _all(
        _accepted("stg_orders", _STG_ORDERS, "status", "'F', 'O'"),
        _accepted("lineitem", _LINES, "l_returnflag", "'A', 'N', 'R'"),
    ),
    "dq_relationships": _all(
        _related("stg_orders", _STG_ORDERS, "customer_id", _STG_CUSTOMERS, "customer_id"),
        _related("lineitem", _LINES, "l_orderkey", _STG_ORDERS, "order_id"),
        _related("stg_orders", _STG_ORDERS, "order_id", _PAID, "order_id"),
    ),
    "dq_report": _all(
        _unique("customer_orders", _MART, "customer_id"),
        _not_null("customer_orders", _MART, "customer_id"),
        _unique("stg_customers", _STG_CUSTOMERS, "customer_id"),
        _not_null("stg_customers", _STG_CUSTOMERS, "customer_id"),
        _unique("stg_orders", _STG_ORDERS, "order_id"),
        _not_null("stg_orders", _STG_ORDERS, "order_id"),
        _not_null("stg_orders", _STG_ORDERS, "customer_id"),
        _accepted("stg_orders", _STG_ORDERS, "status", "'F', 'O'"),
        _related("stg_orders", _STG_ORDERS, "customer_id", _STG_CUSTOMERS, "customer_id"),
        _unique("orders", _ORDERS, "id"),
        _not_null("orders", _ORDERS, "id"),
    ),
    "udf_string_column": """
        SELECT l_partkey AS person_id, l_suppkey AS organization_id, l_returnflag AS role,
               '[en] ' || l_returnflag AS role_translated
        FROM lineitem
    """,
    "translate_distinct": """
        SELECT doc_id, lang, CASE WHEN lang = 'en' THEN text
          ELSE '[en] ' || replace(text, 'e', 'E') END AS text_en
        FROM documents
    """,
    "translate_roles": """
        SELECT l_partkey AS person_id, l_suppkey AS organization_id, l_returnflag AS role,
               '[en] ' || replace(l_returnflag, 'e', 'E') AS role_translated
        FROM lineitem
    """,
    "snapshot_scd2": _scd2("2024-01-10", "2024-01-20"),
    "snapshot_changed": f"""
        WITH history AS ({_scd2("2024-01-30 12:00:00")})
        SELECT * FROM history
        WHERE id IN (SELECT id FROM history WHERE valid_to IS NOT NULL)
    """,
    "incremental_ingest": "SELECT * FROM events",
    "job_entity_history": _ENTITY_HISTORY,
    "customer_orders_using": _MART,
    "semi_join_reduced": """
        SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
    """,
    "anti_join_reduced": """
        WITH ordered AS (
          SELECT l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey
          WHERE c_mktsegment = 'HOUSEHOLD'
        )
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
        WHERE NOT EXISTS (
          SELECT 1 FROM ordered o WHERE o.l_partkey = l.l_partkey AND o.l_suppkey = l.l_suppkey)
    """,
    "compare_versions": """
        WITH other AS (
          SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
          FROM orders
          JOIN (VALUES (1), (2)) AS copies(copy)
            ON copy <= CASE WHEN o_orderkey % 103 = 0 THEN 2 WHEN o_orderkey % 101 = 0 THEN 0 ELSE 1 END
        ),
        both_sides AS (
          SELECT *, 1 AS l, 0 AS r FROM orders UNION ALL SELECT * EXCLUDE (copy), 0, 1 FROM other
        )
        SELECT * EXCLUDE (l, r), CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
        FROM both_sides GROUP BY ALL HAVING sum(l) <> sum(r)
    """,
    "catalog_databases": """
        SELECT 'lakeloom_sales' AS database, 2 AS n_tables,
               (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS n_rows
        UNION ALL
        SELECT 'lakeloom_goods', 2, (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier)
    """,
    "discover_mixed_folder": """
        SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 <> 2 THEN CAST(p_size AS BIGINT) END AS p_size
        FROM part
    """,
    "publish_clustered": """
        SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1997-07-01'
    """,
    "dq_unique_by_hashes": _all(
        _unique("lineitem", _LINES, "l_orderkey, l_linenumber"),
        _unique("lineitem", _LINES, "l_orderkey, l_partkey"),
        _unique("orders", "SELECT * FROM orders", "o_orderkey"),
        _unique("orders", "SELECT * FROM orders", "o_custkey"),
        _unique("part", "SELECT * FROM part", "p_name"),
        _unique("documents", "SELECT * FROM documents", "text"),
    ),
    "incremental_ledger": "SELECT * FROM events",
    "job_contact_export": f"""
        SELECT *, '[en] ' || replace(companyname, 'e', 'E') AS companyname_en
        FROM ({_CONTACTS})
    """,
}
