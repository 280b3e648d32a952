from datetime import date

import pytest

from conftest import plan, rows
from lakeloom.plans import models
from lakeloom.sinks.tables import materialize_table, materialize_view

D = [date(2020, 1, day) for day in range(1, 11)]


@pytest.fixture(scope="module")
def customers(spark):
    names = [(1, "Ann", "A."), (2, "Ben", "B."), (3, "Cid", "C."), (4, "Dee", "D.")]
    return spark.createDataFrame(names, "id int, first_name string, last_name string")


@pytest.fixture(scope="module")
def orders(spark):
    given = [
        (10, 1, D[0], "completed"),
        (11, 1, D[4], "placed"),
        # Two orders on the first date, two on the last.
        (20, 2, D[1], "completed"),
        (21, 2, D[1], "completed"),
        (22, 2, D[6], "shipped"),
        (23, 2, D[6], "returned"),
        # A single order, never paid.
        (30, 3, D[2], "placed"),
        # Nobody's order, and one without a date.
        (90, None, D[0], "placed"),
        (91, 3, None, "placed"),
    ]
    return spark.createDataFrame(given, "id int, user_id int, order_date date, status string")


@pytest.fixture(scope="module")
def payments(spark):
    given = [
        (1, 10, "credit_card", "success", 1000),
        (2, 10, "coupon", "success", 200),
        (3, 10, "credit_card", "fail", 1000),
        (4, 11, "gift_card", "success", 50),
        (5, 20, "bank_transfer", "success", 1),
        (6, 21, "bank_transfer", "success", 2),
        (7, 22, "bank_transfer", "success", 3),
        (8, 23, "bank_transfer", "success", 4),
        (9, 30, "credit_card", "fail", 700),
        (10, 90, "credit_card", "success", None),
    ]
    return spark.createDataFrame(
        given, "id int, order_id int, payment_method string, status string, amount int"
    )


@pytest.fixture(scope="module")
def paid(payments):
    return models.stg_payments(payments)


def test_payments_sum_successes_only(paid):
    assert rows(paid) == [(10, 1200), (11, 50), (20, 1), (21, 2), (22, 3), (23, 4), (90, None)]


def test_orders_keep_unpaid_ones(orders, paid):
    staged = models.stg_orders(orders, paid)
    assert staged.columns == ["order_id", "customer_id", "order_date", "status", "payment_amount"]
    assert staged.count() == 9
    assert staged.filter("order_id = 30").first()["payment_amount"] is None


def test_pivot_lists_methods_and_totals_all(payments):
    pivot = models.order_payment_method_amounts(payments)
    assert pivot.columns == [
        "order_id",
        "bank_transfer_amount",
        "credit_card_amount",
        "gift_card_amount",
        "total_amount",
    ]
    by_order = {r["order_id"]: tuple(r)[1:] for r in pivot.collect()}
    # The coupon is in the total only, the failed payment in both.
    assert by_order[10] == (None, 2000, None, 2200)
    assert by_order[11] == (None, None, 50, 50)
    assert by_order[30] == (None, 700, None, 700)


def test_pivot_with_methods_and_status_filter(payments):
    pivot = models.order_payment_method_amounts(payments, ["credit_card", "coupon"], ["success"])
    by_order = {r["order_id"]: tuple(r)[1:] for r in pivot.collect()}
    assert by_order[10] == (1000, 200, 1200)
    assert 30 not in by_order


def test_mart_has_one_row_per_customer(customers, orders, paid):
    mart = models.customer_orders(customers, orders, paid)
    assert rows(mart.drop("first_name", "last_name")) == [
        (1, D[0], D[4], 2, 1200, 50)[:3] + (1200, 50, 2),
        (2, D[1], D[6], 1, 4, 4),
        (3, D[2], D[2], None, None, 2),
        (4, None, None, None, None, 0),
    ]


def test_many_orders_on_a_day_are_one_row(spark, customers):
    orders = spark.range(2000).selectExpr(
        "id", "1 AS user_id", "timestamp_ntz '2024-01-01' AS order_date", "'placed' AS status"
    )
    paid = orders.selectExpr("id AS order_id", "id * 10 AS payment_amount")
    mart = models.customer_orders(customers, orders, paid)
    assert mart.count() == customers.count()
    row = mart.filter("customer_id = 1").first()
    assert (row.first_order_amt, row.most_recent_order_amt, row.number_of_orders) == (0, 19_990, 2000)
    assert "SortAggregate" not in plan(mart)


def test_empty_inputs(spark, customers, orders, payments):
    none_paid = models.stg_payments(payments.limit(0))
    assert models.customer_orders(customers, orders.limit(0), none_paid).count() == 4
    assert models.customer_orders(customers.limit(0), orders, none_paid).count() == 0
    assert models.order_payment_method_amounts(payments.limit(0)).count() == 0


def test_all_models_by_name_as_views_and_tables(spark, customers, orders, payments, tmp_path):
    built = models.build_models(customers, orders, payments)
    for name in ("stg_customers", "stg_orders", "customer_orders"):
        materialize_view(built[name], f"v_{name}")
    assert spark.sql("SELECT max(number_of_orders) AS n FROM v_customer_orders").first()["n"] == 4
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    stored = materialize_table(
        built["order_payment_method_amounts"], "marts.amounts", f"{tmp_path}/amounts"
    )
    assert rows(stored) == rows(built["order_payment_method_amounts"])
