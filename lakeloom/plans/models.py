"""Staging models and marts. Each is a function of DataFrames; Catalyst plans the whole tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.aggregates import conditional_sums
from lakeloom.operators.joins import join_using

# The payment methods the pivot lists.
PAYMENT_METHODS = ("bank_transfer", "credit_card", "gift_card")

# The order statuses that the data tests accept.
ORDER_STATUSES = ("placed", "shipped", "completed", "return_pending", "returned")


def stg_customers(customers: DataFrame) -> DataFrame:
    """Customers under the names the marts use."""
    return customers.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stg_payments(payments: DataFrame, success_status: str = "success") -> DataFrame:
    """The amount paid per order, successful payments only."""
    return (
        payments.filter(F.col("status") == success_status)
        .groupBy("order_id")
        .agg(F.sum("amount").alias("payment_amount"))
    )


def stg_orders(orders: DataFrame, paid: DataFrame) -> DataFrame:
    """Orders with the amount paid, null where nothing was. ``paid`` is :func:`stg_payments`."""
    o, p = orders.alias("o"), paid.alias("p")
    return o.join(p, F.col("o.id") == F.col("p.order_id"), "left").select(
        F.col("o.id").alias("order_id"),
        F.col("o.user_id").alias("customer_id"),
        F.col("o.order_date"),
        F.col("o.status"),
        F.col("p.payment_amount"),
    )


def order_payment_method_amounts(
    payments: DataFrame,
    methods: Sequence[str] = PAYMENT_METHODS,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Amount per order and listed payment method, and the total over all methods.

    All payments count, failed ones too, unless ``statuses`` names those that do.
    """
    if statuses is not None:
        payments = payments.filter(F.col("status").isin(*statuses))
    return conditional_sums(payments, ["order_id"], "payment_method", methods, "amount")


def customer_order_bounds(orders: DataFrame) -> DataFrame:
    """First and last order date and number of orders per customer."""
    return orders.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("id").alias("number_of_orders"),
    )


def customer_orders(customers: DataFrame, orders: DataFrame, paid: DataFrame) -> DataFrame:
    """One row per customer with the first and last order's date and amount.

    Of several orders on a date, the lowest id is first, the highest last. Orders are summed up by
    customer and date and then by customer: every buffer is a number or a time, so both steps stay in
    hash aggregation, a customer with very many orders is combined in many tasks, and the orders are
    not joined back.
    """
    days = (
        stg_orders(orders, paid)
        .groupBy("customer_id", "order_date")
        .agg(
            F.min_by("payment_amount", "order_id").alias("first_amount"),
            F.max_by("payment_amount", "order_id").alias("last_amount"),
            F.count("order_id").alias("n_orders"),
        )
    )
    summary = days.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.min_by("first_amount", "order_date").alias("first_order_amt"),
        F.max_by("last_amount", "order_date").alias("most_recent_order_amt"),
        F.sum("n_orders").alias("number_of_orders"),
    )
    return (
        stg_customers(customers)
        .join(summary, "customer_id", "left")
        .withColumn("number_of_orders", F.coalesce("number_of_orders", F.lit(0)))
    )


def customer_orders_single(customers: DataFrame, orders: DataFrame, paid: DataFrame) -> DataFrame:
    """The rows of :func:`customer_orders` from one aggregation by customer.

    One shuffle less, but its buffers hold pairs of date and id, which keeps it out of hash aggregation.
    """
    place = F.struct("order_date", "order_id")
    summary = (
        stg_orders(orders, paid)
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("most_recent_order_date"),
            F.min_by("payment_amount", place).alias("first_order_amt"),
            F.max_by("payment_amount", place).alias("most_recent_order_amt"),
            F.count("order_id").alias("number_of_orders"),
        )
    )
    return join_using(stg_customers(customers), summary, ["customer_id"]).withColumn(
        "number_of_orders", F.coalesce("number_of_orders", F.lit(0))
    )


def customer_orders_using(customers: DataFrame, orders: DataFrame, paid: DataFrame) -> DataFrame:
    """The rows of :func:`customer_orders` by joins on customer and date, which take one order of each day.

    The lowest id of the first day and the highest of the last day name the orders whose amounts are attached, so days
    with many orders multiply no customer.
    """
    placed = stg_orders(orders, paid)
    bounds = customer_order_bounds(orders)

    def amounts(date: str, amount: str) -> DataFrame:
        return placed.select(
            "customer_id", F.col("order_date").alias(date), F.col("payment_amount").alias(amount), F.col("order_id").alias(f"_{amount}_order")
        )

    first = amounts("first_order_date", "first_order_amt")
    last = amounts("most_recent_order_date", "most_recent_order_amt")
    rows = join_using(stg_customers(customers), bounds, ["customer_id"])
    rows = join_using(rows, first, ["customer_id", "first_order_date"], order=[F.col("_first_order_amt_order").asc()])
    rows = join_using(rows, last, ["customer_id", "most_recent_order_date"], order=[F.col("_most_recent_order_amt_order").desc()])
    return rows.select(
        "customer_id",
        "first_name",
        "last_name",
        "first_order_date",
        "most_recent_order_date",
        "first_order_amt",
        "most_recent_order_amt",
        F.coalesce("number_of_orders", F.lit(0)).alias("number_of_orders"),
    )


def changed_orders(history: DataFrame) -> DataFrame:
    """The order history as the snapshot holds it, every state of every order."""
    return history


def build_models(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, success_status: str = "success"
) -> dict[str, DataFrame]:
    """All models by name, lazily; materialize those that are to be stored."""
    paid = stg_payments(payments, success_status)
    return {
        "stg_customers": stg_customers(customers),
        "stg_payments": paid,
        "stg_orders": stg_orders(orders, paid),
        "order_payment_method_amounts": order_payment_method_amounts(payments),
        "customer_orders": customer_orders(customers, orders, paid),
    }
