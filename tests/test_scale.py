"""One key holds a third of all rows: plans and task sizes, with broadcasting off."""

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from lakeloom.operators import quality
from lakeloom.operators.joins import orphans
from lakeloom.operators.snapshots import SnapshotTable, latest_states
from lakeloom.operators.translate import translate_column
from lakeloom.plans import models
from lakeloom.plans.jobs import entity_history
from lakeloom.sources.named import load

N = 120_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(column, key):
    return f"if(id % 3 = 0, {key}, {column})"


@pytest.fixture
def lines(spark):
    return spark.range(0, N, 1, 8).selectExpr(
        f"{hot('id % 1000', 7)} AS person_id",
        f"{hot('id % 500', 3)} AS organization_id",
        "concat('role ', id) AS role",
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    frame = df.select("*")
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffled_rows(df):
    """The sizes of the exchanges in rows, from the run plan's metrics."""
    df.collect()
    found = []

    def visit(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
            return visit(node)
        if "QueryStage" in name:
            return visit(node.plan())
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_history_join_splits_the_hot_key(spark, small_partitions, lines):
    persons = spark.range(1000).selectExpr("id", "concat('p', id) AS name")
    organizations = spark.range(500).selectExpr("id", "concat('o', id) AS name")
    history = entity_history(persons, lines, organizations)
    assert history.count() == N
    assert final_plan(history).count("skew=true") == 2


def test_translation_join_splits_a_hot_text(spark, small_partitions, lines):
    df = lines.withColumn("text", F.concat(F.lit("text "), "person_id"))
    translated = translate_column(df, "text", "en", lambda: lambda texts: texts)
    assert translated.filter("en = text").count() == N
    assert "skew=true" in final_plan(translated)


def test_translation_join_splits_null_texts(spark, small_partitions, lines):
    df = lines.withColumn("text", F.expr("if(person_id = 7, null, concat('text ', person_id))"))
    translated = translate_column(df, "text", "en", lambda: lambda texts: texts)
    assert translated.filter("en is null").count() > N // 3
    assert "skew=true" in final_plan(translated)


def test_latest_state_moves_candidates_only(spark, small_partitions):
    changes = spark.range(0, N, 1, 8).selectExpr(
        f"{hot('id % 100', 7)} AS id", "id AS event_id", "timestamp_ntz '2024-01-01' AS updated_at"
    )
    latest = latest_states(changes, ["id"], "updated_at")
    assert latest.count() == 100
    # At most one row per key and map task, whatever the key's share.
    assert max(shuffled_rows(latest)) <= 100 * 8


def test_orphan_check_moves_keys_only(spark, small_partitions, lines):
    parents = spark.range(1000).selectExpr("id % 999 AS id")
    missing = orphans(lines, "person_id", parents, "id")
    assert rows(missing) == rows(
        lines.filter("person_id = 999").groupBy(F.col("person_id").alias("key")).count()
    )
    assert max(shuffled_rows(missing)) <= 1000 * 8


def test_mart_combines_a_hot_customer_in_many_tasks(spark, small_partitions):
    """A customer with a third of all orders."""
    orders = spark.range(0, N, 1, 8).selectExpr(
        "id",
        f"{hot('id % 1000', 7)} AS user_id",
        "timestamp_ntz '2024-01-01' + make_dt_interval(id % 500) AS order_date",
        "'placed' AS status",
    )
    customers = spark.range(1001).selectExpr("id", "'a' AS first_name", "'b' AS last_name")
    payments = orders.selectExpr(
        "id AS order_id", "'card' AS payment_method", "'success' AS status", "id AS amount"
    )
    mart = models.customer_orders(customers, orders, models.stg_payments(payments))
    assert mart.count() == 1001
    staged = models.stg_orders(orders, models.stg_payments(payments))
    expected = staged.groupBy("customer_id").agg(
        F.min_by("payment_amount", F.struct("order_date", "order_id")).alias("low"),
        F.max_by("payment_amount", F.struct("order_date", "order_id")).alias("high"),
        F.count("*").alias("n"),
    )
    found = mart.filter("number_of_orders > 0").selectExpr(
        "customer_id", "first_order_amt", "most_recent_order_amt", "number_of_orders"
    )
    assert rows(found) == rows(expected)


def test_changed_history_joins_open_rows_only(spark, small_partitions, tmp_path):
    """A key with a third of the history: its closed rows take part in no join."""
    schema = "id bigint, v bigint, at timestamp_ntz"
    table = SnapshotTable(spark, str(tmp_path / "h"), ["id"], "at", spark.createDataFrame([], schema).schema)
    for day in range(1, 5):
        state = spark.range(200).selectExpr(
            "id", f"{day} AS v", f"timestamp_ntz '2024-01-0{day}' AS at"
        )
        table.apply(state.filter(f"id = 7 or {day} < 3"))
    changed = table.changed()
    assert changed.count() == 199 * 2 + 4
    text = plan(changed)
    assert text.count("Join") == 1 and text.count("isnull(valid_to") >= 1


def test_model_tests_read_the_model_once(spark, small_partitions, testdata):
    orders = models.stg_orders(
        load(spark, testdata, "orders"), models.stg_payments(load(spark, testdata, "payments"), "F")
    )
    tests = quality.model_tests(
        orders,
        "stg_orders",
        unique=["order_id", ["customer_id", "order_date"]],
        not_null=["customer_id"],
        accepted={"status": ["F"]},
    )
    assert final_plan(tests).count("parquet [o_orderkey") == 1
    single = quality.report(
        quality.unique(orders, "stg_orders", "order_id"),
        quality.unique(orders, "stg_orders", ["customer_id", "order_date"]),
        quality.not_null(orders, "stg_orders", "customer_id"),
        quality.accepted_values(orders, "stg_orders", "status", ["F"]),
    )
    assert rows(tests) == rows(single)
