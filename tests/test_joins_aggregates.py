import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from lakeloom.operators.aggregates import conditional_sums, first_rows, group_by_first
from lakeloom.operators.joins import join_on, join_using, orphans
from lakeloom.plans.jobs import entity_history


@pytest.fixture(scope="module")
def entities(spark):
    persons = spark.createDataFrame(
        [("p1", "Ann"), ("p2", "Ben"), ("p3", "Cid")], "id string, name string"
    )
    memberships = spark.createDataFrame(
        [("p1", "o1", "member"), ("p1", "o2", "chair"), ("p2", "o1", None), ("p9", "o1", "gone")],
        "person_id string, organization_id string, role string",
    )
    organizations = spark.createDataFrame(
        [
            ("o1", "House", [("en", "The House")], [("x", "1")]),
            ("o2", "Senate", [], []),
            ("o3", "Empty", None, None),
        ],
        "id string, name string, other_names array<struct<lang:string,name:string>>,"
        " identifiers array<struct<scheme:string,identifier:string>>",
    )
    return persons, memberships, organizations


def test_entity_history(entities):
    history = entity_history(*entities)
    assert history.columns == ["org_name", "id", "name", "organization_id", "role"]
    assert rows(history) == [
        ("House", "p1", "Ann", "o1", "member"),
        ("House", "p2", "Ben", "o1", None),
        ("Senate", "p1", "Ann", "o2", "chair"),
    ]


def test_join_names_clashes(entities):
    persons, _, organizations = entities
    with pytest.raises(ValueError, match="both sides"):
        join_on(persons, organizations, "id", "id")
    joined = join_on(persons, organizations, "name", "name", "left", clash_suffix="_org")
    assert joined.columns == ["id", "name", "id_org", "name_org", "other_names", "identifiers"]
    assert joined.count() == 3


def test_orphans_count_rows_per_key(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert rows(orphans(child, "k", parent, "id")) == [(1, 2), (3, 1)]


def test_conditional_sums_give_null_for_absent_values(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 6), (1, "z", 1), (2, None, 2)], "k int, p string, amt int"
    )
    result = conditional_sums(df, ["k"], "p", ["a", "b"], "amt", "total")
    assert rows(result) == [(1, 11, None, 12), (2, None, None, 2)]


def test_pivot_is_one_shuffle(spark, testdata):
    df = spark.read.parquet(f"{testdata}/lineitem.parquet")
    text = plan(
        conditional_sums(df, ["l_orderkey"], "l_returnflag", ["A", "N", "R"], "l_linenumber")
    )
    assert text.count("Exchange") == 1


def test_group_by_first_columns(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6)], "k int, p string, amt int")
    assert rows(group_by_first(df, 1).agg(F.sum("amt").alias("s"))) == [(1, 11)]
    assert group_by_first(df, 2).count().count() == 2


def test_first_rows(spark):
    df = spark.createDataFrame(
        [(1, 3, "x"), (1, 2, "y"), (1, 2, "z"), (2, 9, "w")], "k int, t int, v string"
    )
    one = first_rows(df, ["k"], [F.col("t").asc(), F.col("v").desc()])
    assert rows(one) == [(1, 2, "z"), (2, 9, "w")]
    assert plan(one).count("WindowGroupLimit") == 2


def orders_of(spark):
    days = [(1, "d1", 10), (1, "d2", 20), (2, "d1", 30), (None, "d1", 40), (3, None, 50)]
    return spark.createDataFrame(days, "customer int, day string, amount int")


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_join_using_two_columns(spark, how):
    left = spark.createDataFrame([(1, "a", "d1"), (1, "b", "d9"), (2, "c", "d1"), (3, "e", None), (None, "f", "d1")], "customer int, name string, day string")
    right = orders_of(spark)
    found = join_using(left, right, ["customer", "day"], how)
    assert found.columns == ["customer", "day", "name", "amount"]
    assert rows(found) == rows(left.join(right, ["customer", "day"], how).select(*found.columns))


def test_join_using_refuses_to_multiply_rows(spark):
    left = spark.createDataFrame([(1, "d1"), (2, "d1")], "customer int, day string")
    right = orders_of(spark).unionByName(orders_of(spark).where("customer = 1 AND day = 'd1'"))
    with pytest.raises(Exception, match="customer=1, day=d1"):
        join_using(left, right, ["customer", "day"]).collect()
    # A key that no left row meets does no harm.
    assert rows(join_using(left.where("customer = 2"), right, ["customer", "day"])) == [(2, "d1", 30)]
    with pytest.raises(ValueError, match="both sides"):
        join_using(left, right, ["customer"])
    with pytest.raises(ValueError, match="cross"):
        join_using(left, right, ["customer", "day"], "cross")


def test_join_using_takes_the_named_row_of_many(spark):
    """2,000 orders on a day: one row, whichever end of the order is asked for."""
    left = spark.createDataFrame([(1, "d1"), (2, "d1")], "customer int, day string")
    right = spark.range(2000).selectExpr("1 AS customer", "'d1' AS day", "id AS order_id")
    for order, wanted in ((F.col("order_id").asc(), 0), (F.col("order_id").desc(), 1999)):
        found = join_using(left, right, ["customer", "day"], order=[order])
        assert rows(found) == [(1, "d1", wanted), (2, "d1", None)]
