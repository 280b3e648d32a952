import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from lakeloom.operators.compare import assert_same_rows, differing_rows, same_rows
from test_scale import shuffled_rows, small_partitions  # noqa: F401


def test_counts_of_rows_that_differ_match_counters(spark):
    rnd = random.Random(2)
    schema = "a int, b string, c double"

    def some():
        return [(rnd.choice([None, 1, 2]), rnd.choice([None, "", "x"]), rnd.choice([None, 0.5, -0.0])) for _ in range(60)]

    for _ in range(4):
        left, right = some(), some()
        found = differing_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
        a, b = Counter(left), Counter(right)
        assert rows(found) == sorted(((*row, a[row], b[row]) for row in a | b if a[row] != b[row]), key=lambda r: tuple(map(repr, r)))


def test_order_and_partitions_do_not_matter(spark, testdata):
    orders = spark.read.parquet(f"{testdata}/orders.parquet")
    columns = orders.columns[::-1]
    assert same_rows(orders, orders.repartition(5, "o_custkey").select(*columns))
    assert not same_rows(orders, orders.union(orders.limit(1)))
    assert not same_rows(orders, orders.limit(orders.count() - 1))


def test_zeros_are_equal_and_nulls_keep_their_place(spark):
    left = spark.createDataFrame([(0.0, None, "a"), (float("nan"), "a", None)], "x double, y string, z string")
    right = spark.createDataFrame([(-0.0, None, "a"), (float("nan"), None, "a")], "x double, y string, z string")
    assert rows(differing_rows(left, right).select("y", "z", "n_left", "n_right")) == [("a", None, 1, 0), (None, "a", 0, 1)]


def test_nested_values_and_maps(spark):
    schema = "id int, m map<string,int>, s struct<a:int,b:array<map<int,string>>>"
    left = [(1, {"a": 1, "b": 2}, (1, [{1: "x", 2: "y"}])), (2, None, None), (3, {}, (None, None))]
    right = [(1, {"b": 2, "a": 1}, (1, [{2: "y", 1: "x"}])), (2, {}, None), (3, {}, (None, []))]
    found = differing_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    assert found.columns == ["id", "m", "s", "n_left", "n_right"]
    assert sorted((row.id, row.m, row.n_left, row.n_right) for row in found.collect() if row.id == 3) == [(3, {}, 0, 1), (3, {}, 1, 0)]
    assert sorted((row.id, row.n_left) for row in found.collect()) == [(2, 0), (2, 1), (3, 0), (3, 1)]


def test_other_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="b .none and int."):
        differing_rows(spark.createDataFrame([], "a int"), spark.createDataFrame([], "a int, b int"))
    with pytest.raises(ValueError, match="a .int and bigint."):
        differing_rows(spark.createDataFrame([], "a int"), spark.createDataFrame([], "a bigint"))
    with pytest.raises(ValueError, match="clash"):
        differing_rows(spark.createDataFrame([], "n_left int"), spark.createDataFrame([], "n_left int"))


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,)], "a int")
    assert same_rows(none, none)
    assert rows(differing_rows(none, one)) == [(1, 0, 1)]


def test_the_assertion_shows_rows(spark):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    assert_same_rows(one, one)
    with pytest.raises(AssertionError, match="'n_right': 1"):
        assert_same_rows(one, two)


def test_equal_tables_shuffle_digests_and_others_few_rows(spark, small_partitions):
    table = spark.range(0, 50_000, 1, 4).selectExpr("id", "if(id % 3 = 0, 'hot', concat('v', id)) AS v")
    moved = shuffled_rows(differing_rows(table, table.repartition(3)))
    # A digest of each bucket and task; the repartition above moves the rows of one side.
    assert sum(n for n in moved if n < 50_000) < 20_000
    changed = table.withColumn("v", F.when(F.col("id") % 20_000 == 7, F.lit("new")).otherwise(F.col("v")))
    found = differing_rows(table, changed)
    assert found.count() == 6
    assert "Exchange" in plan(found)


def test_a_row_that_fills_the_table(spark, small_partitions):
    table = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 2 = 0, 1, id) AS v")
    found = differing_rows(table, table.union(spark.createDataFrame([(1,)], "v bigint")))
    assert rows(found) == [(1, 20_001, 20_002)]
