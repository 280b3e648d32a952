import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeloom.operators import quality, uniqueness
from lakeloom.operators.uniqueness import repeated_hashes, repeated_values
from test_scale import shuffled_rows, small_partitions  # noqa: F401


@pytest.mark.parametrize("settings", [{}, {"ranges": 1}, {"ranges": 997}, {"max_listed": 0}])
def test_repeated_values_match_a_counter(spark, settings):
    rnd = random.Random(3)
    given = [(rnd.choice([None, *range(300)]), rnd.choice([None, "", "x", "y"])) for _ in range(900)]
    df = spark.createDataFrame(given, "a int, b string").repartition(5)
    for columns in (["a"], ["a", "b"], ["b"]):
        values = Counter(tuple(row["ab".index(c)] for c in columns) for row in given)
        wanted = [(*value, n) for value, n in values.items() if n > 1 and None not in value]
        assert rows(repeated_values(df, columns, **settings)) == sorted(wanted, key=lambda r: tuple(map(repr, r)))


def test_unique_and_empty_keys(spark):
    assert repeated_values(spark.range(5_000), "id").count() == 0
    assert repeated_values(spark.range(0), "id").count() == 0
    assert repeated_values(spark.range(5).selectExpr("CAST(NULL AS INT) AS id"), "id").count() == 0


def test_hashes_are_found_across_chunks_tasks_and_ranges(spark):
    values = spark.range(0, 20_000, 1, 4).selectExpr("if(id % 1000 = 3, 77, id * 1000003) AS h")
    edges = spark.createDataFrame([(-1,), (-1,), ((1 << 63) - 1,), ((1 << 63) - 1,), (-(1 << 63),), (0,), (0,)], "h long")
    # The first value is 0 as well.
    found = repeated_hashes(values.union(edges).repartition(6), 16, chunk=500)
    assert rows(found) == sorted([(-1,), ((1 << 63) - 1,), (0,), (77,)], key=lambda r: tuple(map(repr, r)))


def test_packing_gives_hashes_back():
    pack, unpack = uniqueness._packing()
    for n in (1, 2, 1000):
        values = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64))
        assert np.array_equal(unpack(pack(values)), values)


def test_different_keys_of_one_hash_are_not_reported(spark, monkeypatch):
    """All keys collide: all rows are counted by value."""
    monkeypatch.setattr(uniqueness.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    df = spark.createDataFrame([(1,), (2,), (3,), (3,)], "a int")
    assert rows(repeated_values(df, "a")) == [(3, 2)]


def test_a_unique_key_shuffles_few_rows(spark, small_partitions):
    n = 200_000
    df = spark.range(0, n, 1, 8)
    hashes = df.select(F.xxhash64("id").alias("h"))
    assert sum(shuffled_rows(repeated_hashes(hashes, 64))) < 0.05 * n
    assert sum(shuffled_rows(repeated_values(df, "id"))) == 0
    some = df.selectExpr("if(id % 1000 = 1, 1, id) AS id")
    assert sum(shuffled_rows(repeated_values(some, "id"))) < 0.05 * n


def test_a_value_that_fills_a_third_of_the_table(spark, small_partitions):
    df = spark.range(0, 120_000, 1, 8).selectExpr("if(id % 3 = 0, 1, id) AS id")
    assert rows(repeated_values(df, "id")) == [(1, 40_001)]


def test_the_report_is_that_of_the_plain_test(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "a int, b string")
    for columns in ("a", ["a", "b"]):
        assert rows(quality.unique_by_hashes(df, "m", columns)) == rows(quality.unique(df, "m", columns))
