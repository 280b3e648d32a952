import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeloom.operators import reduced_joins
from lakeloom.operators.reduced_joins import anti_join, build_filter, maybe_in, semi_join
from test_scale import final_plan, shuffled_rows, small_partitions  # noqa: F401

NULLS = [(None, 1), (1, None), (None, None)]


def both(spark, left, right, schema="a int, b int", right_schema="a int, b int", **settings):
    wide = spark.createDataFrame(left, schema).withColumn("text", F.lit("t"))
    keys = spark.createDataFrame(right, schema)
    keys = keys.select(*[F.col(name).cast(kind) for name, kind in (part.split() for part in right_schema.split(", "))])
    for how, join in (("left_semi", semi_join), ("left_anti", anti_join)):
        yield rows(join(wide, keys, ["a", "b"], **settings)), rows(wide.join(keys, ["a", "b"], how).select(*wide.columns))


@pytest.mark.parametrize("settings", [{}, {"max_listed": 0}, {"max_filter_bytes": 1}])
def test_rows_are_those_of_the_plain_join(spark, settings):
    rnd = random.Random(1)
    left = [(rnd.randrange(60), rnd.randrange(40)) for _ in range(800)] + NULLS + NULLS
    right = [(rnd.randrange(60), rnd.randrange(40)) for _ in range(500)] + NULLS
    for actual, expected in both(spark, left, right, **settings):
        assert actual == expected
    for actual, expected in both(spark, left, right, right_schema="a bigint, b double", **settings):
        assert actual == expected


def test_empty_sides(spark):
    for left, right in (([], [(1, 1)]), ([(1, 1)], []), ([], [])):
        for actual, expected in both(spark, left, right):
            assert actual == expected


def test_null_safe_keys(spark):
    left = spark.createDataFrame([(None, "x"), (1, "y"), (2, "z")], "id bigint, text string")
    right = spark.createDataFrame([(None,), (2,)], "id int")
    assert rows(semi_join(left, right, ["id"], null_safe=True)) == [(2, "z"), (None, "x")]
    assert rows(anti_join(left, right, ["id"], null_safe=True)) == [(1, "y")]
    assert rows(semi_join(left, right, ["id"])) == [(2, "z")]
    assert rows(anti_join(left, right, ["id"])) == [(1, "y"), (None, "x")]


def test_zeros_and_nans_are_one_value(spark):
    left = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (1.5,)], "v double")
    right = spark.createDataFrame([(-0.0,), (float("nan"),)], "v double")
    assert semi_join(left, right, ["v"]).count() == 3
    assert rows(anti_join(left, right, ["v"])) == [(1.5,)]


def test_other_names_and_columns_of_the_right_side_stay_out(spark):
    left = spark.createDataFrame([(1, "h"), (2, "h")], "id int, h string")
    right = spark.createDataFrame([(1, "no")], "key int, h string")
    assert rows(semi_join(left, right, ["id"], ["key"])) == [(1, "h")]
    with pytest.raises(ValueError, match="left_outer"):
        reduced_joins.reduced_join(left, right, ["id"], ["key"], "left_outer")


def test_the_filter_misses_no_key_and_few_others_pass(spark):
    hashes = spark.range(40_000).select(F.xxhash64("id").alias("h"))
    shards = -(-40_000 * reduced_joins.BITS_PER_KEY // (8 * reduced_joins.SHARD_BYTES))
    maybe = maybe_in(hashes, build_filter(hashes, shards))
    assert hashes.where(~maybe(F.col("h"))).count() == 0
    others = spark.range(1_000_000, 1_100_000).select(F.xxhash64("id").alias("h"))
    assert others.where(maybe(F.col("h"))).count() < 400


def test_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    """All keys collide, so every row is decided by the exact join."""
    monkeypatch.setattr(reduced_joins.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    for actual, expected in both(spark, [(1, 1), (1, 1), (2, 2), (None, 1)], [(1, 1), (3, 3)]):
        assert actual == expected


def test_wide_rows_pass_no_exchange(spark, small_partitions):
    wide = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 5, id) AS id", "repeat('x', 200) AS text")
    gone = spark.range(0, 60_000, 7)
    kept = anti_join(wide, gone, ["id"])
    assert "Exchange" not in final_plan(kept) and "Join" not in final_plan(kept)
    assert kept.count() == wide.join(gone, "id", "left_anti").count()
    # Beyond the list's bound only the rows that the filter does not decide are shuffled.
    undecided = anti_join(wide, gone, ["id"], max_listed=0)
    assert undecided.count() == kept.count()
    assert max(shuffled_rows(undecided), default=0) < 20_000


def test_a_hot_key_is_one_row_per_task(spark, small_partitions):
    wide = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 3 = 0, 5, id) AS id")
    keys = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 2 = 0, 5, id) AS id")
    assert semi_join(wide, keys, ["id"]).count() == wide.join(keys.distinct(), "id", "left_semi").count()


def test_positions_stay_inside_their_shard():
    positions = reduced_joins._positions()
    hashes = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 10_000)
    shard, bits = positions(hashes, 3)
    assert set(shard.tolist()) == {0, 1, 2} and bits.min() >= 0 and bits.max() < 8 * reduced_joins.SHARD_BYTES
