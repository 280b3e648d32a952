import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeloom.functions.exact_sums import exact_sum, split
from lakeloom.functions.json_maps import json_map_exact_totals


def exactly(values):
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def odd_values():
    rnd = random.Random(5)
    values = [math.ldexp(sign * (1 + rnd.random()), e) for e in range(-1074, 1023) for sign in (1, -1)]
    powers = [math.ldexp(1.0, e) for e in range(-1074, 1024)]
    near = [math.nextafter(p, direction) for p in powers for direction in (0.0, math.inf)]
    return [v for v in [*values, *powers, *near, 0.0, -0.0, 5e-324, 1.7976931348623157e308] if math.isfinite(v)]


def test_every_double_is_a_whole_number_times_a_power(spark):
    values = odd_values()
    exponent, whole = split(F.col("v"))
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", exponent.alias("e"), whole.alias("w"))
    for row in df.collect():
        assert Fraction(row.w) * Fraction(2) ** row.e == Fraction(row.v), row


@pytest.mark.parametrize("seed", range(3))
def test_the_sum_is_the_nearest_double_in_any_order(spark, seed):
    rnd = random.Random(seed)
    values = [math.ldexp(rnd.uniform(-1, 1), rnd.randrange(-60, 60)) for _ in range(3000)]
    values += [1e100, 1.0, -1e100, 2**-1074]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for parts in (1, 3, 16):
        assert exact_sum(df.repartition(parts), "v").first()[0] == exactly(values)


def test_groups_nulls_and_special_values(spark):
    inf, nan = float("inf"), float("nan")
    given = [("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", None), (None, 1e308), (None, 1e308), ("c", inf), ("c", 1.0), ("d", inf), ("d", -inf), ("e", nan)]
    found = {row.k: row.total for row in exact_sum(spark.createDataFrame(given, "k string, v double"), "v", ["k"]).collect()}
    assert found["a"] == exactly([0.1, 0.2, 0.3]) and found["b"] is None and found[None] == inf and found["c"] == inf
    assert math.isnan(found["d"]) and math.isnan(found["e"])
    assert rows(exact_sum(spark.createDataFrame([], "v double"), "v")) == [(None,)]
    assert rows(exact_sum(spark.createDataFrame([(1,), (2,)], "v int"), "v")) == [(3.0,)]


def test_json_totals_do_not_depend_on_the_order(spark):
    documents = [f'{{"a": {0.1 * i}, "b": {1e10 / (i + 1)}}}' for i in range(500)] + ["no json", None]
    df = spark.createDataFrame([(d,) for d in documents], "d string")
    totals = {tuple(json_map_exact_totals(df.repartition(parts), "d").first()) for parts in (1, 4, 9)}
    assert len(totals) == 1
    total, valid, invalid, message = totals.pop()
    assert total == exactly([0.1 * i + 1e10 / (i + 1) for i in range(500)]) and (valid, invalid) == (500, 1)
    assert message == f"Total order value is: {total:.2f}"
