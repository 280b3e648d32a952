from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from lakeloom.functions.json_maps import json_map_totals, map_total
from lakeloom.functions.money import cents_to_dollars
from lakeloom.functions.udfs import string_udf


def test_cents_are_exact(spark):
    df = spark.createDataFrame([(1050,), (-1,), (0,), (None,)], "cents int")
    result = [r[0] for r in df.select(cents_to_dollars("cents")).collect()]
    assert result == [Decimal("10.50"), Decimal("-0.01"), Decimal("0.00"), None]


def test_cents_precision(spark):
    df = spark.createDataFrame([(1055,)], "cents bigint")
    assert df.select(cents_to_dollars(F.col("cents"), 1)).first()[0] == Decimal("10.6")
    assert df.select(cents_to_dollars("cents", 4).alias("d")).schema["d"].dataType.simpleString() == (
        "decimal(16,4)"
    )


def test_json_total_of_a_document(spark):
    df = spark.createDataFrame([('{"7": 100.25, "8": 20.5, "9": 3.01}',)], "j string")
    total = json_map_totals(df, "j").first()
    assert round(total["total_order_value"], 2) == 123.76
    assert total["message"] == "Total order value is: 123.76"


def test_json_totals_count_bad_documents(spark):
    given = [('{"a": 1}',), ("{}",), ("nonsense",), ('{"a": "x"}',), ('{"a": null}',), (None,)]
    df = spark.createDataFrame(given, "j string")
    total = json_map_totals(df, "j").first()
    assert (total["total_order_value"], total["valid_documents"], total["invalid_documents"]) == (
        1.0,
        2,
        3,
    )


def test_repeated_names_count_once_with_the_last_value(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 10, "a": 2, "a": 4}',)], "j string")
    parsed = df.select(F.from_json("j", "map<string,double>").alias("m"))
    assert parsed.select(map_total(F.col("m"))).first()[0] == 14.0


def test_json_totals_of_nothing(spark):
    total = json_map_totals(spark.createDataFrame([], "j string"), "j").first()
    assert total["total_order_value"] is None
    assert total["valid_documents"] == 0


def test_string_udf_is_null_safe(spark):
    upper = string_udf(str.upper)
    df = spark.createDataFrame([("a",), (None,), ("a",), ("",)], "s string")
    assert rows(df.select(upper("s").alias("u"))) == [("",), ("A",), ("A",), (None,)]
