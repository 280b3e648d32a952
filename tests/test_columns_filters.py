import pytest
from pyspark.testing import assertDataFrameEqual

from conftest import plan
from lakeloom.operators.columns import constant_column, drop_fields, rename_fields
from lakeloom.operators.filters import (
    filter_equals,
    filter_equals_and_suffix,
    filter_greater_than,
    top_rows,
)
from lakeloom.sources.files import inline_rows
from lakeloom.sources.named import load_table


@pytest.fixture(scope="module")
def people(spark):
    given = [
        ("ada", 12),
        ("bo", 17),
        ("cy", 22),
        ("cy", 30),
        ("di", 19),
        ("di", 55),
        ("edge", 20),
        ("unknown", None),
    ]
    return inline_rows(spark, given, "name string, age bigint")


def test_greater_than_is_strict_and_drops_nulls(spark, people):
    expected = inline_rows(spark, [("cy", 22), ("cy", 30), ("di", 55)], ["name", "age"])
    assertDataFrameEqual(filter_greater_than(people, "age", 20), expected, checkRowOrder=False)


def test_equals(people):
    assert filter_equals(people, "name", "cy").count() == 2


def test_equals_and_suffix(spark):
    df = inline_rows(
        spark,
        [("t/1", "party/green"), ("t/1", "party/blue"), ("t/2", "party/green"), ("t/1", None)],
        "term string, party string",
    )
    result = filter_equals_and_suffix(df, "term", "t/1", "party", "green")
    assert [tuple(r) for r in result.collect()] == [("t/1", "party/green")]


def test_filters_reach_the_scan(spark, testdata):
    lines = load_table(spark, testdata, "lineitem")
    text = plan(filter_greater_than(lines, "l_quantity", 20).select("l_orderkey"))
    assert "GreaterThan(l_quantity,20.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_top_rows_keep_n_per_task_instead_of_sorting(people):
    top = top_rows(people, ["age", "name"], 3)
    assert "TakeOrderedAndProject" in plan(top)
    assert [r["age"] for r in top.collect()] == [None, 12, 17]


def test_rename_checks_presence_and_clashes(people):
    assert rename_fields(people, {"age": "years"}).columns == ["name", "years"]
    with pytest.raises(ValueError, match="no such columns"):
        rename_fields(people, {"ages": "years"})
    with pytest.raises(ValueError, match="duplicate"):
        rename_fields(people, {"age": "name"})


def test_drop_passes_over_missing_names(people):
    assert drop_fields(people, ["age", "nothing"]).columns == ["name"]


def test_constant_adds_or_overwrites(people):
    assert constant_column(people, "age", 1).distinct().columns == ["name", "age"]
    assert constant_column(people, "place", "here").select("place").distinct().count() == 1
