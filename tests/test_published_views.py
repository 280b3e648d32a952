import threading

import pytest

from conftest import rows
from lakeloom.catalog import column_descriptions, create_database, table_description, table_properties
from lakeloom.sinks.tables import VERSION_PROPERTY, expire_view_versions, publish_table, publish_view


@pytest.fixture
def name(spark):
    create_database(spark, "views")
    spark.sql("DROP VIEW IF EXISTS views.v")
    return "views.v"


def test_a_view_is_replaced_with_other_columns_texts_and_partitions(spark, name, tmp_path):
    path = str(tmp_path / "v")
    publish_view(spark.range(3), name, path, description="One.", properties={"a": "1"}, column_comments={"id": "An id."})
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    assert table_description(spark, name) == "One." and column_descriptions(spark, name) == {"id": "An id."}
    wide = spark.range(6).selectExpr("id", "id % 2 AS `part of`", "concat('it''s ', id) AS t")
    publish_view(wide, name, path, description="It's two.", properties={"b": "2"}, partition_by=["part of"], cluster_by=["id"])
    assert spark.table(name).columns == ["id", "part of", "t"] and spark.table(name).count() == 6
    assert table_description(spark, name) == "It's two."
    held = table_properties(spark, name)
    assert held["b"] == "2" and "a" not in held


def test_a_view_can_be_rebuilt_from_itself_and_old_versions_expire(spark, name, tmp_path):
    path = str(tmp_path / "v")
    publish_view(spark.range(3), name, path)
    publish_view(spark.table(name).selectExpr("id + 1 AS id"), name, path)
    assert rows(spark.table(name)) == [(1,), (2,), (3,)]
    assert len(list((tmp_path / "v").glob("version-*"))) == 2
    expire_view_versions(spark, name, path)
    assert len(list((tmp_path / "v").glob("version-*"))) == 1
    assert rows(spark.table(name)) == [(1,), (2,), (3,)]
    tables = [t.name for t in spark.catalog.listTables("views") if t.name.startswith("v__v")]
    assert [f"views.{t}" for t in tables] == [table_properties(spark, name)[VERSION_PROPERTY]]


def test_a_failed_write_changes_nothing(spark, name, tmp_path):
    path = str(tmp_path / "v")
    publish_view(spark.range(3), name, path)
    with pytest.raises(Exception, match="no good"):
        publish_view(spark.range(3).selectExpr("if(id = 1, raise_error('no good'), id) AS id"), name, path)
    with pytest.raises(ValueError, match="do not exist"):
        publish_view(spark.range(3), name, path, cluster_by=["x"])
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]


def test_a_table_is_never_replaced(spark, name, tmp_path):
    publish_table(spark.range(1), "views.t", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="is a table"):
        publish_view(spark.range(1), "views.t", str(tmp_path / "t"))
    spark.sql("DROP TABLE views.t")


def test_a_reader_in_a_loop_never_misses_the_view(spark, name, tmp_path):
    path = str(tmp_path / "v")
    publish_view(spark.range(5), name, path)
    done, failures, seen = threading.Event(), [], set()

    def read():
        while not done.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                failures.append(str(error)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(6):
        frame = spark.range(5).selectExpr("id", f"id % 2 AS p{i}")
        publish_view(frame, name, path, description=f"{i}", partition_by=[f"p{i}"] if i % 2 else [])
    done.set()
    reader.join()
    assert not failures and seen == {5}


def scanned_rows(frame):
    """Rows that come out of the scan, by the metrics of the run plan."""
    frame.collect()
    found = []

    def visit(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return visit(node.executedPlan())
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return sum(found)


def test_filters_on_clustered_columns_read_less(spark, name, tmp_path):
    frame = spark.range(0, 40_000, 1, 8).selectExpr("(id * 7919) % 40000 AS k", "id")
    plain = publish_view(frame, name, str(tmp_path / "plain"))
    assert scanned_rows(plain.where("k < 100")) == 40_000
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clustered = publish_view(frame, name, str(tmp_path / "clustered"), cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert scanned_rows(clustered.where("k < 100")) < 20_000 and clustered.where("k < 100").count() == 100
