import pytest

from conftest import plan, rows
from lakeloom import catalog
from lakeloom.sinks.files import write_delimited, write_json
from lakeloom.sinks.tables import expire_versions, publish_table
from lakeloom.sources.discovery import (
    discover_table,
    discover_tables,
    folder_columns,
    read_mixed_headers,
)
from lakeloom.sources.files import delimited_options, read_table
from lakeloom.sources.named import create_source_view, load


@pytest.fixture
def database(spark, tmp_path):
    catalog.create_database(spark, "shop", "The owner's tables", str(tmp_path / "shop"))
    yield "shop"
    catalog.drop_database(spark, "shop", cascade=True)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [(1, "lamp", 40.2, True), (2, "cup", 7.5, True), (3, 'r|"ug', 30.0, False)],
        "id bigint, name string, price double, in_stock boolean",
    )


def test_databases(spark, database, tmp_path):
    assert catalog.database_exists(spark, "shop")
    assert "shop" in catalog.list_databases(spark)
    # Creating it again leaves it as it is.
    catalog.create_database(spark, "shop", "other")
    assert spark.catalog.getDatabase("shop").description == "The owner's tables"


def test_tables_without_session_views(spark, database, products, tmp_path):
    products.createOrReplaceTempView("passing")
    publish_table(products, "shop.products", str(tmp_path / "products"))
    assert catalog.list_tables(spark, "shop") == ["products"]
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY|not empty"):
        catalog.drop_database(spark, "shop")
    catalog.drop_table(spark, "shop.products")
    catalog.drop_table(spark, "shop.products")
    assert catalog.list_tables(spark, "shop") == []
    catalog.drop_database(spark, "shop")
    assert not catalog.database_exists(spark, "shop")


def test_published_table_is_documented(spark, database, products, tmp_path):
    table = publish_table(
        products,
        "shop.products",
        str(tmp_path / "products"),
        description="What the shop's owner sells",
        properties={"source": "stock list", "class": "retail"},
        column_comments={"id": "Number on the shelf", "price": "Price with tax"},
    )
    assert rows(table) == rows(products)
    assert catalog.table_description(spark, "shop.products") == "What the shop's owner sells"
    assert catalog.column_descriptions(spark, "shop.products") == {
        "id": "Number on the shelf",
        "name": None,
        "price": "Price with tax",
        "in_stock": None,
    }
    properties = catalog.table_properties(spark, "shop.products")
    assert properties["source"] == "stock list" and properties["class"] == "retail"


def test_a_table_can_be_replaced_from_itself(spark, database, products, tmp_path):
    path = str(tmp_path / "products")
    publish_table(products, "shop.products", path)
    publish_table(read_table(spark, "shop.products").filter("price > 15"), "shop.products", path)
    assert spark.table("shop.products").count() == 2
    # A failing write leaves the table as it was.
    with pytest.raises(Exception):
        publish_table(products.selectExpr("raise_error('no') AS id"), "shop.products", path)
    assert spark.table("shop.products").count() == 2


def test_versions(spark, database, products, tmp_path):
    path = str(tmp_path / "products")
    publish_table(products, "shop.products", path, "Kept", {"source": "x"}, {"id": "Number"})
    # The same columns and texts: the table moves on.
    publish_table(products.filter("id = 1"), "shop.products", path, "Kept", {"source": "x"}, {"id": "Number"})
    assert catalog.table_description(spark, "shop.products") == "Kept"
    assert catalog.column_descriptions(spark, "shop.products")["id"] == "Number"
    assert spark.table("shop.products").count() == 1
    assert len(list((tmp_path / "products").glob("version-*"))) == 2
    expire_versions(spark, "shop.products", path)
    assert len(list((tmp_path / "products").glob("version-*"))) == 1
    assert spark.table("shop.products").count() == 1
    # Other columns, and nothing left of the old texts.
    publish_table(products.drop("name"), "shop.products", path)
    assert spark.table("shop.products").columns == ["id", "price", "in_stock"]
    assert not catalog.table_description(spark, "shop.products")
    assert "source" not in catalog.table_properties(spark, "shop.products")


def test_partitioned_tables_are_pruned(spark, database, products, tmp_path):
    path = str(tmp_path / "parts")
    for rounds in (products, products.filter("id > 1")):
        table = publish_table(rounds, "shop.parts", path, partition_by=["in_stock"])
        assert rows(table.select(*products.columns)) == rows(rounds)
    assert "PartitionFilters: [isnotnull(in_stock" in plan(table.filter("in_stock"))


def test_a_table_that_owns_its_files_is_kept(spark, database, products, tmp_path):
    products.write.saveAsTable("shop.owned")
    write_delimited(products, str(tmp_path / "files"))
    with pytest.raises(ValueError, match="owns its files"):
        discover_table(spark, "shop.owned", str(tmp_path / "files"), "csv", delimited_options(sep="|"))
    with pytest.raises(ValueError, match="owns its files"):
        publish_table(products, "shop.owned", str(tmp_path / "other"))
    assert spark.table("shop.owned").count() == 3
    catalog.drop_table(spark, "shop.owned")


def test_comments_need_their_column(products, tmp_path):
    with pytest.raises(ValueError, match="do not exist"):
        publish_table(products, "shop.p", str(tmp_path), column_comments={"nothing": "x"})


def test_discovery_of_text(spark, database, products, tmp_path):
    path = str(tmp_path / "files")
    write_delimited(products, path)
    table = discover_table(spark, "shop.found", path, "csv", delimited_options(sep="|"))
    assert table.schema.simpleString() == "struct<id:bigint,name:string,price:double,in_stock:boolean>"
    assert rows(table) == rows(products)
    # Files that arrive later belong to the table.
    write_delimited(products.limit(1), path, mode="append")
    spark.catalog.refreshTable("shop.found")
    assert spark.table("shop.found").count() == 4


def test_discovery_of_all_folders_below_a_prefix(spark, database, products, tmp_path):
    write_delimited(products, str(tmp_path / "lake" / "Product-List"))
    write_delimited(spark.range(5), str(tmp_path / "lake" / "numbers"))
    write_delimited(spark.range(5), str(tmp_path / "lake" / "_hidden"))
    found = discover_tables(
        spark, "shop", str(tmp_path / "lake"), "csv", delimited_options(sep="|")
    )
    assert found == ["shop.product_list", "shop.numbers"]
    assert rows(spark.table("shop.product_list")) == rows(products)
    assert spark.table("shop.numbers").count() == 5


def test_discovery_of_json_with_mixed_types(spark, database, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"id": "1", "n": 1}\n{"id": 2, "n": 2}\n')
    table = discover_table(spark, "shop.mixed", str(tmp_path / "j"), "json")
    assert table.schema.simpleString() == "struct<id:string,n:bigint>"
    assert rows(table) == [("1", 1), ("2", 2)]


def test_discovery_of_parquet_partitions(spark, database, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(10).selectExpr("id", "id % 2 AS odd").write.partitionBy("odd").parquet(path)
    table = discover_table(spark, "shop.parts", path, "parquet")
    assert table.columns == ["id", "odd"]
    assert [c.name for c in spark.catalog.listColumns("shop.parts") if c.isPartition] == ["odd"]
    assert table.filter("odd = 1").count() == 5


def test_sampled_types_do_not_lose_values(spark, database, tmp_path):
    """A value outside the discovered type stops the query; it does not become null."""
    write_json(spark.range(3), str(tmp_path / "n"))
    discover_table(spark, "shop.numbers", str(tmp_path / "n"), "json")
    (tmp_path / "n" / "late.json").write_text('{"id": "text"}\n')
    spark.catalog.refreshTable("shop.numbers")
    with pytest.raises(Exception, match="(?i)malformed"):
        spark.table("shop.numbers").collect()


def test_discovery_reads_all_files_and_folders(spark, database, tmp_path):
    path = str(tmp_path / "logs")
    for day in ("1", "2", "last"):
        write_json(spark.range(4, numPartitions=2), f"{path}/day={day}")
    (tmp_path / "logs" / "day=2" / "odd.json").write_text('{"id": 9, "seldom": 1.5}\n')
    assert folder_columns(spark, path) == ("day",)
    spark.range(4).selectExpr("id", "id % 2 AS a", "id AS b").write.partitionBy("a", "b").json(
        str(tmp_path / "deep")
    )
    assert folder_columns(spark, str(tmp_path / "deep")) == ("a", "b")
    table = discover_table(spark, "shop.logs", path, "json")
    assert table.schema.simpleString() == "struct<id:bigint,seldom:double,day:string>"
    assert table.filter("day = 'last'").count() == 4 and table.count() == 13


def test_headers_in_another_order_are_an_error_or_read_by_name(spark, database, tmp_path):
    for name, text in (("x", "a,b\n1,2\n"), ("y", "b,a\n1,2\n")):
        (tmp_path / "both" / name).mkdir(parents=True)
        (tmp_path / "both" / name / "f.csv").write_text(text)
    both = tmp_path / "mixed"
    both.mkdir()
    (both / "x.csv").write_text("a,b\n1,2\n")
    (both / "y.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        discover_table(spark, "shop.mixed_up", str(both), "csv", {"header": "true"}).collect()
    found = read_mixed_headers(spark, [str(tmp_path / "both" / "x"), str(tmp_path / "both" / "y")])
    assert found.columns == ["a", "b"] and rows(found) == [(1, 2), (2, 1)]


def test_names_that_collide_and_paths_like_patterns(spark, database, products, tmp_path):
    write_delimited(products, str(tmp_path / "lake" / "g[1]"))
    with pytest.raises(ValueError, match="as a pattern"):
        discover_tables(spark, "shop", str(tmp_path / "lake"), "csv", delimited_options(sep="|"))
    found = read_mixed_headers(spark, [str(tmp_path / "lake" / "g[1]")], delimited_options(sep="|"))
    assert rows(found) == rows(products)
    for name in ("a-b", "a_b"):
        write_delimited(products, str(tmp_path / "twice" / name))
    with pytest.raises(ValueError, match="would both be"):
        discover_tables(spark, "shop", str(tmp_path / "twice"), "csv", delimited_options(sep="|"))
    assert not spark.catalog.tableExists("shop.a_b")


def test_source_views_are_the_sources(spark, database, testdata):
    create_source_view(spark, testdata, "organizations", "shop.organizations")
    assert rows(spark.table("shop.organizations")) == rows(load(spark, testdata, "organizations"))
