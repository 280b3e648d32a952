from conftest import rows
from lakeloom import catalog
from lakeloom.plans.jobs import contact_export_job, history_job, translated_contacts
from lakeloom.sinks.tables import publish_table
from lakeloom.sources.files import read_delimited, read_parquet


def shouting():
    """Nested, because the workers cannot import this file."""

    def factory():
        return lambda texts: [text.upper() for text in texts]

    return factory


def contacts(spark):
    given = [(7 - i, "Ms." if i % 2 == 0 else "Mr.") for i in range(7)] + [(50, None)]
    return spark.createDataFrame(given, "customer_id int, title string")


def test_contacts_export(spark, tmp_path):
    catalog.create_database(spark, "people", location=str(tmp_path / "db"))
    publish_table(contacts(spark), "people.customers_csv", str(tmp_path / "customers"))
    contact_export_job(spark, "people.customers_csv", str(tmp_path / "out"), shouting())
    schema = "customer_id int, title string, companyname string, companyname_en string"
    result = read_delimited(spark, str(tmp_path / "out"), schema, sep="|", quoted=False)
    assert rows(result) == [
        (1, "Ms.", "spital", "SPITAL"),
        (3, "Ms.", "spital", "SPITAL"),
        (5, "Ms.", "spital", "SPITAL"),
        (7, "Ms.", "spital", "SPITAL"),
    ]


def test_every_matching_contact_is_translated_once(spark, tmp_path):
    many = spark.range(500).selectExpr("id AS customer_id", "'Ms.' AS title")
    found = translated_contacts(many, shouting(), store=str(tmp_path / "store"))
    assert found.count() == 500 and found.select("companyname_en").distinct().count() == 1
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1


def test_history_from_the_catalog(spark, tmp_path):
    catalog.create_database(spark, "members", location=str(tmp_path / "db"))
    tables = {
        "persons_json": (["p1"], "id string"),
        "memberships_json": ([("p1", "o1")], "person_id string, organization_id string"),
        "organizations_json": ([("o1", "House", 1)], "id string, name string, identifiers int"),
    }
    for name, (given, schema) in tables.items():
        given = [row if isinstance(row, tuple) else (row,) for row in given]
        df = spark.createDataFrame(given, schema)
        publish_table(df, f"members.{name}", str(tmp_path / name))
    history_job(spark, "members", str(tmp_path / "history"))
    history = read_parquet(spark, str(tmp_path / "history"))
    assert history.columns == ["org_name", "id", "organization_id"]
    assert rows(history) == [("House", "p1", "o1")]
