"""Whole jobs: read, transform, write, each with one write action and no preview in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.operators.columns import constant_column, drop_fields, rename_fields
from lakeloom.operators.filters import filter_equals
from lakeloom.operators.joins import join_on
from lakeloom.operators.translate import TranslatorFactory, translate_column
from lakeloom.session import fit_shuffles
from lakeloom.sinks.files import write_parquet, write_unquoted
from lakeloom.sources.files import read_table

# The tables of the history job, title and company of the export, and the number of
# rows of a report of the first contacts.
HISTORY_TABLES = ("persons_json", "memberships_json", "organizations_json")
TITLE, COMPANY, REPORTED_ROWS = "Ms.", "spital", 5


def entity_history(
    persons: DataFrame, memberships: DataFrame, organizations: DataFrame
) -> DataFrame:
    """Persons with their memberships and the organizations these are in.

    The person keeps ``id`` and the membership ``organization_id``; the key copies are dropped.
    """
    organizations = rename_fields(
        drop_fields(organizations, ["other_names", "identifiers"]),
        {"id": "org_id", "name": "org_name"},
    )
    members = join_on(persons, memberships, "id", "person_id")
    history = join_on(organizations, members, "org_id", "organization_id")
    return drop_fields(history, ["person_id", "org_id"])


def history_job(
    spark: SparkSession, database: str, output: str, input_bytes: int | None = None
) -> None:
    """Join the catalog's person, membership and organization tables and store the history.

    ``input_bytes``, the size of the tables, raises the number of shuffle partitions to fit.
    """
    if input_bytes is not None:
        fit_shuffles(spark, input_bytes)
    tables = [read_table(spark, f"{database}.{name}") for name in HISTORY_TABLES]
    write_parquet(entity_history(*tables), output)


def translated_contacts(
    contacts: DataFrame,
    factory: TranslatorFactory,
    store: str | None = None,
    title: str = TITLE,
    company: str = COMPANY,
) -> DataFrame:
    """All contacts with a title, with a company name and its translation.

    ``store`` as in :func:`~lakeloom.operators.translate.translate_column`.
    """
    named = constant_column(filter_equals(contacts, "title", title), "companyname", company)
    return translate_column(named, "companyname", "companyname_en", factory, store=store)


def contact_export_job(
    spark: SparkSession, table: str, output: str, factory: TranslatorFactory, **options
) -> None:
    """Export translated contacts of a catalog table as unquoted, pipe-separated text."""
    write_unquoted(translated_contacts(read_table(spark, table), factory, **options), output)
