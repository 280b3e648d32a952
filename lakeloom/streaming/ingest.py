"""Process-once file ingestion: each run takes the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# A hundred years: files are told apart by name, never by age, so back-fills with old times arrive.
ANY_AGE = "36500d"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: str | T.StructType,
    fmt: str = "json",
    max_files_per_batch: int = 10_000,
    options: Mapping[str, str] | None = None,
    archive: str | None = None,
) -> None:
    """Append the new files of ``landing`` to the Parquet folder ``target``, then stop.

    ``checkpoint`` remembers the files taken; source log and sink log together make the append
    exactly-once, also when a run is cut off and started again. A backlog is worked through in
    micro-batches of ``max_files_per_batch`` files. Files of any age are taken.

    A record that does not parse, or does not fit ``schema``, fails the run before its batch is
    committed. To keep such records instead, set the option ``mode`` to ``PERMISSIVE`` and give the
    schema a string column ``_corrupt_record``, which then holds the raw line.

    The driver holds the names of all files that ``landing`` has and has taken, and the target's log those
    of all files written. ``archive`` moves the files of finished batches to that folder, which
    keeps the listing of ``landing`` short.
    """
    options = dict(options or {})
    if unwanted := {"maxfileage", "cleansource"} & {name.lower() for name in options}:
        raise ValueError(f"options {sorted(unwanted)} would leave files out; see archive")
    if fmt in ("csv", "json"):
        options.setdefault("mode", "FAILFAST")
    if archive is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    arrivals = (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(**options)
        .option("maxFileAge", ANY_AGE)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(landing)
    )
    query = (
        arrivals.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, target: str, schema: str | T.StructType) -> DataFrame:
    """The rows ingested so far."""
    return spark.read.schema(schema).parquet(target)
