"""Process-once ingestion whose memory of files is a table, not a map in the driver.

The names of files taken are rows of a Parquet table, and an anti-join with a listing finds the new ones. The driver
holds the names of one batch and the listing of one folder below the landing folder, however many files there have been. Batches are numbered; a batch counts
once a mark that must not be there before follows its rows and its names, so a run that is cut off leaves nothing that counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.reduced_joins import anti_join
from lakeloom.storage import (
    as_given,
    create_mark,
    delete_folder,
    direct_files,
    glob_paths,
    path_exists,
    scratch_path,
    subfolders,
)

LISTED_AT_ONCE = 10_000
LISTING = "path string, length bigint, modified timestamp"


class LedgerIngest:
    """Appends the files of ``landing``, folders below it included, to the Parquet folder ``target``, each once.

    ``ledger`` is a folder for the table of files taken and the marks of batches. Files are told apart by path, so files of
    any age arrive, and a file that is written anew under its name does not. ``max_files_per_batch`` is what one batch
    takes on average; names are dealt to batches by hash.

    A record that does not parse, or does not fit ``schema``, fails its batch, which then leaves nothing; batches before it
    stay. To keep such records, set the option ``mode`` to ``PERMISSIVE`` and give the schema a string column
    ``_corrupt_record``.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        target: str,
        ledger: str,
        schema: str | T.StructType,
        fmt: str = "json",
        max_files_per_batch: int = 10_000,
        options: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.landing, self.target, self.ledger = (path.rstrip("/") for path in (landing, target, ledger))
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.fmt = fmt
        self.max_files_per_batch = max_files_per_batch
        self.options = dict(options or {})
        if fmt in ("csv", "json"):
            self.options.setdefault("mode", "FAILFAST")

    def _mark(self, kind: str, batch: int) -> str:
        return f"{self.ledger}/marks/{kind}-{batch}"

    def _numbers(self, kind: str) -> set[int]:
        return {int(mark.rsplit("-", 1)[1]) for mark in glob_paths(self.spark, f"{as_given(self.ledger)}/marks/{kind}-*")}

    def batches(self) -> list[int]:
        """Numbers of the batches that count."""
        return sorted(self._numbers("complete"))

    def _batch_rows(self, root: str, schema: T.StructType) -> DataFrame:
        """The rows of counted batches below a folder."""
        numbers = self.batches()
        paths = [f"{root}/batch={number}" for number in numbers]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def taken(self) -> DataFrame:
        """(path, length, modified) of the files taken so far."""
        return self._batch_rows(f"{self.ledger}/files", T.StructType.fromDDL(LISTING))

    def rows(self) -> DataFrame:
        """The rows ingested so far."""
        return self._batch_rows(self.target, self.schema)

    def listing(self) -> DataFrame:
        """(path, length, modified) of the files of ``landing``, listed into a scratch table one folder below it after another."""
        place = scratch_path(self.spark, "landing-listing")
        below = subfolders(self.spark, self.landing) if path_exists(self.spark, self.landing) else []
        for folder in below:
            self._listed([as_given(folder)], place)
        if below:
            loose = direct_files(self.spark, self.landing)
            while names := list(islice(loose, LISTED_AT_ONCE)):
                self._listed([as_given(name) for name in names], place)
        elif path_exists(self.spark, self.landing):
            self._listed([as_given(self.landing)], place)
        if not path_exists(self.spark, place):
            return self.spark.createDataFrame([], LISTING)
        return self.spark.read.schema(LISTING).parquet(place)

    def _listed(self, paths: list[str], place: str) -> None:
        # The reader lists in parallel and opens no file for these columns.
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        files.select("path", "length", F.col("modificationTime").alias("modified")).write.mode("append").parquet(place)

    def discard_unfinished(self) -> None:
        """Delete what runs that were cut off have left. No run may be under way."""
        for batch in self._numbers("taken") - self._numbers("complete"):
            for place in (f"{self.target}/batch={batch}", f"{self.ledger}/files/batch={batch}", self._mark("taken", batch)):
                delete_folder(self.spark, place)

    def run(self) -> int:
        """Take the files that have arrived since the last run; gives their number."""
        place = scratch_path(self.spark, "landing-new")
        anti_join(self.listing(), self.taken(), ["path"]).write.parquet(place)
        new = self.spark.read.schema(LISTING).parquet(place)
        total = new.count()
        parts = -(-total // self.max_files_per_batch)
        for part in range(parts):
            self._take(new.where(F.pmod(F.xxhash64("path"), F.lit(parts)) == part))
        return total

    def _take(self, files: DataFrame) -> None:
        # The names of one batch.
        paths = [row["path"] for row in files.select("path").collect()]
        if not paths:
            return
        batch = max(self.batches(), default=0) + 1
        if not create_mark(self.spark, self._mark("taken", batch)):
            raise RuntimeError(f"batch {batch} is taken: another run is under way or was cut off; see discard_unfinished")
        try:
            arrived = self.spark.read.format(self.fmt).schema(self.schema).options(**self.options)
            arrived.load([as_given(path) for path in paths]).write.parquet(f"{self.target}/batch={batch}")
            files.write.parquet(f"{self.ledger}/files/batch={batch}")
        except Exception:
            for place in (f"{self.target}/batch={batch}", f"{self.ledger}/files/batch={batch}", self._mark("taken", batch)):
                delete_folder(self.spark, place)
            raise
        create_mark(self.spark, self._mark("complete", batch))
