"""Type-2 history of a mutable table: one row per key and state, with its validity interval."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.aggregates import first_rows
from lakeloom.storage import (
    as_given,
    create_mark,
    delete_folder,
    glob_paths,
    path_exists,
    read_text_file,
    subfolders,
    write_text_file,
)

HISTORY_COLUMNS = ("scd_id", "scd_updated_at", "valid_from", "valid_to")


def version_id(df: DataFrame, keys: Sequence[str], updated_at: str) -> Column:
    """Row id of a state: MD5 over the key and the time of the change.

    The time enters in a form that no session setting affects: all six digits of the fraction for a
    timestamp without time zone, microseconds since 1970 for one with, else as text.
    """
    moment, moment_type = F.col(updated_at), df.schema[updated_at].dataType
    if isinstance(moment_type, T.TimestampNTZType):
        whole = moment.cast("string")
        fraction = F.when(whole.contains("."), F.substring_index(whole, ".", -1)).otherwise("")
        text = F.concat(F.substring_index(whole, ".", 1), F.lit("."), F.rpad(fraction, 6, "0"))
    elif isinstance(moment_type, T.TimestampType):
        text = F.unix_micros(moment).cast("string")
    else:
        text = moment.cast("string")
    parts = [F.col(key).cast("string") for key in keys]
    if len(parts) > 1:
        # Lengths keep parts apart that hold the separator, and a null apart from an empty text.
        parts = [F.concat(F.length(part).cast("string"), F.lit(":"), part) for part in parts]
    return F.md5(F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in (*parts, text)]))


def latest_states(df: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    """The latest row of each key; equal times are settled by the other columns, largest first.

    Map columns have no order and settle nothing.
    """
    others = [
        f.name
        for f in df.schema
        if f.name not in (*keys, updated_at) and "map<" not in f.dataType.simpleString()
    ]
    order = [F.col(name).desc_nulls_last() for name in (updated_at, *others)]
    return first_rows(df, keys, order)


def merge_history(
    open_rows: DataFrame, incoming: DataFrame, keys: Sequence[str], updated_at: str
) -> DataFrame:
    """Merge the latest states into the open history rows; adds the flag ``is_open``.

    ``open_rows`` holds the source's columns and :data:`HISTORY_COLUMNS`, one row per key, and
    ``incoming`` the source's columns. Per key:

    * only in ``incoming``: a new open row;
    * in both, and the incoming change is later: the open row closed at that time, and a new one;
    * otherwise the open row as it is. So an older or repeated state changes nothing, and a key
      missing from the source stays open.

    A null key equals no other, so it is new in every run.

    Both sides have one row per key, so the full outer join has no hot key, and its one pass
    gives closed and open rows together.
    """
    columns = incoming.columns
    states = latest_states(incoming, keys, updated_at)
    new_rows = states.select(
        "*",
        version_id(states, keys, updated_at).alias("scd_id"),
        F.col(updated_at).alias("scd_updated_at"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(states.schema[updated_at].dataType).alias("valid_to"),
    )
    fields = [*columns, *HISTORY_COLUMNS]
    old = open_rows.select(*fields).alias("old").withColumn("_in_old", F.lit(True))
    new = new_rows.select(*fields).alias("new").withColumn("_in_new", F.lit(True))
    same_key = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys]
    joined = old.join(new, same_key, "full_outer")

    has_old, has_new = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()
    changed = has_old & has_new & (F.col("new.valid_from") > F.col("old.valid_from"))
    changed = F.coalesce(changed, F.lit(False))

    def row(side: str, valid_to: Column, is_open: Column) -> Column:
        values = [F.col(f"{side}.{name}").alias(name) for name in fields if name != "valid_to"]
        return F.struct(*values, valid_to.alias("valid_to"), is_open.alias("is_open"))

    old_row = row(
        "old", F.when(changed, F.col("new.valid_from")).otherwise(F.col("old.valid_to")), ~changed
    )
    new_row = row("new", F.col("new.valid_to"), F.lit(True))
    rows = F.array(
        F.when(has_old, old_row), F.when(changed | (has_new & ~has_old), new_row)
    )
    present = F.filter(rows, lambda r: r.isNotNull())
    return joined.select(F.inline(present)).select(*fields, "is_open")


class SnapshotTable:
    """Type-2 history kept as Parquet below a folder, one folder per run, open rows in buckets by hash of the key.

    A run finds the buckets in which a key is new or has changed, from keys and times alone. It writes the state of every
    key of those buckets to ``run=<n>/is_open=true/bucket=<b>`` and the rows it closed to
    ``run=<n>/is_open=false/bucket=<b>``. A manifest says which run's folder holds each bucket, so all other
    buckets are carried over without being read in full or written. Earlier closed rows are never read or rewritten by a run.

    ``buckets`` is fixed when the first run is made; about one for each gigabyte of open rows keeps a rewrite small.

    A run first takes its number by creating a mark that must not be there, and counts once a second
    mark follows the data and the manifest. So of two runs at a time one fails, whatever Spark's own marks are set to,
    and no folder is written over. A run that fails gives its number back; one that is cut off
    keeps it until :meth:`discard_unfinished`.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        updated_at: str,
        schema: T.StructType,
        buckets: int = 1,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.updated_at = updated_at
        self.source_schema = schema
        self.buckets = buckets
        moment = schema[updated_at].dataType
        self.history_schema = T.StructType(
            [
                *[T.StructField(f.name, f.dataType, True) for f in schema],
                T.StructField("scd_id", T.StringType()),
                T.StructField("scd_updated_at", moment),
                T.StructField("valid_from", moment),
                T.StructField("valid_to", moment),
            ]
        )

    def runs(self) -> list[int]:
        """Numbers of the completed runs."""
        marks = glob_paths(self.spark, f"{as_given(self.root)}/_marks/complete-*")
        return sorted(int(mark.rsplit("-", 1)[1]) for mark in marks)

    def _mark(self, kind: str, run: int) -> str:
        return f"{self.root}/_marks/{kind}-{run}"

    def _manifest_file(self, run: int) -> str:
        return f"{self.root}/_marks/manifest-{run}"

    def manifest(self, run: int) -> dict[int, int]:
        """The run whose folder holds the open rows of each bucket that has any, after ``run``."""
        lines = read_text_file(self.spark, self._manifest_file(run)).splitlines()
        if lines[:1] != [f"buckets {self.buckets}"]:
            raise ValueError(f"the history has {lines[0] if lines else 'no manifest'}, not buckets {self.buckets}")
        return {int(bucket): int(held) for bucket, held in (line.split() for line in lines[1:])}

    def _write_manifest(self, run: int, held: Mapping[int, int]) -> None:
        lines = [f"buckets {self.buckets}", *(f"{bucket} {at}" for bucket, at in sorted(held.items()))]
        write_text_file(self.spark, self._manifest_file(run), "\n".join(lines))

    def bucket(self) -> Column:
        """The bucket of a row by its key."""
        keys = [F.col(key).cast(self.source_schema[key].dataType) for key in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def discard_unfinished(self) -> None:
        """Delete what runs that were cut off have left. No run may be under way."""
        complete = set(self.runs())
        folders = [path for path in subfolders(self.spark, self.root) if "/run=" in path]
        marks = [mark for kind in ("taken", "manifest") for mark in glob_paths(self.spark, f"{as_given(self.root)}/_marks/{kind}-*")]
        for place in (*folders, *marks):
            if int(re.search(r"(\d+)$", place).group(1)) not in complete:
                delete_folder(self.spark, place)

    def _read(self, paths: Sequence[str]) -> DataFrame:
        schema = T.StructType(
            [
                *self.history_schema.fields,
                T.StructField("run", T.IntegerType()),
                T.StructField("is_open", T.BooleanType()),
                T.StructField("bucket", T.IntegerType()),
            ]
        )
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def _open_rows(self, held: Mapping[int, int], buckets: Iterable[int] | None = None) -> DataFrame:
        """The open rows of the given buckets, all of them unless told."""
        wanted = sorted(held) if buckets is None else sorted(set(buckets) & set(held))
        paths = [f"{self.root}/run={held[bucket]}/is_open=true/bucket={bucket}" for bucket in wanted]
        return self._read(paths).drop("run", "is_open", "bucket")

    def _touched(self, source: DataFrame, held: Mapping[int, int]) -> list[int]:
        """The buckets in which the source has a key that is new or later than its open row.

        Reads the keys and times of both sides; one number per bucket comes to the driver.
        """
        latest = source.groupBy(*self.keys).agg(F.max(self.updated_at).alias("_latest")).withColumn("_bucket", self.bucket())
        known = self._open_rows(held).select(*self.keys, F.col("valid_from").alias("_known"), F.lit(True).alias("_old"))
        joined = latest.join(known, self.keys, "left")
        # Open rows without a time stay as they are, as in the merge.
        fresh = F.col("_old").isNull() | (F.col("_latest") > F.col("_known"))
        return sorted(row["_bucket"] for row in joined.where(fresh).select("_bucket").distinct().collect())

    def apply(self, source: DataFrame) -> int:
        """Merge the source's present state into the history; gives the run's number."""
        names = self.source_schema.fieldNames()
        if set(source.columns) != set(names):
            raise ValueError(f"the source has columns {source.columns}, the history {names}")
        runs = self.runs()
        run = runs[-1] + 1 if runs else 1
        held = self.manifest(runs[-1]) if runs else {}
        source = source.select(*names)
        if not create_mark(self.spark, self._mark("taken", run)):
            raise RuntimeError(f"run {run} is taken: another is under way or was cut off")
        folder = f"{self.root}/run={run}"
        if path_exists(self.spark, folder):
            delete_folder(self.spark, self._mark("taken", run))
            raise RuntimeError(f"{folder} holds data no run has marked; see discard_unfinished")
        try:
            touched = self._touched(source, held) if self.buckets > 1 else [0]
            if touched:
                incoming = source.where(self.bucket().isin(touched)) if len(touched) < self.buckets else source
                merged = merge_history(self._open_rows(held, touched), incoming, self.keys, self.updated_at)
                merged = merged.withColumn("bucket", self.bucket())
                # Each bucket is written by one task, so a run leaves one file per bucket and kind.
                dealt = merged.repartition("bucket") if self.buckets > 1 else merged
                dealt.write.partitionBy("is_open", "bucket").parquet(folder)
            written = subfolders(self.spark, f"{folder}/is_open=true") if path_exists(self.spark, f"{folder}/is_open=true") else []
            fresh = {int(path.rsplit("=", 1)[1]): run for path in written}
            self._write_manifest(run, {**held, **fresh})
        except Exception:
            delete_folder(self.spark, folder)
            delete_folder(self.spark, self._manifest_file(run))
            delete_folder(self.spark, self._mark("taken", run))
            raise
        create_mark(self.spark, self._mark("complete", run))
        return run

    def _closed_rows(self) -> DataFrame:
        """The rows that completed runs have closed."""
        complete = set(self.runs())
        folders = glob_paths(self.spark, f"{as_given(self.root)}/run=*/is_open=false", folders_only=True)
        closed = [path for path in folders if int(re.search(r"run=(\d+)/is_open=false$", path).group(1)) in complete]
        return self._read(closed).drop("run", "is_open", "bucket")

    def history(self) -> DataFrame:
        """All states of all keys: the open rows the last manifest names and every run's closed rows."""
        return self._closed_rows().unionByName(self.current())

    def current(self) -> DataFrame:
        """The open row of every key."""
        runs = self.runs()
        return self._open_rows(self.manifest(runs[-1]) if runs else {})

    def changed(self) -> DataFrame:
        """The history of those keys only that have changed since they were first seen."""
        closed = self._closed_rows().filter("valid_to is not null")
        # Closed rows qualify by themselves; open rows are one per key, so the join has no hot key.
        open_rows = self.current().filter("valid_to is null")
        keys = closed.select(*self.keys).distinct()
        return closed.unionByName(open_rows.join(keys, self.keys, "left_semi"))

    def expire(self, keep: int = 2) -> None:
        """Delete the open rows that none of the last ``keep`` runs' manifests names.

        Closed rows are kept, so the history stays whole. Readers of an older run must be done.
        """
        if keep < 1:
            raise ValueError("the last run's open rows are part of the history")
        runs = self.runs()
        named = {pair for run in runs[-keep:] for pair in self.manifest(run).items()}
        for run in runs[:-keep]:
            folder = f"{self.root}/run={run}/is_open=true"
            buckets = subfolders(self.spark, folder) if path_exists(self.spark, folder) else []
            left = [path for path in buckets if (int(path.rsplit("=", 1)[1]), run) in named]
            for path in buckets if left else [folder]:
                if path not in left:
                    delete_folder(self.spark, path)
