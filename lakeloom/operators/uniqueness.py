"""Repeated values of a key, found without shuffling rows whose key is unique.

The first pass moves packed hashes instead of rows: every task sorts the hashes of its keys and cuts them into
ranges, a few bytes a key in one value per range. A task that is dealt a range finds the hashes that stand in it twice. The
second pass counts, by value, only the rows with such a hash, so different keys of one hash do no harm.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.reduced_joins import MAX_LISTED, listed_in
from lakeloom.storage import scratch_path

#: Hashes a task sorts at a time.
CHUNK = 1 << 21


def _packing() -> tuple[Callable, Callable]:
    """(pack, unpack) for sorted hashes; nested, so that workers need not import this package."""

    def pack(values: np.ndarray) -> bytes:
        steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
        # Byte planes: the high ones of small steps are zero.
        return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)

    def unpack(data: bytes) -> np.ndarray:
        planes = np.frombuffer(zlib.decompress(data), np.uint8)
        steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8")[:, 0]
        return np.cumsum(steps, dtype=np.uint64)

    return pack, unpack


def repeated_hashes(hashes: DataFrame, ranges: int, chunk: int = CHUNK) -> DataFrame:
    """(h): the values of the column ``h`` (long) that occur more than once.

    Shuffles one row per task, chunk and range. A task holds the hashes of one range at a time.
    """
    pack, unpack = _packing()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            place = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            bounds = np.searchsorted(place, np.arange(ranges + 1, dtype=np.uint64))
            own = np.flatnonzero(np.diff(bounds))
            once, twice = [], []
            for i in own.tolist():
                part, many = values[bounds[i] : bounds[i + 1]], counts[bounds[i] : bounds[i + 1]] > 1
                once.append(pack(part))
                twice.append(pack(part[many]) if many.any() else None)
            columns = [pa.array(own, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["place", "once", "twice"])

        parts, held = [], 0
        for batch in batches:
            parts.append(batch.column(0).to_numpy().view(np.uint64))
            held += batch.num_rows
            if held >= chunk:
                yield emit(parts)
                parts, held = [], 0
        if held:
            yield emit(parts)

    def collided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(once: list[bytes], twice: list[bytes]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate([unpack(data) for data in once]), return_counts=True)
            found = [values[counts > 1], *map(unpack, twice)]
            return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], ["h"])

        present, once, twice = None, [], []
        for batch in batches:
            for place, a, b in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if place != present and once:
                    yield emit(once, twice)
                    once, twice = [], []
                present = place
                once.append(a)
                twice += [b] if b is not None else []
        if once:
            yield emit(once, twice)

    parts = hashes.select("h").mapInArrow(packed, "place long, once binary, twice binary")
    # A range is dealt to one task, which takes its ranges one after another.
    dealt = parts.repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(collided, "h long")


def repeated_values(
    df: DataFrame, columns: str | Sequence[str], ranges: int | None = None, max_listed: int = MAX_LISTED
) -> DataFrame:
    """The values, or combinations of values, that occur more than once, with ``n_rows``. Nulls do not count.

    Reads ``df`` once for the hashes and, if any repeats, once more. ``max_listed`` bounds the repeated hashes that go to
    every task; beyond it, where much of the table is repeated anyway, Spark's aggregation counts all rows.
    ``ranges`` defaults to four for each shuffle partition.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    spark = df.sparkSession
    ranges = ranges or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    present = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])
    keyed = df.select(*columns).where(present)
    path = scratch_path(spark, "repeated-hashes")
    repeated_hashes(keyed.select(F.xxhash64(*columns).alias("h")), ranges).write.parquet(path)
    found = spark.read.schema("h long").parquet(path)
    n = found.count()
    if n == 0:
        keyed = keyed.where(F.lit(False))
    elif n <= max_listed:
        keyed = keyed.where(listed_in(keyed, np.sort(found.toArrow()["h"].to_numpy()))(F.xxhash64(*columns)))
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
