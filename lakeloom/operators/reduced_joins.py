"""Semi and anti joins that decide most rows of the wide side without moving them.

A Bloom filter of the smaller key set goes to all tasks, after a check of its size. A key outside it is surely not
in the set. Keys inside it are looked up exactly, keys alone: those that are not in the set after all, a few
in a thousand, make a second, exact list of hashes. With both, every row is decided where it stands, and
rows are shuffled only where two different keys share all 64 bits of their hash. Where the filter or the list would be
too large, Spark's own join does it: for the undecided rows if only the list is, else for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.storage import scratch_path

BITS_PER_KEY = 16
PROBES = 8
#: A filter is built and sent in shards of so many bytes.
SHARD_BYTES = 1 << 16
MAX_FILTER_BYTES = 64 << 20
MAX_LISTED = 2_000_000
#: Odd multipliers that draw further positions from one hash.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _positions() -> Callable:
    """Nested, so that workers need not import this package."""
    first, second, probes, shard_bits = FIRST, SECOND, PROBES, 8 * SHARD_BYTES

    def positions(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """(shard, bit in the shard) of each key's probes: one shard for a key, so it is built in one place."""
        h = hashes.view(np.uint64)
        x = (h ^ (h >> np.uint64(32))) * first
        shard = ((x >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        y = (x ^ (x >> np.uint64(29))) * second
        step = (y >> np.uint64(40)) | np.uint64(1)
        start = y & np.uint64(0xFFFFFFFF)
        bits = (start[:, None] + step[:, None] * np.arange(probes, dtype=np.uint64)) % np.uint64(shard_bits)
        return shard.astype(np.int64), bits.astype(np.int64)

    return positions


def _keys(frame: DataFrame, columns: Sequence[str], types: Sequence, null_safe: bool) -> tuple[list[Column], Column, Column]:
    """The key's columns in common types, the hash of the key, and whether the key can equal another."""
    values = [F.col(name).cast(kind) for name, kind in zip(columns, types, strict=True)]
    nulls = reduce(lambda a, b: a + b, [F.when(v.isNull(), F.lit(1 << i)).otherwise(0) for i, v in enumerate(values)])
    # Null columns leave a hash as it is, so which ones are null enters too.
    code = F.xxhash64(nulls, *values)
    return values, code, F.lit(True) if null_safe else nulls == 0


def build_filter(hashes: DataFrame, shards: int) -> np.ndarray:
    """Bloom filter of the column ``h`` (long): one row of bytes per shard.

    Each task makes the bits of the shards it is dealt, so no filter is merged from partial ones.
    """
    positions = _positions()
    size = SHARD_BYTES

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            shard, bits = positions(batch.column(1).to_numpy(), shards)
            for own in np.unique(shard).tolist():
                marks = held.setdefault(own, np.zeros(size, np.uint8))
                at = bits[shard == own].ravel()
                np.bitwise_or.at(marks, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        for own, marks in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([marks.tobytes()], pa.binary())], ["shard", "marks"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, _ = positions(batch.column(0).to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard), batch.column(0)], ["shard", "h"])

    dealt = hashes.select("h").mapInArrow(numbered, "shard long, h long").repartition("shard")
    table = dealt.mapInArrow(fill, "shard long, marks binary").toArrow()
    marks = np.zeros((shards, size), np.uint8)
    for shard, value in zip(table["shard"].to_pylist(), table["marks"], strict=True):
        marks[shard] = np.frombuffer(value.as_buffer(), np.uint8)
    return marks


def maybe_in(frame: DataFrame, marks: np.ndarray) -> Callable[[Column], Column]:
    """Column function from a hash to whether the filter holds it; no hash it was built from is missed."""
    shared = frame.sparkSession.sparkContext.broadcast(marks)
    positions = _positions()

    def test(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        marks = shared.value
        for part in parts:
            shard, bits = positions(part.to_numpy(zero_copy_only=False), len(marks))
            found = (marks[shard[:, None], bits >> 3] >> (bits & 7)) & 1
            yield pa.array(found.all(axis=1))

    return F.arrow_udf(test, "boolean")


def listed_in(frame: DataFrame, hashes: np.ndarray) -> Callable[[Column], Column]:
    """Column function from a hash to whether it is one of the sorted hashes."""
    shared = frame.sparkSession.sparkContext.broadcast(hashes)

    def test(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for part in parts:
            values = part.to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            yield pa.array(known[at] == values)

    return F.arrow_udf(test, "boolean")


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def semi_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None, **settings) -> DataFrame:
    """The rows of ``left`` whose key ``right`` has; see :func:`reduced_join`."""
    return reduced_join(left, right, left_on, right_on, "left_semi", **settings)


def anti_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None, **settings) -> DataFrame:
    """The rows of ``left`` whose key ``right`` lacks; see :func:`reduced_join`."""
    return reduced_join(left, right, left_on, right_on, "left_anti", **settings)


def reduced_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str] | None = None,
    how: str = "left_semi",
    null_safe: bool = False,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    max_listed: int = MAX_LISTED,
) -> DataFrame:
    """Spark's ``left_semi`` or ``left_anti`` join of ``left`` with the keys of ``right``, for a wide left side.

    Rows and their repetitions are those of the plain join. A null in a key equals nothing, unless ``null_safe``. Key
    columns of different types are compared in the wider one. The keys of both sides are read and shuffled once each, with one
    row per key and task; the rest of ``left`` is read once, when the result is, and not shuffled.

    ``max_filter_bytes`` bounds the filter (two bytes a key), ``max_listed`` the hashes listed beside it. Both are checked; beyond the
    first the plain join is used, beyond the second it is used for the rows that the filter does not decide.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"{how} is neither left_semi nor left_anti")
    left_on, right_on = list(left_on), list(right_on or left_on)
    semi = how == "left_semi"
    # A union finds the common type of each pair of key columns.
    types = [f.dataType for f in left.select(*left_on).union(right.select(*right_on)).schema]
    names = [f"_key{i}" for i in range(len(types))]

    def keys_of(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
        values, code, able = _keys(frame, columns, types, null_safe)
        return frame.where(able).select(*[v.alias(name) for v, name in zip(values, names, strict=True)], code.alias("h"))

    def plain(rows: DataFrame, keys: DataFrame) -> DataFrame:
        values, _, _ = _keys(rows, left_on, types, null_safe)
        pairs = [v.eqNullSafe(keys[name]) if null_safe else v == keys[name] for v, name in zip(values, names, strict=True)]
        return rows.join(keys, pairs, how)

    keys = _written(keys_of(right, right_on).distinct(), "join-keys")
    n = keys.count()
    if n == 0:
        return left.where(F.lit(False)) if semi else left
    shards = -(-n * BITS_PER_KEY // (8 * SHARD_BYTES))
    if shards * SHARD_BYTES > max_filter_bytes:
        return plain(left, keys)
    maybe = maybe_in(left, build_filter(keys, shards))
    _, code, able = _keys(left, left_on, types, null_safe)
    outside = keys_of(left, left_on).where(maybe(F.col("h"))).distinct()
    same = [outside[name].eqNullSafe(keys[name]) for name in names]
    outside = _written(outside.join(keys, same, "left_anti").select("h").distinct(), "join-outside")
    if outside.count() > max_listed:
        undecided = able & maybe(code)
        exact = plain(left.where(undecided), keys)
        return exact if semi else left.where(~undecided).unionByName(exact)
    wrong = np.sort(outside.toArrow()["h"].to_numpy())
    inside = able & maybe(code)
    if not len(wrong):
        return left.where(inside if semi else ~inside)
    listed = listed_in(left, wrong)
    # Hashes of keys of both kinds; there is hardly ever one.
    shared = np.sort(keys.select("h").where(listed(F.col("h"))).distinct().toArrow()["h"].to_numpy())
    decided = inside & ~listed(code)
    rows = left.where(decided if semi else ~decided)
    if not len(shared):
        return rows
    torn = able & listed_in(left, shared)(code)
    return left.where(~torn & (decided if semi else ~decided)).unionByName(plain(left.where(torn), keys))
