"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Entries become whole numbers, so that equal vectors are found exactly and sums over them have no order. Spark
sums counts, totals and scatter by partition; the driver sees one matrix of the vectors' dimensions, whatever
the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize

#: Largest size of an entry times the scale: whole numbers beyond would not fit 64 bits with the shift.
LARGEST = float(1 << 61)
ROWS_AT_ONCE = 2048


@dataclass(frozen=True)
class Whitening:
    """What was fitted for vectors of one length: ``n`` distinct vectors with ``totals`` per dimension, the components
    as columns with their eigenvalues, the trace, and the error of the whitened covariance."""

    n: int
    totals: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0


def whole_numbers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """``floor(scale * entry) + shift`` of each entry; null for a vector that is null, holds a null or non-finite
    entry or one too large for a 64-bit number."""
    entry = vector.cast("array<double>")
    fine = F.forall(entry, lambda c: c.isNotNull() & (F.abs(c * scale) < LARGEST))
    return F.when(fine, F.transform(entry, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")))


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = 1e-13) -> np.ndarray:
    """Factor ``L`` with ``L @ L.T`` equal to the matrix: triangular but for the order of its rows, with a
    column per rank. Each step takes the largest diagonal entry left; it ends when that is ``tolerance`` of the first."""
    rest = matrix.astype(np.float64).copy()
    least = tolerance * np.diagonal(rest).max(initial=0.0)
    columns = []
    while len(columns) < len(rest):
        pivot = int(np.argmax(np.diagonal(rest)))
        largest = rest[pivot, pivot]
        if not largest > least:
            break
        column = rest[:, pivot] / np.sqrt(largest)
        columns.append(column)
        rest -= np.outer(column, column)
        # Rows taken are zero from here on, as in a triangle.
        rest[pivot, :] = rest[:, pivot] = 0.0
    return np.array(columns).T.reshape(len(matrix), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components) of ``factor @ factor.T``, falling: plane rotations of the factor's columns until all
    are orthogonal. Their squared norms are the eigenvalues, the normalised columns the components.

    A sweep is a round-robin of pairs, so that disjoint pairs turn at once.
    """
    turned = factor.copy()
    tolerance = np.finfo(np.float64).eps * np.sqrt(len(factor))
    k = turned.shape[1]
    seats = list(range(k)) + ([-1] if k % 2 else [])
    for _ in range(sweeps if k > 1 else 0):
        moved = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            left, right = (np.array(side) for side in zip(*pairs, strict=True))
            x, y = turned[:, left], turned[:, right]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if not turn.any():
                continue
            moved = True
            left, right, x, y, xx, yy, xy = left[turn], right[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            ratio = (yy - xx) / (2 * xy)
            tangent = np.where(ratio >= 0, 1.0, -1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            turned[:, left], turned[:, right] = cosine * x - sine * y, sine * x + cosine * y
        if not moved:
            break
    squares = (turned * turned).sum(axis=0)
    order = np.argsort(-squares, kind="stable")
    squares, turned = squares[order], turned[:, order]
    return squares, turned / np.sqrt(np.where(squares > 0, squares, 1.0))


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of whole numbers) of the vectors of each length in a batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.values.to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), ROWS_AT_ONCE):
            some = rows[at : at + ROWS_AT_ONCE]
            yield some, flat[starts[some][:, None] + np.arange(size)]


def _centred(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """``x`` less the mean, to double precision: whole parts first."""
    base = np.array([total // n for total in totals], np.int64)
    part = np.array([(total % n) / n for total in totals])
    return (x - base) - part


def _sums(fitted: DataFrame, centres: dict[int, tuple[int, list[int]]], turn: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """For each length of vector the sum over the fit list of ``outer(v, v)``, ``v`` being the centred vector, or
    its whitened components with a last entry 1 if ``turn`` has the matrices for that.

    Every task adds up its rows; then Spark adds up the tasks' matrices row by row.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch, 0):
                size = x.shape[1]
                values = _centred(x, *centres[size])
                if turn is not None:
                    values = np.column_stack([values @ turn[size], np.ones(len(values))])
                held[size] = held.get(size, 0.0) + values.T @ values
        for size, matrix in held.items():
            columns = [pa.array([size] * len(matrix), pa.int32()), pa.array(range(len(matrix)), pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(matrix), pa.list_(pa.float64()))], ["size", "row", "sums"])

    # Each task sends one matrix; Spark adds them up entry by entry, so no task holds all of them.
    parts = fitted.select("x").mapInArrow(add, "size int, row int, sums array<double>")
    added = parts.select("size", "row", F.posexplode("sums").alias("place", "value")).groupBy("size", "row", "place").agg(F.sum("value").alias("value"))
    table = added.toArrow()
    of, row, place, value = (table[name].to_numpy() for name in ("size", "row", "place", "value"))
    result: dict[int, np.ndarray] = {}
    for size in np.unique(of).tolist():
        width = size if turn is None else turn[size].shape[1] + 1
        own = of == size
        result[size] = np.zeros((width, width))
        result[size][row[own], place[own]] = value[own]
    return result


def _totals(fitted: DataFrame) -> DataFrame:
    """(size, place, n, total): number and sum of the entries of the fit list by length of vector and place.

    Tasks add up whole numbers and Spark adds them up as decimals, so the sums are exact in any order.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for _, x in _matrices(batch, 0):
                # Few enough rows for 64 bits, unless entries are huge.
                kind = np.int64 if np.abs(x.astype(np.float64)).max() < 2.0**50 else object
                sums = x.astype(kind).sum(axis=0).tolist()
                n, before = held.get(x.shape[1], (0, [0] * x.shape[1]))
                held[x.shape[1]] = n + len(x), [a + b for a, b in zip(before, sums, strict=True)]
        for size, (n, sums) in held.items():
            columns = [pa.array([value] * size, kind) for value, kind in ((size, pa.int32()), (n, pa.int64()))]
            totals = pa.array(list(map(Decimal, sums)), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([columns[0], pa.array(range(size), pa.int32()), columns[1], totals], ["size", "place", "n", "total"])

    parts = fitted.select("x").mapInArrow(add, "size int, place int, n long, total decimal(38,0)")
    return parts.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def fit(vectors: DataFrame, components: int = 16) -> dict[int, Whitening]:
    """Whitening of each length of vector in the column ``x`` (array<long>, none null), over its distinct vectors.

    At most ``components`` components are
    kept, fewer where the vectors span fewer dimensions.
    """
    listed = materialize(vectors.select("x").where(F.size("x") > 0).distinct(), "whitening-fit")
    centres: dict[int, tuple[int, list[int]]] = {}
    for row in _totals(listed).orderBy("size", "place").toArrow().to_pylist():
        centres.setdefault(row["size"], (row["n"], []))[1].append(int(row["total"]))
    models = {}
    for size, scatter in _sums(listed, centres).items():
        n, sums = centres[size]
        eigenvalues, vectors_of = one_sided_jacobi(pivoted_cholesky(scatter / n))
        keep = min(components, int((eigenvalues > 0).sum()))
        models[size] = Whitening(n, sums, vectors_of[:, :keep], eigenvalues[:keep], float(np.trace(scatter) / n))
    turn = {size: model.components / np.sqrt(model.eigenvalues) for size, model in models.items()}
    for size, sums in _sums(listed, centres, turn).items():
        model, k = models[size], turn[size].shape[1]
        means = sums[:k, k] / model.n
        spread = sums[:k, :k] / model.n - np.outer(means, means)
        error = float(np.abs(spread - np.eye(k)).max(initial=0.0))
        models[size] = Whitening(model.n, model.totals, model.components, model.eigenvalues, model.trace, error)
    return models


def deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Exact ``sum((n * x - totals) ** 2)`` of each row; null where that is beyond 64 bits."""
    base = np.array([total // n for total in totals], np.int64)
    part = [total % n for total in totals]
    rough = (((x - base) - np.array(part) / n) * n) ** 2
    small = rough.sum(axis=1) < 2.0**61
    out: list[int | None] = [None] * len(x)
    exact = (x[small] - base) * n - np.array(part, np.int64) if small.any() else np.zeros((0, x.shape[1]), np.int64)
    for i, value in zip(np.flatnonzero(small), (exact * exact).sum(axis=1).tolist(), strict=True):
        out[i] = value
    for i in np.flatnonzero(~small):
        value = sum((n * (a - b) - c) ** 2 for a, b, c in zip(x[i].tolist(), base.tolist(), part, strict=True))
        out[i] = value if value < 1 << 63 else None
    return out


def whiten(
    vectors: DataFrame, components: int = 16, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector and component.

    Entries become ``x = floor(64 * c) + 1000000``. Null vectors and those with a null, non-finite or over-large entry
    (64 * c of 2**61 or more) are left out. The fit list is each distinct ``x`` once, so copies weigh nothing and repeated
    rows each get their rows. Vectors of another length are fitted among themselves. ``deviation`` is null where it is
    beyond 64 bits. Where the vectors span fewer dimensions than ``components``, there are fewer rows; a single
    distinct vector has none. An empty table gives none. Ids may be null or repeated; other columns are not read.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), whole_numbers(F.col(vector_column)).alias("x"))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") > 0))
    models = fit(rows, components)
    plain = {
        size: (m.n, m.totals, m.components / np.sqrt(m.eigenvalues), m.eigenvalues / m.trace if m.trace > 0 else m.eigenvalues, m.identity_error)
        for size, m in models.items()
    }
    shared = vectors.sparkSession.sparkContext.broadcast(plain)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch, 1):
                n, totals, turn, explained, error = shared.value[x.shape[1]]
                k = turn.shape[1]
                if not k:
                    continue
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                distance = pa.array(deviations(x, n, totals), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                    pa.array(np.full(len(at) * k, n), pa.int64()),
                    distance,
                    pa.array((_centred(x, n, totals) @ turn).ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(at) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
