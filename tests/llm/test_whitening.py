import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import whitening
from lakeloom.llm.queries import op12_whitening


def plain(rows, k=16):
    """(vec_id, component) -> values, by a library's eigenvectors; the sign is that of the largest projection."""
    kept = [(i, v) for i, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    projected = (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [i for i, _ in kept], n, deviation, projected, values[:k] / values.sum()


def compare(found, rows):
    ids, n, deviation, projected, explained = plain(rows)
    by_id = {}
    for row in found:
        by_id.setdefault(row.vec_id, []).append(row)
    assert sorted(by_id) == sorted(set(ids))
    signs = {}
    for i, wanted, far in zip(ids, projected, deviation, strict=True):
        got = sorted(by_id[i], key=lambda row: row.component)
        assert [row.component for row in got] == list(range(1, len(wanted) + 1))
        assert {(row.n, row.deviation) for row in got} == {(n, far)}
        for k, row in enumerate(got):
            if abs(wanted[k]) > 1e-6:
                sign = signs.setdefault(k, np.sign(row.whitened * wanted[k]))
                assert row.whitened == pytest.approx(sign * wanted[k], rel=1e-6, abs=1e-8)
            assert row.explained == pytest.approx(explained[k], rel=1e-9)
            assert row.identity_error < 1e-9


@pytest.mark.parametrize(("d", "rank"), [(1, 1), (2, 2), (7, 3), (20, 20)])
def test_factor_and_rotations_against_a_library(d, rank):
    half = np.random.default_rng(d).normal(size=(d, rank))
    matrix = half @ half.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, matrix, atol=1e-10)
    # Triangular but for the order of rows: each column has one more zero.
    assert sorted((factor == 0).sum(axis=0).tolist()) == list(range(rank))
    values, vectors = whitening.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank]) and (np.diff(values) <= 0).all()
    assert np.allclose(vectors.T @ vectors, np.eye(rank)) and np.allclose((vectors * values) @ vectors.T, matrix)


def test_query_against_a_library(spark, testdata):
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{testdata}/embeddings.parquet").collect()]
    compare(op12_whitening(spark, testdata).collect(), rows)


def test_copies_weigh_nothing_and_odd_vectors_are_left_out(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(400)]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [float("nan")] * 5), (904, [float("inf")] * 5), (905, [1e300] * 5)]
    docs = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("x", F.lit(1))
    compare(whitening.whiten(docs).collect(), rows)


def test_repeated_and_null_ids_each_get_their_rows(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [3.0, 1.0]), (2, [1.0, 4.0]), (3, [2.0, 2.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((row.vec_id or 0, row.component) for row in found) == sorted((i or 0, k) for i, _ in rows for k in (1, 2))
    assert {row.n for row in found} == {4}


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], schema)
    found = whitening.whiten(line).collect()
    assert {row.component for row in found} == {1} and all(row.explained == pytest.approx(1.0) for row in found)


def test_other_lengths_are_fitted_among_themselves(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=4) * [8, 4, 2, 1]]) for i in range(40)]
    other = [(100 + i, [float(i), float(i * i)]) for i in range(5)]
    found = whitening.whiten(spark.createDataFrame(rows + other, "vec_id long, embedding array<double>")).collect()
    compare([row for row in found if row.vec_id < 100], rows)
    assert {(row.n, row.component) for row in found if row.vec_id >= 100} == {(5, 1), (5, 2)}


def test_large_entries_are_exact_or_null():
    x = np.array([[0, 0], [1 << 40, 5], [1 << 61, 0]])
    totals = [int(total) for total in x.sum(axis=0)]
    wanted = [sum((3 * int(a) - t) ** 2 for a, t in zip(row, totals, strict=True)) for row in x]
    assert whitening.deviations(x[:2], 3, [1 << 29, 5]) == [
        value if value < 1 << 63 else None for value in (sum((3 * int(a) - t) ** 2 for a, t in zip(row, [1 << 29, 5], strict=True)) for row in x[:2])
    ]
    assert whitening.deviations(x, 3, totals) == [value if value < 1 << 63 else None for value in wanted]
