"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

The features approximate a Gaussian kernel over standardised statistics of a text. Each partition sums its
share of the normal equations, by fold; since sums of folds add up, the models that leave one fold out
come from the same pass, and their scores calibrate the final one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, materialize, unambiguous_labels

STATS = (
    "log_bytes log_words mean_word upper digits spaces stops commas exclamations bars symbols other_marks"
    " beyond_ascii new_words new_lines top_word sentence_words marked_words new_pairs lines_per_word"
).split()
SYMBOLS = b"#$%&*@^~+=<>\\{}[]_"
BLOCK = 16


@dataclass(frozen=True)
class QualitySettings:
    """``width`` is the spread of the kernel over statistics of unit variance; ``steps`` the resolution
    of a raw score in calibration."""

    features: int = 256
    width: float = 3.0
    ridge: float = 0.1
    folds: int = 4
    seed: int = 11
    steps: int = 10_000
    spread: int = 256


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosine features and a constant."""
        x = np.clip((stats - self.centre) / self.scale, -6, 6)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.knots, self.values), 0.0, 1.0)


def text_stats(text: bytes) -> list[float]:
    """The statistics of one text; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATS)
    size, n = len(text), len(words)
    held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lower, upper, beyond = held[97:123].sum(), held[65:91].sum(), held[128:].sum()
    letters = max(1, lower + upper + beyond)
    symbols = sum(int(held[c]) for c in SYMBOLS)
    marks = held[33:48].sum() + held[58:65].sum() + held[91:97].sum() + held[123:127].sum()
    counted = Counter(words)
    lines = [line for line in text.split(b"\n") if line]
    stops = int(held[46] + held[33] + held[63])
    ends = Counter(word[-1] for word in words)
    marked = sum(times for c, times in ends.items() if c < 128 and not chr(c).isalnum() and c not in b".,")
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        (size - held[32]) / n,
        upper / letters,
        held[48:58].sum() / size,
        (held[32] + held[9:14].sum()) / size,
        stops / n,
        held[44] / n,
        held[33] / n,
        held[124] / n,
        symbols / n,
        (marks - symbols - held[44] - stops - held[124]) / n,
        beyond / size,
        len(counted) / n,
        len(set(lines)) / len(lines),
        max(counted.values()) / n,
        float(np.log1p(n / (stops + 1))),
        marked / n,
        pairs / max(1, n - 1),
        len(lines) / n,
    ]


def stats_udf() -> Callable[[Column], Column]:
    """Column function from a whole text to its statistics; a null text is an empty one."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([text_stats(text) for text in binary_values(part)], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")


def document_stats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, stats) of every row, written: training and scoring then read no text again."""
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), stats_udf()(F.col(text_column)).alias("stats"))
    return materialize(picked, "document-stats")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATS))


def normal_equations(rows: DataFrame, model: QualityModel, folds: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Per fold the sums of z z' and z y over (fold, stats, label).

    A partition gives its sums in blocks of rows; blocks are added up in two rounds, so that no task
    receives those of all partitions.
    """
    size = len(model.phases) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch.column(1)))
            fold, y = batch.column(0).to_numpy(), batch.column(2).to_numpy().astype(float)
            for f in range(folds):
                mine = fold == f
                total[f, :, :size] += z[mine].T @ z[mine]
                total[f, :, size] += z[mine].T @ y[mine]
        for f in range(folds):
            starts = range(0, size, BLOCK)
            blocks = [total[f, at : at + BLOCK].tobytes() for at in starts]
            columns = [pa.array([f] * len(blocks), pa.int32()), pa.array(starts, pa.int32()), pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "start", "block"])

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(block, np.float64) for block in part["block"].to_pylist())
        return pa.table(
            {"fold": part["fold"][:1], "start": part["start"][:1], "block": pa.array([total.tobytes()], pa.binary())}
        )

    schema = "fold int, start int, block binary"
    parts = rows.select("fold", "stats", "label").mapInArrow(sums, schema)
    parts = parts.withColumn("share", F.spark_partition_id() % spread)
    some = parts.groupBy("fold", "start", "share").applyInArrow(add, schema)
    left, right = np.zeros((folds, size, size)), np.zeros((folds, size))
    for row in some.groupBy("fold", "start").applyInArrow(add, schema).collect():
        block = np.frombuffer(row.block, np.float64).reshape(-1, size + 1)
        left[row.fold, row.start : row.start + len(block)] = block[:, :size]
        right[row.fold, row.start : row.start + len(block)] = block[:, size]
    return left, right


def solve(left: np.ndarray, right: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights; the constant is not penalised beyond what keeps the system solvable."""
    penalty = np.full(len(right), ridge)
    penalty[-1] = 1e-9
    return np.linalg.solve(left + np.diag(penalty), right)


def isotonic(x: np.ndarray, weight: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the non-decreasing fit: pool neighbours whose means fall, then join the pools'
    centres by lines."""
    pools: list[list[float]] = []
    for at, w, p in zip(x * weight, weight, positive, strict=True):
        pools.append([float(at), float(w), float(p)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools)
    return table[:, 0] / table[:, 1], table[:, 2] / table[:, 1]


def train(stats: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> QualityModel:
    """Fit on the rows of (doc_id, stats) that ``labels`` (doc_id, quality) cover, all of them.

    Repeated rows of an id count each. With no usable label every score is 0.5; with labels of one kind
    every score is that label.
    """
    rng = np.random.default_rng(settings.seed)
    d = len(STATS)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(settings.folds)).cast("int")
    rows = stats.join(unambiguous_labels(labels, "quality"), "doc_id").select(fold.alias("fold"), "stats", "label")
    rows = materialize(rows, "quality-rows")
    measures = [f(F.element_at("stats", i + 1)) for i in range(d) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count("*"), *measures).first()
    numbers = np.array([value or 0.0 for value in first[1:]]).reshape(d, 2)
    model = QualityModel(
        numbers[:, 0],
        np.where(numbers[:, 1] > 1e-9, numbers[:, 1], 1.0),
        rng.normal(0.0, 1.0 / (settings.width * np.sqrt(d) / 2), (d, settings.features)),
        rng.uniform(0.0, 2 * np.pi, settings.features),
        np.zeros(settings.features + 1),
        np.array([0.0]),
        np.array([0.5]),
    )
    if not first[0]:
        return model
    left, right = normal_equations(rows, model, settings.folds, settings.spread)
    model.weights = solve(left.sum(axis=0), right.sum(axis=0), settings.ridge)
    others = np.array(
        [solve(left.sum(axis=0) - left[f], right.sum(axis=0) - right[f], settings.ridge) for f in range(settings.folds)]
    )
    steps = settings.steps

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.einsum("ij,ij->i", model.features(_matrix(batch.column(1))), others[batch.column(0).to_numpy()])
            step = np.round(np.clip(raw, -1, 2) * steps).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(2)], ["step", "label"])

    # Raw scores lie on 3 * steps + 1 marks, so that is the most this can collect.
    marks = (
        rows.mapInArrow(left_out, "step long, label int")
        .groupBy("step")
        .agg(F.count("*").alias("n"), F.sum("label").alias("good"))
        .orderBy("step")
        .toArrow()
    )
    model.knots, model.values = isotonic(*(marks[name].to_numpy() / by for name, by in (("step", steps), ("n", 1), ("good", 1))))
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted) for every row of (doc_id, stats); ``predicted`` is 1 from 0.5 on."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(model.calibrated(model.features(_matrix(part)) @ model.weights))

    scored = stats.select("doc_id", F.arrow_udf(run, "double")(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
