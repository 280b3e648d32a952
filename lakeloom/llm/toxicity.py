"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training runs in rounds: shards of a bounded sample each take one pass of FTRL from the common state,
and Spark averages their accumulators. L1 leaves most weights at zero; the others are a table of at
most ``2**bits`` entries, small enough for every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, materialize, sigmoid, text_slices, unambiguous_labels
from lakeloom.llm.wordhash import WordHasher, mixed


@dataclass(frozen=True)
class FtrlSettings:
    """``max_rows`` bounds the labelled rows that training reads; all of them if there are fewer."""

    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.02
    rounds: int = 8
    shards: int = 4
    max_rows: int = 40_000


#: Places of a state in one row, and rows of a shard that stand in order of their ids.
PIECE = 1 << 16
BLOCK_ROWS = 2048

#: Fixed odd multipliers, one per kind of feature.
UNIGRAM, BIGRAM, TRIGRAM, SKIP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93


def features(
    texts: list[bytes], bits: int, hasher: WordHasher, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the distinct features of each text, sorted.

    Words, pairs and triples of neighbours, and pairs with one word between them. ``wanted`` marks the
    features to return, so that a scan sorts only those that have a weight.
    """
    words, owner = hasher(texts)
    same1, same2 = owner[1:] == owner[:-1], owner[2:] == owner[:-2]
    parts = [
        (owner, words * np.uint64(UNIGRAM)),
        (owner[1:][same1], (words[:-1] * np.uint64(BIGRAM) + words[1:])[same1]),
        (owner[2:][same2], ((words[:-2] * np.uint64(TRIGRAM) + words[1:-1]) * np.uint64(TRIGRAM) + words[2:])[same2]),
        (owner[2:][same2], (words[:-2] * np.uint64(SKIP) + words[2:])[same2]),
    ]
    keys = []
    for own, value in parts:
        feature = mixed(value) >> np.uint64(64 - bits)
        if wanted is not None:
            hit = wanted[feature]
            own, feature = own[hit], feature[hit]
        keys.append((own.astype(np.uint64) << np.uint64(bits)) | feature)
    keys = np.unique(np.concatenate(keys))
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def weights_of(z: np.ndarray, n: np.ndarray, settings: FtrlSettings) -> np.ndarray:
    rate = (settings.beta + np.sqrt(n)) / settings.alpha + settings.l2
    return np.where(np.abs(z) <= settings.l1, 0.0, (np.sign(z) * settings.l1 - z) / rate)


def one_pass(rows: Iterable[tuple[np.ndarray, float]], z: np.ndarray, n: np.ndarray, settings: FtrlSettings) -> None:
    """One FTRL pass over (features, label) rows, in place. The last place of z and n is the bias."""
    for at, label in rows:
        w = weights_of(z[at], n[at], settings)
        w[-1] = -z[at[-1]] / ((settings.beta + np.sqrt(n[at[-1]])) / settings.alpha + settings.l2)
        slope = float(sigmoid(w.sum()) - label)
        square = slope * slope
        z[at] += slope - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / settings.alpha * w
        n[at] += square


def packed(owner: np.ndarray, feature: np.ndarray, n: int) -> list[bytes]:
    """The sorted features of each of ``n`` texts as compressed differences."""
    bounds = np.searchsorted(owner, np.arange(n + 1))
    lists = (feature[a:b] for a, b in zip(bounds, bounds[1:], strict=False))
    return [zlib.compress(np.diff(values, prepend=0).astype(np.uint32).tobytes(), 1) for values in lists]


def unpacked(value: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(value), np.uint32), dtype=np.int64)


def _shard_pass(state, number: int, settings: FtrlSettings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over rows (shard, label, features) that stand shard by shard.

    Each shard starts from the common state, which then goes on from batch to batch, so a task holds one state
    and the rows at hand. Rows of a batch are taken in an order of the round's own. A shard gives its state
    back at single precision, in pieces.
    """
    size = 1 << settings.bits

    def pieces(shard: int, z: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, size + 1, PIECE):
            columns = [pa.array([values[at : at + PIECE].astype(np.float32).tobytes()], pa.binary()) for values in (z, n)]
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([shard], pa.int32()), *columns], ["at", "shard", "z", "n"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, z, n = None, np.zeros(0), np.zeros(0)
        for batch in batches:
            shards = batch.column(0).to_numpy()
            for shard in dict.fromkeys(shards.tolist()):
                if shard != present:
                    if present is not None:
                        yield from pieces(present, z, n)
                    present, (z, n) = shard, (values.astype(np.float64) for values in state.value)
                places = np.random.default_rng(number).permutation(np.flatnonzero(shards == shard))
                labels, texts = batch.column(1), batch.column(2)
                rows = ((np.append(unpacked(texts[i].as_py()), size), float(labels[i].as_py())) for i in places.tolist())
                one_pass(rows, z, n, settings)
        if present is not None:
            yield from pieces(present, z, n)

    return fit


def _mean_piece(part: pa.Table) -> pa.Table:
    """The mean of the shards' states in one piece, added up in order of the shards."""
    part = part.sort_by([(name, "ascending") for name in ("shard", "z")])
    sums = {name: sum(np.frombuffer(value.as_buffer(), np.float32).astype(np.float64) for value in part[name]) for name in ("z", "n")}
    means = {name: pa.array([(total / part.num_rows).astype(np.float32).tobytes()], pa.binary()) for name, total in sums.items()}
    return pa.table({"at": part["at"][:1], **means})


def training_sample(labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, label) of ``max_rows`` labelled documents at most, chosen by a hash of the id."""
    order = F.xxhash64("doc_id")
    return labels.orderBy(order, "doc_id").limit(max_rows)


def train(
    docs: DataFrame, labels: DataFrame, settings: FtrlSettings = FtrlSettings(), id_column: str = "doc_id", text_column: str = "text"
) -> np.ndarray:
    """Weights of length ``2**bits + 1``, the bias last.

    ``labels`` (doc_id, toxic) are the rows to learn from. Without any usable one all weights are zero,
    and every score 0.5.
    """
    size = 1 << settings.bits
    picked = training_sample(unambiguous_labels(labels, "toxic"), settings.max_rows)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # At most max_rows pairs of an id and a label: a proven bound.
    rows = rows.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    bits = settings.bits

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for start, end, part in text_slices(batch.column(2)):
                values = packed(*features(list(binary_values(part)), bits, hasher), end - start)
                columns = [batch.column(0)[start:end], batch.column(1)[start:end], pa.array(values, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "features"])

    extracted = rows.mapInArrow(extract, "doc_id long, label int, features binary")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(settings.shards)).cast("int").alias("shard")
    # Written shard by shard, in an order that does not depend on how the texts arrived: blocks by hash of about as many
    # rows as a batch, so that neighbouring ids are spread over a round. A round then streams the rows and moves nothing
    # but states. A shard that fills several row groups is trained in parts.
    blocks = max(1, round(picked.count() / settings.shards / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(blocks)).alias("block")
    ordered = (
        extracted.select(shard, "label", "features", block, "doc_id")
        .repartitionById(settings.shards, F.col("shard"))
        .sortWithinPartitions("shard", "block", "doc_id", "label", "features")
    )
    sample = materialize(ordered.select("shard", "label", "features"), "ftrl-shards")
    z, n = np.zeros(size + 1, np.float32), np.zeros(size + 1, np.float32)
    for number in range(settings.rounds):
        state = docs.sparkSession.sparkContext.broadcast((z, n))
        # Shards' states are averaged piece by piece; one of 2**bits places comes to the driver, whatever the documents.
        states = sample.mapInArrow(_shard_pass(state, number, settings), "at long, shard int, z binary, n binary")
        mean = states.groupBy("at").applyInArrow(_mean_piece, "at long, z binary, n binary").toArrow()
        state.unpersist()
        if not mean.num_rows:
            break
        mean = mean.sort_by("at")
        z, n = (np.concatenate([np.frombuffer(value.as_buffer(), np.float32) for value in mean[name]]) for name in ("z", "n"))
    z, n = z.astype(np.float64), n.astype(np.float64)
    weights = weights_of(z, n, settings)
    weights[-1] = -z[-1] / ((settings.beta + np.sqrt(n[-1])) / settings.alpha + settings.l2)
    return weights


def score_udf(spark: SparkSession, weights: np.ndarray) -> Callable[[Column], Column]:
    """Column function from a text to its toxicity, 0 to 1.

    Whole texts are read, and features count once per text. A null or empty text gets the score of the
    bias alone.
    """
    bits = (len(weights) - 1).bit_length() - 1
    used = np.flatnonzero(weights[:-1])
    shared = spark.sparkContext.broadcast((used, weights[used], float(weights[-1])))

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, values, bias = shared.value
        dense = np.zeros(1 << bits)
        dense[at] = values
        weighty = dense != 0
        hasher = WordHasher()
        for part in parts:
            sums = np.zeros(len(part))
            for start, end, texts in text_slices(part):
                owner, feature = features(list(binary_values(texts)), bits, hasher, weighty)
                sums[start:end] = np.bincount(owner, dense[feature], end - start)
            yield pa.array(sigmoid(sums + bias))

    return F.arrow_udf(run, "double")


def score(
    docs: DataFrame, weights: np.ndarray, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, score, predicted) for every row; ``predicted`` is 1 from the threshold on."""
    scored = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        score_udf(docs.sparkSession, weights)(F.col(text_column)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
