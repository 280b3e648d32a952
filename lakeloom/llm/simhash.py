"""SimHash fingerprints and their links within a Hamming distance.

Fingerprints are sorted by Gray rank, so that neighbours in the order share most of their bits. Over
each sorted chunk stands a tree: a node keeps the mask of the bits that all below it share, and
their pattern. Two nodes whose shared bits already differ in too many places are dropped with all
below them; two nodes that cannot differ in more are linked as a whole.

Texts that differ in few bits agree on some of a few bit segments, so chunks hold the fingerprints
of one value of one choice of segments. The more fingerprints there are, the more bits a choice has, so that chunks of
one value stay few. A value with very many fingerprints becomes many chunks, compared pair by pair in separate rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, materialize
from lakeloom.llm.components import connected_components

SEED = 42
BITS = 64
FANOUT = 16
CHUNK = 4096
HASHES_AT_ONCE = 1 << 18
PAIRS_AT_ONCE = 1 << 12

#: Byte value to its eight bits, one in each byte of a 64-bit word.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text as an unsigned 64-bit number.

    Only A-Z are lower-cased; words end at ASCII white space; a text of fewer words than a shingle is
    one shingle, one without words has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        # Byte counters hold 255 at most, so that many hashes are added up before widening.
        spread = SPREAD[hashes.view(np.uint8)].reshape(-1, 8)
        groups = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)
        counts += groups.view(np.uint8).reshape(len(groups), BITS).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint_udf(shingle: int) -> Callable[[Column], Column]:
    """Column function: the fingerprint of a text as a signed long. A null text has no words."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            values = [fingerprint(text, shingle) for text in binary_values(part)]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return F.arrow_udf(run, "long")


def gray_rank(value: Column) -> Column:
    """Position of a 64-bit word in the reflected Gray order, as a signed long."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def segments(n: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``n`` segments that cover all bits."""
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def key_plan(distance: int, n: int) -> list[tuple[tuple[int, int], ...]]:
    """Choices of segments for ``n`` fingerprints: words within the distance agree on all segments of one choice at least.

    Of ``distance + k`` segments words within the distance agree on ``k`` at least, so all choices of ``k`` do for any ``k``. More
    segments make more keys of more bits: the plan taken makes the fewest entries, counting a comparison as a fiftieth.
    """

    def cost(k: int) -> float:
        return math.comb(distance + k, k) * (1 + n / 2 ** (BITS * k / (distance + k)) / 50)

    fitting = [k for k in range(1, 5) if BITS * k / (distance + k) <= 40] or [1]
    k = min(fitting, key=cost)
    return list(combinations(segments(distance + k), k))


def plan_keys(plan: list[tuple[tuple[int, int], ...]], word: Column) -> Column:
    """The keys of a word: for each choice its number and the word's bits in its segments."""
    keys = []
    for number, chosen in enumerate(plan):
        bits = F.lit(0).cast("long")
        for low, width in chosen:
            bits = F.shiftleft(bits, width).bitwiseOR(F.shiftrightunsigned(word, low).bitwiseAND((1 << width) - 1))
        keys.append(F.lit(number << 42).cast("long").bitwiseOR(bits))
    return F.array(*keys)


class GrayTree:
    """Masks and patterns over a run of fingerprints in Gray order; level 0 holds the words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.masks = [np.full(len(words), ~np.uint64(0))]
        self.patterns = [words]
        shared, union = words, words
        while len(shared) > 1:
            at = np.arange(0, len(shared), FANOUT)
            shared = np.bitwise_and.reduceat(shared, at)
            union = np.bitwise_or.reduceat(union, at)
            self.masks.append(~(shared ^ union))
            self.patterns.append(shared & self.masks[-1])

    def width(self, level: int) -> int:
        return len(self.patterns[level])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked items the smallest label of their group, in place."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while not np.array_equal(labels[labels], labels):
            labels[:] = labels[labels]


def linked(left: np.ndarray, right: np.ndarray | None, distance: int) -> np.ndarray:
    """Labels of ``left`` followed by ``right`` (or of ``left`` alone): equal where a chain of links
    within the distance, between the two sides or inside the one, joins them."""
    x = GrayTree(left)
    y = x if right is None else GrayTree(right)
    base = 0 if right is None else len(left)
    labels = np.arange(base + len(y.words))
    top = max(len(x.patterns), len(y.patterns)) - 1
    pending = [(top, np.array([0]), np.array([0]))]
    while pending:
        level, i, j = pending.pop()
        lx, ly = min(level, len(x.patterns) - 1), min(level, len(y.patterns) - 1)
        mask = x.masks[lx][i] & y.masks[ly][j]
        least = np.bitwise_count((x.patterns[lx][i] ^ y.patterns[ly][j]) & mask)
        near = least <= distance
        i, j, mask, least = i[near], j[near], mask[near], least[near]
        if not len(i):
            continue
        if level == 0:
            _merge(labels, i, base + j)
            continue
        whole = least + np.bitwise_count(~mask) <= distance
        if whole.any():
            heads, members = _members(x, lx, i[whole], 0)
            heads_y, members_y = _members(y, ly, j[whole], base)
            first_x, first_y = i[whole] * FANOUT**lx, base + j[whole] * FANOUT**ly
            _merge(
                labels,
                np.concatenate([heads, heads_y, first_x]),
                np.concatenate([members, members_y, first_y]),
            )
        i, j = i[~whole], j[~whole]
        for at in range(0, len(i), PAIRS_AT_ONCE):
            pending.append((level - 1, *_children(x, y, level, i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE], labels, base)))
    return labels


def _members(tree: GrayTree, level: int, nodes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of its node, word) for each word below the nodes."""
    span = FANOUT**level
    at = np.unique(nodes)[:, None] * span + np.arange(span)
    heads = np.broadcast_to(at[:, :1], at.shape)
    inside = at < len(tree.words)
    return base + heads[inside], base + at[inside]


def _children(x: GrayTree, y: GrayTree, level: int, i: np.ndarray, j: np.ndarray, labels: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes one level below pairs of nodes; a tree that is lower stays at its root."""
    down_x, down_y = level < len(x.patterns), level < len(y.patterns)
    step = np.arange(FANOUT)
    a = i[:, None] * FANOUT + step if down_x else i[:, None]
    b = j[:, None] * FANOUT + step if down_y else j[:, None]
    a, b = np.broadcast_arrays(a[:, :, None], b[:, None, :])
    a, b = a.ravel(), b.ravel()
    keep = np.ones(len(a), bool)
    if down_x:
        keep &= a < x.width(level - 1)
    if down_y:
        keep &= b < y.width(level - 1)
    if x is y:
        keep &= (a < b) if level == 1 else (a <= b)
    a, b = a[keep], b[keep]
    if level == 1:
        apart = labels[a] != labels[base + b]
        a, b = a[apart], b[apart]
    return a, b


def _edges(words: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    """A spanning star per group: (word, word of its label)."""
    other = np.flatnonzero(labels != np.arange(len(labels)))
    pair = [words[other].view(np.int64), words[labels[other]].view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in pair], ["a", "b"])


def links(words: DataFrame, distance: int = 4, plan: list[tuple[tuple[int, int], ...]] | None = None) -> DataFrame:
    """(a, b): edges among distinct fingerprints (column ``fp``) that connect exactly the groups which
    pairs at ``distance`` bits or fewer connect. Not every such pair is an edge. ``plan`` is :func:`key_plan`'s for their number
    unless given, and changes no group."""
    plan = plan or key_plan(distance, words.count())
    entries = words.select(F.explode(plan_keys(plan, F.col("fp"))).alias("key"), "fp").withColumn("rank", gray_rank(F.col("fp")))
    ordered = entries.repartitionByRange("key", "rank").sortWithinPartitions("key", "rank")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def rows(bounds: np.ndarray) -> pa.RecordBatch:
            runs = [fp[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            shared = [np.bitwise_and.reduce(run) for run in runs]
            masks = [~(low ^ np.bitwise_or.reduce(run)) for low, run in zip(shared, runs, strict=True)]
            signed = [np.array(column, np.uint64).view(np.int64) for column in (masks, shared)]
            arrays = [key[bounds[:-1]], [len(run) for run in runs], *signed, [run.tobytes() for run in runs]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(arrays, types, strict=True)],
                ["key", "n", "mask", "pattern", "words"],
            )

        def bounds_of() -> np.ndarray:
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            return np.flatnonzero((np.arange(len(key)) - first) % CHUNK == 0)

        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if len(key) < 4 * CHUNK:
                continue
            starts = bounds_of()
            if len(starts) > 1:
                yield rows(starts)
                key, fp = key[starts[-1] :], fp[starts[-1] :]
        if len(key):
            yield rows(np.append(bounds_of(), len(key)))

    chunks = ordered.select("key", "fp").mapInArrow(cut, "key long, n int, mask long, pattern long, words binary")
    chunks = materialize(chunks.withColumn("chunk", F.monotonically_increasing_id()), "gray-chunks")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                run = np.frombuffer(value, np.uint64)
                yield _edges(run, linked(run, None, distance))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                left, right = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                yield _edges(np.concatenate([left, right]), linked(left, right, distance))

    own = chunks.where("n > 1").select("words").mapInArrow(inside, "a long, b long")
    crowded = chunks.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    roots = chunks.select("key", "chunk", "mask", "pattern").join(crowded, "key")
    x, y = roots.alias("x"), roots.alias("y")
    apart = F.bit_count(
        F.col("x.pattern").bitwiseXOR(F.col("y.pattern")).bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask"))
    )
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.chunk") < F.col("y.chunk")) & (apart <= distance))
    pairs = pairs.select(F.col("x.chunk").alias("one"), F.col("y.chunk").alias("two"))
    first = chunks.select(F.col("chunk").alias("one"), F.col("words").alias("left"))
    second = chunks.select(F.col("chunk").alias("two"), F.col("words").alias("right"))
    across = pairs.join(first, "one").join(second, "two").select("left", "right").mapInArrow(between, "a long, b long")
    return own.unionByName(across).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints at ``distance`` bits or fewer are linked; ``component_id`` is the smallest id that
    links reach from the row, its own included. Null texts, empty texts and texts of white space have
    fingerprint zero and are linked like any other. Rows that repeat an id each keep their own
    fingerprint. A null id is reported as null and never names a component unless no other id is in
    it. Other columns, whatever their names, are not read. An empty table gives an empty result.
    """
    prints = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), fingerprint_udf(shingle)(F.col(text_column)).alias("fp")
    )
    prints = materialize(prints, "fingerprints")
    words = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    labels = connected_components(links(words.select("fp"), distance))
    named = words.join(labels, words.fp == labels.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    members = materialize(named.select("fp", "component").join(smallest, "component").select("fp", "component_id"), "members")
    return prints.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
