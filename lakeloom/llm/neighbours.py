"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

The graph starts from the nearest within cells around pivots. Each round joins every node with the
neighbours of its neighbours, in both directions, and keeps the nearest; only pairs with a neighbour that is new
since the last round are compared. A search starts at a few entry nodes and at the query's own node where it
has one, and opens the nearest nodes found until none is left to open among the best.

Equal vectors are one node of the graph, so however many copies a vector has, each is found through it and
none crowds the others out. The graph works on vectors of half precision, each at a scale of its own and all less the
median of a sample, so neither a common offset nor a few huge vectors blur the others. :func:`nearest_exact` compares every query
with every row, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize


@dataclass(frozen=True)
class GraphSettings:
    """``links``: neighbours of a node; ``reverse``: nodes that name it and take part in a round, chosen by
    hash. The start deals every node to its ``cells`` nearest of the pivots, one per ``per_pivot`` nodes but ``pivots`` at most,
    and compares it within parts of about ``part`` nodes of a cell. Rounds go on until under ``settled`` of the links
    change; a graph of n nodes has ``rounds`` rounds at most and one more for each doubling beyond ``rounds_from`` nodes.
    ``pool``: best nodes a query keeps in its search, ``opened`` of them at most per step; the search ends when all of the
    pool are opened, or after ``steps`` steps; ``entries``: nodes every query starts from. ``sample``: vectors that the common
    median and scale come from."""

    links: int = 32
    reverse: int = 24
    pivots: int = 4096
    cells: int = 4
    per_pivot: int = 200
    part: int = 1024
    rounds: int = 4
    rounds_from: int = 65_536
    settled: float = 0.05
    pool: int = 256
    opened: int = 48
    steps: int = 64
    entries: int = 16
    sample: int = 4096


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part.

    Null ids and null, empty, all-zero vectors and those with null or non-finite components do not.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )


def distinct_vectors(rows: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, vector), one per distinct vector, and (node, vec_id) of its ``copies`` smallest ids.

    The node is the smallest id. The limit per vector is applied before the shuffle as well.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= copies)
    few = few.withColumn("node", F.min("vec_id").over(Window.partitionBy("vector")))
    few = materialize(few, "vector-copies")
    return few.where("place = 1").select("node", "vector"), few.select("node", "vec_id")


def _stack(column: pa.Array) -> np.ndarray:
    """The vectors of packed bytes, a row each, at single precision; the graph only compares, so that is enough for it."""
    values = column.to_pylist()
    if not values:
        return np.zeros((0, 0), np.float32)
    data = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
    scale = np.ascontiguousarray(data[:, :4]).view(np.float32)
    return np.ascontiguousarray(data[:, 4:]).view(np.float16).astype(np.float32) * scale


def _packed(nodes: DataFrame, sample: int) -> DataFrame:
    """Adds ``packed``: a scale of the vector's own, then its components at half precision.

    First the median of ``sample`` vectors, chosen by hash, is taken off and all are divided by the median size of
    what is left. Vectors more than 10**15 times that size are moved to it.
    """
    # At most ``sample`` vectors.
    some = nodes.select("vector").orderBy(F.xxhash64("node"), "node").limit(sample).toArrow()["vector"].combine_chunks()
    if not len(some):
        return nodes.withColumn("packed", F.lit(b""))
    table = some.flatten().to_numpy().reshape(len(some), -1)
    # Halves first, so that the largest doubles do not overflow.
    centre = np.median(table / 2, axis=0)
    scale = float(np.median(np.abs(table / 2 - centre).max(axis=1))) or 1.0

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = (part.flatten().to_numpy().reshape(len(part), -1) / 2 - centre) / scale
            rows = np.clip(np.nan_to_num(rows, posinf=1e15, neginf=-1e15), -1e15, 1e15)
            own = np.abs(rows).max(axis=1, keepdims=True)
            own[own == 0] = 1.0
            halves = (rows / own).astype(np.float16)
            data = np.concatenate([own.astype(np.float32).view(np.uint8), halves.view(np.uint8)], axis=1)
            yield pa.array([row.tobytes() for row in data], pa.binary())

    return nodes.withColumn("packed", F.arrow_udf(run, "binary")(F.col("vector")))


def _start(nodes: DataFrame, settings: GraphSettings) -> DataFrame:
    """(node, other, distance, fresh): the nearest of each node within its cells."""
    count = nodes.count()
    if not count:
        return nodes.selectExpr("node", "node AS other", "float(0) AS distance", "true AS fresh")
    wanted = max(1, min(settings.pivots, count // settings.per_pivot))
    # At most ``pivots`` vectors.
    chosen = nodes.select("packed").orderBy(F.xxhash64("node"), "node").limit(wanted).toArrow()["packed"].combine_chunks()
    centres = _stack(chosen)
    near = min(settings.cells, wanted)

    def nearest_cells(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            data = _stack(part)
            far = (centres * centres).sum(axis=1) - 2 * (data @ centres.T)
            yield pa.array(np.argpartition(far, near - 1, axis=1)[:, :near].tolist(), pa.list_(pa.int32()))

    dealt = nodes.select("node", "packed", F.explode(F.arrow_udf(nearest_cells, "array<int>")(F.col("packed"))).alias("cell"))
    dealt = materialize(dealt, "pivot-cells")
    # One row per pivot.
    sizes = {row["cell"]: row["count"] for row in dealt.groupBy("cell").count().collect()}
    parts = F.create_map(*(F.lit(x) for cell, n in sizes.items() for x in (cell, -(-n // settings.part))))
    share = F.pmod(F.xxhash64("node"), parts[F.col("cell")])

    def compare(group: pa.Table) -> pa.Table:
        node, data = group["node"].to_numpy(), _stack(group["packed"].combine_chunks())
        far = _distances(data)
        np.fill_diagonal(far, np.inf)
        keep = min(settings.links, len(node) - 1)
        best = np.argpartition(far, keep - 1, axis=1)[:, :keep] if keep else np.zeros((len(node), 0), np.int64)
        columns = [np.repeat(node, keep), node[best].ravel(), np.take_along_axis(far, best, axis=1).ravel()]
        return pa.table(dict(zip(("node", "other", "distance"), columns, strict=True)))

    pairs = dealt.groupBy("cell", share.alias("share")).applyInArrow(compare, "node long, other long, distance float")
    return _nearest(pairs.withColumn("fresh", F.lit(True)), settings.links)


def _distances(data: np.ndarray) -> np.ndarray:
    norm = (data * data).sum(axis=1)
    return np.sqrt(np.maximum(norm[:, None] + norm - 2 * (data @ data.T), 0))


def _nearest(pairs: DataFrame, links: int) -> DataFrame:
    """The ``links`` nearest others of each node; a pair that was there before is not fresh."""
    one = pairs.groupBy("node", "other").agg(F.min("distance").alias("distance"), F.bool_and("fresh").alias("fresh"))
    order = Window.partitionBy("node").orderBy("distance", "other")
    return one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= links).drop("place")


def _few(pairs: DataFrame, key: str, value: str, limit: int) -> DataFrame:
    """At most ``limit`` rows per key, by a hash of the pair."""
    order = Window.partitionBy(key).orderBy(F.xxhash64(key, value), value)
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit).drop("place")


def _round(graph: DataFrame, nodes: DataFrame, settings: GraphSettings) -> DataFrame:
    """(node, other, distance, fresh): pairs among the neighbours of a node that improve either side."""
    ahead = graph.select("node", "other", "fresh")
    behind = _few(graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "fresh"), "node", "other", settings.reverse)
    around = ahead.union(behind).groupBy("node", "other").agg(F.bool_or("fresh").alias("fresh"))
    reach = graph.groupBy("node").agg(
        F.when(F.count("*") >= settings.links, F.max("distance")).otherwise(F.lit(float("inf"))).cast("float").alias("reach")
    )
    known = nodes.select("node", "packed").join(reach, "node").withColumnRenamed("node", "other")
    rows = around.join(known, "other").groupBy("node").agg(F.collect_list(F.struct("other", "fresh", "reach", "packed")).alias("near"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets, items = lists.offsets.to_numpy(), lists.values
            other, fresh = items.field("other").to_numpy(), items.field("fresh").to_numpy(zero_copy_only=False)
            reach, data = items.field("reach").to_numpy(), _stack(items.field("packed"))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(offsets, offsets[1:], strict=False):
                x, ids, limit, new = data[a:b], other[a:b], reach[a:b], fresh[a:b]
                far = _distances(x)
                better = (far < limit[:, None]) & (new[:, None] | new)
                np.fill_diagonal(better, False)
                i, j = np.nonzero(better)
                out.append((ids[i], ids[j], far[i, j]))
            columns = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "other", "distance"])

    return rows.select("near").mapInArrow(compare, "node long, other long, distance float").withColumn("fresh", F.lit(True))


def neighbour_graph(nodes: DataFrame, settings: GraphSettings = GraphSettings()) -> DataFrame:
    """(node, other, distance, fresh): about the ``links`` nearest of each node of (node, vector, packed).

    Written after each round, so an executor lost costs one round.
    """
    graph = materialize(_start(nodes, settings), "neighbour-graph")
    doublings = max(0, math.ceil(math.log2(max(1, nodes.count()) / settings.rounds_from)))
    for _ in range(settings.rounds + doublings):
        found = _round(graph, nodes, settings)
        before = graph.withColumn("fresh", F.lit(False))
        graph = materialize(_nearest(before.unionByName(found), settings.links), "neighbour-graph")
        fresh, links = graph.agg(F.sum(F.col("fresh").cast("long")), F.count("*")).first()
        if not links or fresh < settings.settled * links:
            break
    return graph


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two double vectors, summed in the order of their components."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _apart(measured: Accumulator | None) -> Callable[[Iterator[tuple[pa.Array, pa.Array]]], Iterator[pa.Array]]:
    def apart(targets: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, two in targets:
            if measured is not None:
                measured.add(len(one))
            x, y = _stack(one), _stack(two)
            yield pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))

    return apart


def search(
    queries: DataFrame, nodes: DataFrame, graph: DataFrame, settings: GraphSettings = GraphSettings(), measured: Accumulator | None = None
) -> DataFrame:
    """(query, node, distance): up to ``pool`` nearest nodes found for each row of (query, target, packed, home).

    ``home`` is the node of the query's own vector, null if it is not in the graph. Each step opens the nearest
    unopened nodes of all queries at once: their neighbours in both directions are joined, measured and merged. The
    way goes by the packed vectors, the distances returned are those of the given ones. ``measured`` counts the distances
    on the way.
    """
    ahead = graph.select("node", "other")
    behind = _few(graph.select(F.col("other").alias("node"), F.col("node").alias("other")), "node", "other", settings.reverse)
    around = materialize(ahead.union(behind).distinct(), "search-graph")
    vectors = nodes.select("node", "packed")
    targets = queries.select("query", F.col("packed").alias("target"))
    apart = F.arrow_udf(_apart(measured), "float")

    # As many as ``entries`` rows, whatever the number of nodes.
    entries = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(settings.entries).collect()
    starts = F.array(*(F.lit(row.node) for row in entries)) if entries else F.array().cast("array<long>")
    begun = queries.select("query", F.explode(F.array_distinct(F.concat(F.array("home"), starts))).alias("node"))
    begun = begun.where("node is not null")

    def distances(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(vectors, "node").join(targets, "query")
        return joined.select("query", "node", apart("target", "packed").alias("distance"), F.lit(False).alias("done"))

    order = Window.partitionBy("query").orderBy("distance", "node")
    pool = materialize(distances(begun), "search-pool")
    for _ in range(settings.steps):
        opened = pool.where("not done").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= settings.opened)
        opened = materialize(opened.select("query", "node"), "search-opened")
        if opened.isEmpty():
            break
        reached = opened.join(around, "node").select("query", F.col("other").alias("node")).distinct()
        fresh = reached.join(pool.select("query", "node"), ["query", "node"], "left_anti")
        marked = pool.join(opened.withColumn("now", F.lit(True)), ["query", "node"], "left").select(
            "query", "node", "distance", (F.col("done") | F.coalesce("now", F.lit(False))).alias("done")
        )
        merged = marked.unionByName(distances(fresh)).withColumn("place", F.row_number().over(order))
        pool = materialize(merged.where(F.col("place") <= settings.pool).drop("place"), "search-pool")
    exact = pool.select("query", "node").join(nodes.select("node", "vector"), "node").join(queries.select("query", "target"), "query")
    return exact.select("query", "node", euclidean(F.col("target"), F.col("vector")).alias("distance"))


def nearest_exact(rows: DataFrame, queries: DataFrame, k: int, block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) by comparing each of (query, target) with every row of (vec_id, vector).

    Queries are taken in blocks by hash of about ``block``; the rows pass each block once, and every task keeps the
    ``k`` nearest of its rows, with ties to the smaller id, before any are merged. All lengths may be mixed: a vector is compared
    with those of its own length.
    """
    asked = materialize(queries.select("query", "target"), "exact-queries")
    blocks = -(-asked.count() // block)
    found = []
    for number in range(blocks):
        # About ``block`` vectors.
        part = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number).toArrow()
        by_size: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for query, target in zip(part["query"].to_pylist(), part["target"], strict=True):
            values = target.values.to_numpy(zero_copy_only=False)
            ids, vectors = by_size.setdefault(len(values), ([], []))
            ids.append(query)
            vectors.append(values)
        targets = {size: (np.array(ids), np.array(vectors)) for size, (ids, vectors) in by_size.items()}
        if targets:
            shared = rows.sparkSession.sparkContext.broadcast(targets)
            found.append(rows.select("vec_id", "vector").mapInArrow(_scan(shared, k), "query_id long, vec_id long, score double"))
    if not found:
        return rows.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "double(0) AS score").where("false")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    merged = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return merged.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(shared, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``k`` nearest rows of a task for each query of a block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            lists = batch.column(1)
            ids, offsets = batch.column(0).to_numpy(), lists.offsets.to_numpy()
            flat, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(offsets)
            for size, (queries, targets) in shared.value.items():
                own = np.flatnonzero(sizes == size)
                for at in range(0, len(own), 256):
                    some = own[at : at + 256]
                    table = flat[offsets[some][:, None] + np.arange(size)]
                    # Summed component by component, as the scores of the search are.
                    far = np.zeros((len(targets), len(some)))
                    with np.errstate(over="ignore"):
                        for i in range(size):
                            step = targets[:, i, None] - table[None, :, i]
                            far += step * step
                    far = np.sqrt(far)
                    far[queries[:, None] == ids[some]] = np.nan
                    score, name = best.get(size, (np.full((len(targets), 0), np.nan), np.zeros((len(targets), 0), np.int64)))
                    score = np.concatenate([score, far], axis=1)
                    name = np.concatenate([name, np.broadcast_to(ids[some], far.shape)], axis=1)
                    keep = np.lexsort((name, score), axis=1)[:, :k]
                    best[size] = (np.take_along_axis(score, keep, axis=1), np.take_along_axis(name, keep, axis=1))
        for size, (score, name) in best.items():
            queries = np.broadcast_to(shared.value[size][0][:, None], score.shape)
            there = ~np.isnan(score)
            columns = [pa.array(values[there]) for values in (queries, name, score)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return scan


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    settings: GraphSettings = GraphSettings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    exact: bool = False,
    measured: Accumulator | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for each row that ``is_query`` marks.

    Every row that takes part (see :func:`usable`) is indexed; the score is the Euclidean distance in double
    precision of the given vectors, ties go to the smaller id, and ``rank`` counts from 1. Fewer than ``k`` other rows
    are all returned. Rows that repeat an id and a vector are one row; an empty table gives no rows. Other columns are
    not read. Vectors are near only to those of their own length: the most frequent length is searched by the graph, the others
    are compared in full. ``exact`` compares all of them in full. ``measured`` counts the distances of the search.
    """
    marked = vectors.select(F.col(id_column), F.col(vector_column), is_query.alias("marked"))
    rows = materialize(usable(marked, id_column, vector_column).distinct(), "vectors")
    wanted = marked.where("marked").select(F.col(id_column).cast("long").alias("vec_id")).distinct()
    asked = rows.join(wanted, "vec_id", "left_semi")
    if exact:
        return nearest_exact(rows, asked.selectExpr("vec_id AS query", "vector AS target"), k)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(2).collect()
    main = F.size("vector") == (sizes[0]["size"] if sizes else 0)
    found = _by_graph(rows.where(main), asked.where(main), k, settings, measured)
    if len(sizes) < 2:
        return found
    rest = nearest_exact(rows.where(~main), asked.where(~main).selectExpr("vec_id AS query", "vector AS target"), k)
    return found.unionByName(rest)


def _by_graph(rows: DataFrame, asked: DataFrame, k: int, settings: GraphSettings, measured: Accumulator | None) -> DataFrame:
    """The search of :func:`nearest` for vectors of one length."""
    nodes, copies = distinct_vectors(rows, k + 1)
    nodes = materialize(_packed(nodes, settings.sample), "graph-nodes")
    graph = neighbour_graph(nodes, settings)
    homes = nodes.select(F.col("node").alias("home"), "vector", "packed")
    queries = asked.join(homes, "vector").select(F.col("vec_id").alias("query"), F.col("vector").alias("target"), "packed", "home")
    queries = materialize(queries, "search-queries")
    found = search(queries, nodes, graph, settings, measured)
    others = found.join(copies, "node").where(F.col("vec_id") != F.col("query"))
    order = Window.partitionBy("query").orderBy("distance", "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", F.col("distance").alias("score"))
