"""Benchmark passages in documents, found by one Aho-Corasick automaton in one scan of each text.

The automaton reads words, not characters: its nodes are the beginnings of the windows, word by word, held in sorted arrays. A
slice of texts is scanned in many lanes at once, each a stretch of words that the benchmark knows. A benchmark whose
automaton would be too large is taken in parts, one scan of the texts each, and their finds are merged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, materialize, text_slices
from lakeloom.operators.reduced_joins import anti_join

#: ASCII letters and digits and all bytes of other characters make words; A-Z become a-z.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Words a lane reads, besides those it reads to come into the right state.
LANE = 256
RESULT = (
    "struct<n_words:long,n_hit:long,n_items:long,items_sha256:string,contaminated:boolean,"
    "spans:array<struct<start:long,end:long>>>"
)
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
FIELDS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
        ("spans", pa.list_(SPAN)),
    ]
)
#: Hit stretches in words and in characters, and the items with a window in the text.
FOUND = "array<struct<first:long,last:long,start:long,end:long>>"
STRETCH = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """An Aho-Corasick automaton over words.

    Node 0 is the empty beginning; the others are numbered by depth, then by parent and word, so that the edges, sorted by
    ``parent * symbols + word``, lead to the nodes 1, 2, 3 … in order. Word 0 is any word that no window holds.
    """

    def __init__(self, words: list[bytes], edges: np.ndarray, fail: np.ndarray, depth: np.ndarray, out: np.ndarray, first: np.ndarray, items: np.ndarray, names: list[str]):
        self.words, self.edges, self.fail, self.depth = words, edges, fail, depth
        #: The longest window that a node ends, itself or a shorter one; 0 for none.
        self.out = out
        #: Items of the window that ends at a node: ``items[first[node]:first[node + 1]]``, numbers of sorted ``names``.
        self.first, self.items, self.names = first, items, names
        self.number = {word: i for i, word in enumerate(words, 1)}
        self.symbols = len(words) + 1
        ends = np.flatnonzero(np.diff(first))
        self.shortest = int(depth[ends].min()) if len(ends) else 0
        self.longest = int(depth.max())

    def arrays(self) -> tuple:
        return self.words, self.edges, self.fail, self.depth, self.out, self.first, self.items, self.names

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states after reading one word each."""
        result = np.zeros(len(state), np.int64)
        left = np.flatnonzero(symbol)
        state = state[left]
        while len(left):
            wanted = state * self.symbols + symbol[left]
            at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            there = self.edges[at] == wanted
            result[left[there]] = at[there] + 1
            again = ~there & (state > 0)
            left, state = left[again], self.fail[state[again]].astype(np.int64)
        return result

    def scan(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of its last word, node) of all windows that stand in a sequence of words."""
        known = np.flatnonzero(np.diff(np.concatenate([[False], symbols > 0, [False]]).astype(np.int8)))
        begins, ends = known[::2], known[1::2]
        long_enough = ends - begins >= max(1, self.shortest)
        begins, ends = begins[long_enough], ends[long_enough]
        # Long stretches are cut into lanes; each begins early enough to be in the state of the whole stretch.
        pieces = -(-(ends - begins) // LANE)
        low = np.repeat(begins, pieces)
        own = low + LANE * (np.arange(len(low)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        high = np.minimum(own + LANE, np.repeat(ends, pieces))
        low = np.maximum(low, own - self.longest + 1)
        order = np.argsort(low - high, kind="stable")
        low, own, high = low[order], own[order], high[order]
        state, sizes = np.zeros(len(low), np.int64), high - low
        places, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -step))
            at = low[:active] + step
            state[:active] = self.follow(state[:active], symbols[at])
            hit = np.flatnonzero((self.out[state[:active]] > 0) & (at >= own[:active]))
            places.append(at[hit])
            nodes.append(state[hit])
        place, node = np.concatenate(places), self.out[np.concatenate(nodes)].astype(np.int64)
        all_places, all_nodes = [], []
        while len(place):
            all_places.append(place)
            all_nodes.append(node)
            node = self.out[self.fail[node]].astype(np.int64)
            place, node = place[node > 0], node[node > 0]
        if not all_places:
            return place, node
        return np.concatenate(all_places), np.concatenate(all_nodes)

    def find(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of words, first and last word of hit stretches as rows, items) of each text."""
        split = [words_of(text) for text in texts]
        first = np.cumsum([0, *(len(words) + 1 for words in split)])
        symbols = np.zeros(first[-1], np.int64)
        get = self.number.get
        for words, at in zip(split, first, strict=False):
            symbols[at : at + len(words)] = list(map(get, words, repeat(0)))
        place, node = self.scan(symbols)
        marks = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(marks, place - self.depth[node] + 1, 1)
        np.add.at(marks, place + 1, -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(marks[:-1]) > 0, [0]]).astype(np.int8)))
        stretches = np.stack([edges[::2], edges[1::2] - 1], axis=1)
        owner = np.searchsorted(first, place, side="right") - 1
        holder = np.searchsorted(first, stretches[:, 0], side="right") - 1
        pairs = np.unique(np.stack([owner, node], axis=1), axis=0) if len(owner) else np.zeros((0, 2), np.int64)
        bounds, limits = (np.searchsorted(x, np.arange(len(split) + 1)) for x in (pairs[:, 0], holder))
        for i, words in enumerate(split):
            own = [self.items[self.first[v] : self.first[v + 1]] for v in pairs[bounds[i] : bounds[i + 1], 1]]
            items = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
            yield len(words), stretches[limits[i] : limits[i + 1]] - first[i], items


def build(windows: list[tuple[str, list[bytes]]]) -> Automaton:
    """The automaton of (item, words of a window) pairs, level by level."""
    names = sorted({item for item, _ in windows})
    words = sorted({word for _, window in windows for word in window})
    number = {word: i for i, word in enumerate(words, 1)}
    rank = {name: i for i, name in enumerate(names)}
    symbols = len(words) + 1
    sizes = np.array([len(window) for _, window in windows], np.int64)
    longest = int(sizes.max(initial=0))
    table = np.zeros((len(windows), longest), np.int32)
    for i, (_, window) in enumerate(windows):
        table[i, : len(window)] = [number[word] for word in window]
    state = np.zeros(len(windows), np.int64)
    levels, starts = [], [0, 1]
    for depth in range(longest):
        active = sizes > depth
        keys, place = np.unique(state[active] * symbols + table[active, depth], return_inverse=True)
        state[active] = starts[-1] + place
        levels.append(keys)
        starts.append(starts[-1] + len(keys))
    n = starts[-1]
    edges = np.concatenate(levels) if levels else np.full(1, -1, np.int64)
    depth = np.repeat(np.arange(longest + 1), np.diff(starts)).astype(np.int32)
    ends = np.unique(np.stack([state, [rank[item] for item, _ in windows]], axis=1), axis=0) if windows else np.zeros((0, 2), np.int64)
    first = np.searchsorted(ends[:, 0], np.arange(n + 1)).astype(np.int32)
    out = np.where(np.diff(first) > 0, np.arange(n), 0).astype(np.int32)
    automaton = Automaton(words, edges, np.zeros(n, np.int32), depth, out, first, ends[:, 1].astype(np.int32), names)
    for level in range(2, longest + 1):
        keys = levels[level - 1]
        own = np.arange(starts[level], starts[level + 1])
        # A node's fail link is where its parent's leads with the same word.
        automaton.fail[own] = automaton.follow(automaton.fail[keys // symbols].astype(np.int64), keys % symbols)
        none = out[own] == 0
        out[own[none]] = out[automaton.fail[own[none]]]
    return automaton


def windows_of(item: str, text: bytes, size: int) -> Iterator[tuple[str, list[bytes]]]:
    """Runs of ``size`` words of an item; all its words if there are fewer, but not none."""
    words = words_of(text)
    for i in range(max(1, len(words) - size + 1)) if words else ():
        yield item, words[i : i + size]


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """(item, text): the rows of a benchmark once each, a null id as the empty text."""
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()


def benchmark_bytes(items: DataFrame) -> int:
    return items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0


def automata(benchmark: DataFrame, window: int, max_nodes: int, max_bytes: int) -> Iterator[Automaton]:
    """Automata of at most ``max_nodes`` nodes that hold all windows of a benchmark together.

    Items come to the driver in parts by hash of about ``max_bytes`` of text, one part at a time.
    """
    items = distinct_items(benchmark)
    parts = max(1, -(-benchmark_bytes(items) // max_bytes))
    for part in range(parts):
        held: list[tuple[str, list[bytes]]] = []
        room = max_nodes
        for row in items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).orderBy("text", "item").toLocalIterator():
            for pair in windows_of(row.item, row.text.encode(), window):
                # A window adds a node per word at most.
                if len(pair[1]) > room and held:
                    yield build(held)
                    held, room = [], max_nodes
                held.append(pair)
                room -= len(pair[1])
        if held:
            yield build(held)


def character_places(text: bytes, stretches: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of words as character offsets of the text, ends exclusive."""
    places = [match.span() for match in WORD.finditer(text)]
    before = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
    return [(int(before[places[a][0]]), int(before[places[b][1]])) for a, b in stretches.tolist()]


def contamination_udf(
    benchmark: DataFrame, window: int = 13, share: int = 20, max_bytes: int = 4 << 20
) -> Callable[[Column], Column]:
    """Column function from a text to a struct: words, words inside benchmark windows, their items.

    A window is ``window`` consecutive words of an item; a shorter item with any word is one window.
    ``contaminated`` is true from one hit word in ``share``. ``spans`` are the hit stretches as character
    offsets of the original text, ends exclusive. A null text has no words; an empty benchmark
    hits nothing; items count once per id, however often they are repeated, and a null id counts as ``''``.

    The benchmark goes whole to every task, some 40 bytes for each of its bytes, so its size is checked first: more than
    ``max_bytes`` is an error. :func:`contamination` takes larger ones in parts.
    """
    total = benchmark_bytes(distinct_items(benchmark))
    if total > max_bytes:
        raise ValueError(f"the benchmark has {total} bytes, over max_bytes={max_bytes}: contamination() takes it in parts")
    whole = next(automata(benchmark, window, 1 << 62, max(1, max_bytes)), None) or build([])
    shared = benchmark.sparkSession.sparkContext.broadcast(whole.arrays())

    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = Automaton(*shared.value)
        for part in parts:
            rows = []
            for _, _, some in text_slices(part):
                texts = list(binary_values(some))
                for text, (n_words, stretches, items) in zip(texts, automaton.find(texts), strict=True):
                    places = character_places(text, stretches) if len(stretches) else []
                    rows.append(judged(n_words, stretches, [automaton.names[i] for i in items.tolist()], places, share))
            yield pa.array(rows, FIELDS)

    return F.arrow_udf(scan, RESULT)


def judged(n_words: int, stretches: np.ndarray, items: list[str], places: list[tuple[int, int]], share: int) -> dict:
    n_hit = int((stretches[:, 1] - stretches[:, 0] + 1).sum())
    return {
        "n_words": n_words,
        "n_hit": n_hit,
        "n_items": len(items),
        "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
        "contaminated": n_hit > 0 and share * n_hit >= n_words,
        "spans": [{"start": a, "end": b} for a, b in places],
    }


def _finds(texts: DataFrame, automaton: Automaton) -> DataFrame:
    """(h1, h2, items, stretches) of the texts that hold a window of the automaton."""
    shared = texts.sparkSession.sparkContext.broadcast(automaton.arrays())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        for batch in batches:
            for start, _, some in text_slices(batch.column(2)):
                rows, at = [], []
                values = list(binary_values(some))
                for i, (text, (_, stretches, items)) in enumerate(zip(values, automaton.find(values), strict=True)):
                    if len(stretches):
                        places = character_places(text, stretches)
                        found = [
                            {"first": a, "last": b, "start": c, "end": d} for (a, b), (c, d) in zip(stretches.tolist(), places, strict=True)
                        ]
                        rows.append(([automaton.names[k] for k in items.tolist()], found))
                        at.append(start + i)
                if rows:
                    columns = [batch.column(k).take(pa.array(at)) for k in (0, 1)]
                    lists = [pa.array([row[0] for row in rows], pa.list_(pa.string())), pa.array([row[1] for row in rows], pa.list_(STRETCH))]
                    yield pa.RecordBatch.from_arrays([*columns, *lists], ["h1", "h2", "items", "stretches"])

    return texts.mapInArrow(scan, f"h1 long, h2 long, items array<string>, stretches {FOUND}")


def _merged(table: pa.Table) -> pa.Table:
    """The finds of all parts in one text: items once, overlapping and touching stretches as one."""
    items = sorted({name for names in table["items"].to_pylist() for name in names})
    merged: list[dict] = []
    for one in sorted((s for found in table["stretches"].to_pylist() for s in found), key=lambda s: s["first"]):
        if merged and one["first"] <= merged[-1]["last"] + 1:
            if one["last"] > merged[-1]["last"]:
                merged[-1] |= {"last": one["last"], "end": one["end"]}
        else:
            merged.append(dict(one))
    data = {
        "h1": table["h1"].slice(0, 1),
        "h2": table["h2"].slice(0, 1),
        "n_hit": pa.array([sum(s["last"] - s["first"] + 1 for s in merged)], pa.int64()),
        "n_items": pa.array([len(items)], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(items).encode()).hexdigest()]),
        "spans": pa.array([[{"start": s["start"], "end": s["end"]} for s in merged]], pa.list_(SPAN)),
    }
    return pa.table(data)


def clean(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", window: int = 13, share: int = 20, max_bytes: int = 4 << 20
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    A benchmark of more than ``max_bytes`` is taken in parts, as :func:`contamination` does; the texts that it names are then
    left out by their hashes.
    """
    if benchmark_bytes(distinct_items(benchmark)) <= max_bytes:
        judge = contamination_udf(benchmark, window, share, max_bytes)
        return docs.where(~judge(F.col(text_column))["contaminated"])
    texts = docs.select(F.xxhash64(F.coalesce(text_column, F.lit(""))).alias("doc_id"), F.col(text_column).alias("text"))
    judged_texts = contamination(texts, benchmark, window=window, share=share, max_bytes=max_bytes)
    bad = materialize(judged_texts.where("contaminated").select(F.col("doc_id").alias("_text_hash")).distinct(), "contaminated-texts")
    marked = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(text_column, F.lit(""))))
    return anti_join(marked, bad, ["_text_hash"]).drop("_text_hash")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 13,
    share: int = 20,
    max_bytes: int = 4 << 20,
    max_nodes: int = 8_000_000,
) -> DataFrame:
    """The fields of :func:`contamination_udf` after ``doc_id``, one row per row of ``docs``.

    Rows with equal or null ids each get a row. Only the id and text columns are read.

    A benchmark of more than ``max_bytes`` is taken in parts with automata of at most ``max_nodes`` nodes, each some
    20 bytes in every task: the texts are scanned once for each automaton, and the finds in equal texts, told by two hashes, are
    merged and joined to the rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    if benchmark_bytes(distinct_items(benchmark)) <= max_bytes:
        judge = contamination_udf(benchmark, window, share, max_bytes)
        return rows.select("doc_id", judge(F.col("text")).alias("found")).select("doc_id", "found.*")
    text = F.coalesce("text", F.lit(""))
    hashed = rows.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), F.reverse(text)).alias("h2"), text.alias("text"), "doc_id")
    parts = None
    for automaton in automata(benchmark, window, max_nodes, max_bytes):
        # Equal texts give equal finds, of which one per automaton is kept.
        found = materialize(_finds(hashed.select("h1", "h2", "text"), automaton).dropDuplicates(["h1", "h2"]), "benchmark-finds")
        parts = found if parts is None else parts.unionByName(found)
    n_words = F.when(text == "", F.lit(0)).otherwise(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))
    counted = hashed.select("doc_id", "h1", "h2", n_words.cast("long").alias("n_words"))
    schema = "h1 long, h2 long, n_hit long, n_items long, items_sha256 string, spans array<struct<start:long,end:long>>"
    merged = parts.groupBy("h1", "h2").applyInArrow(_merged, schema)
    n_hit = F.coalesce("n_hit", F.lit(0))
    none = hashlib.sha256(b"").hexdigest()
    return counted.join(merged, ["h1", "h2"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.lit(none)).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
    )
