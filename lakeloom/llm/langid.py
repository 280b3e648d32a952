"""Language identification by interpolated Kneser-Ney character models, one per language.

Words of letters are the unit: a word is read with a boundary before and after it, so equal words cost
the same in every text and are worked out once. All n-grams seen in training stand in one sorted array
of hashes per order, with a row of log probabilities per language; what is unseen backs off through the
weights of its context.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize, text_slices

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
EDGE = "\n"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
GRAMS_AT_ONCE = 400_000
WORDS_KEPT = 150_000
#: Characters beyond which a longer text does not narrow the spread of its cross-entropy.
SETTLED = 400


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; digits, fractions, raised and Roman numerals are no letters."""
    words = WORD.findall((text or "").lower())
    if all(map(str.isalpha, words)):
        return words
    return [part for word in words for part in "".join(c if c.isalpha() else " " for c in word).split()]


def rolled(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length up to ``order``, the hash of that many characters that end at each place."""
    value = codes + np.uint64(1)
    out = []
    for k in range(order):
        if k:
            before = np.concatenate([np.zeros(k, np.uint64), codes[:-k]])[: len(codes)]
            value = value * MULTIPLIER + before + np.uint64(1)
        out.append((value ^ (value >> np.uint64(31))) * MULTIPLIER)
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


@dataclass
class LanguageModel:
    """Per order: sorted hashes, and rows of log probabilities and log back-off weights by language.

    ``scale`` turns cross-entropies into probabilities; ``centre`` and ``limit`` say which texts fit
    no language. They come from :func:`calibrate`.
    """

    languages: list[str]
    hashes: list[np.ndarray] = field(default_factory=list)
    log_probs: list[np.ndarray] = field(default_factory=list)
    log_weights: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray | None = None
    scale: float = 20.0
    centre: np.ndarray | None = None
    limit: np.ndarray | None = None

    def arrays(self) -> tuple:
        """The parts of the model, which executors without this package can load."""
        return (
            self.languages, self.hashes, self.log_probs, self.log_weights, self.floor, self.scale, self.centre, self.limit
        )

    def find(self, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes[k], wanted), len(self.hashes[k]) - 1)
        return at, self.hashes[k][at] == wanted

    def words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, its end included, in each language."""
        codes = code_points(EDGE + EDGE.join(words) + EDGE)
        edges = np.flatnonzero(codes == ord(EDGE))
        order = len(self.hashes)
        grams = rolled(codes, order)
        last_edge = np.zeros(len(codes), np.int64)
        last_edge[edges] = edges
        last_edge = np.maximum.accumulate(last_edge)
        place = np.arange(1, len(codes))
        length = np.minimum(order, place - last_edge[:-1] + 1)
        result = np.zeros((len(place), len(self.languages)))
        for n in range(order, 0, -1):
            now = np.flatnonzero(length == n)
            at, found = self.find(n - 1, grams[n - 1][place[now]])
            result[now[found]] += self.log_probs[n - 1][at[found]]
            missed = now[~found]
            if n == 1:
                result[missed] += self.floor
            else:
                at, found = self.find(n - 2, grams[n - 2][place[missed] - 1])
                result[missed[found]] += self.log_weights[n - 2][at[found]]
                length[missed] -= 1
        return np.add.reduceat(result, edges[:-1], axis=0)


class Scorer:
    """Cross-entropies of texts; keeps the scores of words it has met, up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        fresh = [word for word in dict.fromkeys(words) if word not in self.known]
        parts, start, size = [self.scores], 0, 0
        for end, word in enumerate(fresh, 1):
            size += len(word) + 1
            if size >= GRAMS_AT_ONCE or end == len(fresh):
                parts.append(self.model.words(fresh[start:end]))
                start, size = end, 0
        self.known.update((word, len(self.scores) + i) for i, word in enumerate(fresh))
        self.scores = np.concatenate(parts)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character and language, characters) of each text."""
        found = [words_of(text) for text in texts]
        flat = [word for words in found for word in words]
        if len(self.known) > WORDS_KEPT:
            self.__init__(self.model)
        self._learn(flat)
        owner = np.repeat(np.arange(len(texts)), [len(words) for words in found])
        ids = np.fromiter((self.known[word] for word in flat), np.int64, len(flat))
        chars = np.bincount(owner, [len(word) + 1 for word in flat], len(texts))
        sums = [np.bincount(owner, self.scores[ids, i], len(texts)) for i in range(len(self.model.languages))]
        return -np.array(sums).T.reshape(len(texts), -1) / np.maximum(chars, 1)[:, None], chars


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): character n-grams of up to ``order`` characters in the words of (lang, text).

    A gram may start at the boundary before a word; the boundary alone counts as a word's end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, counted in words.items():
                grams: Counter = Counter()
                for word, times in counted.items():
                    padded = EDGE + word + EDGE
                    for end in range(2, len(padded) + 1):
                        for start in range(max(0, end - order), end):
                            grams[padded[start:end]] += times
                columns = [pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def smoothed(counts: DataFrame, languages: list[str], order: int) -> tuple[DataFrame, DataFrame]:
    """What Kneser-Ney smoothing takes from the counts (lang, gram, n).

    Gives (k, lang, gram, own), the discounted share of each gram of k characters in its context, and (k, lang, gram,
    weight), the back-off weight of each context. The highest order uses counts; the others the number of different
    characters seen before a gram, or its count where it starts at a word's boundary. One discount per language and order,
    n1 / (n1 + 2 n2).
    """
    names = F.array(*map(F.lit, languages))
    sized = counts.select((F.array_position(names, F.col("lang")) - 1).cast("int").alias("lang"), "gram", F.length("gram").alias("k"), "n")
    before = sized.where("k > 1").groupBy("lang", F.col("gram").substr(F.lit(2), F.col("k")).alias("gram")).agg(F.count("*").alias("before"))
    levels = sized.join(before, ["lang", "gram"], "left").select(
        "lang", "gram", "k", F.when(F.col("k") < order, F.coalesce("before", "n")).otherwise(F.col("n")).alias("n")
    )
    levels = materialize(levels, "langid-levels")
    spread = levels.groupBy("lang", "k").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    discount = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    # One row per language and order.
    levels = levels.join(spread.select("lang", "k", discount.alias("discount")), ["lang", "k"])
    context = F.col("gram").substr(F.lit(1), F.col("k") - 1)
    contexts = levels.groupBy("lang", "k", context.alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.first("discount").alias("discount")
    )
    joined = levels.withColumn("context", context).join(contexts.drop("kinds", "discount"), ["lang", "k", "context"])
    own = joined.select("k", "lang", "gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("own"))
    weights = contexts.select(
        (F.col("k") - 1).alias("k"), "lang", F.col("context").alias("gram"), (F.col("discount") * F.col("kinds") / F.col("total")).alias("weight")
    )
    return own, weights


def gram_hashes(grams: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of grams of k characters, of each without its first, and of each without its last character."""
    codes = code_points("".join(grams)).reshape(len(grams), k)

    def hashed(part: np.ndarray) -> np.ndarray:
        value = np.zeros(len(part), np.uint64)
        for place in range(part.shape[1] - 1, -1, -1):
            value = value * MULTIPLIER + part[:, place] + np.uint64(1)
        return (value ^ (value >> np.uint64(31))) * MULTIPLIER

    return hashed(codes), hashed(codes[:, 1:]), hashed(codes[:, :-1])


def hashed_grams(rows: DataFrame, value: str) -> DataFrame:
    """Rows (k, lang, gram, value) with hashes in place of the grams: numbers only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            hashes = np.zeros((3, len(sizes)), np.uint64)
            for k in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == k)
                hashes[:, at] = gram_hashes(batch.column(2).take(pa.array(at)).to_pylist(), k)
            columns = [pa.array(column.view(np.int64)) for column in hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, batch.column(3)], ["k", "lang", "hash", "rest", "context", value])

    return rows.mapInArrow(run, f"k int, lang int, hash long, rest long, context long, {value} double")


def estimate(counts: DataFrame, languages: list[str], order: int, max_bytes: int) -> LanguageModel:
    """Models of the counts (lang, gram, n), joined into one table per order.

    Spark counts, smooths and hashes; the driver receives arrays of numbers, after a check of what they and the tables
    made of them take, and adds up the orders: a gram's probability is its own share plus its context's
    weight times the probability of the gram without its first character.
    """
    model = LanguageModel(languages)
    if not languages:
        model.floor = np.zeros(0)
        return model
    own, weights = smoothed(materialize(counts, "langid-counts"), languages, order)
    own, weights = (materialize(hashed_grams(rows, name), f"langid-{name}") for rows, name in ((own, "own"), (weights, "weight")))
    sizes = own.agg(F.count("*").alias("rows"), F.count_distinct("k", "hash").alias("grams")).first()
    needed = 100 * sizes["rows"] + 16 * sizes["grams"] * len(languages)
    if not sizes["rows"]:
        return LanguageModel([], floor=np.zeros(0))
    if needed > max_bytes:
        raise ValueError(f"the language models take {needed} bytes, over max_bytes={max_bytes}: raise it or learn from fewer rows")
    own, weights = ({name: column.to_numpy() for name, column in zip(table.column_names, table.columns, strict=True)} for table in (own.toArrow(), weights.toArrow()))
    alphabet = len(np.unique(own["hash"][own["k"] == 1])) + 1
    n = len(languages)
    empty = weights["k"] == 0
    first = np.ones(n)
    first[weights["lang"][empty]] = weights["weight"][empty]
    model.floor = np.log(first / alphabet)
    probs = np.full((1, n), 1.0 / alphabet)
    known = np.zeros(1, np.uint64)
    back = first[None, :]
    for k in range(1, order + 1):
        rows = own["k"] == k
        hashes, at, which = np.unique(own["hash"][rows].view(np.uint64), return_index=True, return_inverse=True)
        shares = np.zeros((len(hashes), n))
        shares[which, own["lang"][rows]] = own["own"][rows]
        if k == 1:
            probs = shares + back * probs
        else:
            rest = np.searchsorted(known, own["rest"][rows].view(np.uint64)[at])
            context = np.searchsorted(known, own["context"][rows].view(np.uint64)[at])
            probs = shares + back[context] * probs[rest]
        known = hashes
        back = np.ones((len(hashes), n))
        mine = weights["k"] == k
        place = np.searchsorted(known, weights["hash"][mine].view(np.uint64))
        back[place, weights["lang"][mine]] = weights["weight"][mine]
        model.hashes.append(hashes)
        model.log_probs.append(np.log(probs))
        model.log_weights.append(np.log(back))
    return model


def calibrate(model: LanguageModel, truth: np.ndarray, entropy: np.ndarray, chars: np.ndarray) -> None:
    """Set ``scale``, ``centre`` and ``limit`` from texts that training left out.

    The scale is the one of a fixed grid under which the true languages are likeliest. The limit of a
    language is twice the largest deviation of its own texts, a deviation being the distance from their mean
    times the root of the length, up to :data:`SETTLED` characters. Without texts nothing is rejected.
    """
    n = len(model.languages)
    model.centre, model.limit = np.zeros(n), np.full(n, np.inf)
    if not len(truth):
        return
    rows = np.arange(len(truth))
    gap = entropy - entropy.min(axis=1, keepdims=True)

    def fit(scale: float) -> float:
        return float((scale * gap[rows, truth] + np.log(np.exp(-scale * gap).sum(axis=1))).sum())

    model.scale = min((1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0), key=fit)
    own = entropy[rows, truth]
    for i in range(n):
        if (mine := truth == i).any():
            model.centre[i] = own[mine].mean()
            model.limit[i] = 2 * max(deviation(own[mine] - model.centre[i], chars[mine]).max(), 1e-9)


def deviation(distance: np.ndarray, chars: np.ndarray) -> np.ndarray:
    return distance * np.sqrt(np.minimum(chars, SETTLED))


def train(
    docs: DataFrame,
    order: int = 5,
    max_rows_per_language: int = 1500,
    max_languages: int = 400,
    max_bytes: int = 512 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """Fit and calibrate on the rows of ``docs`` with a language and a letter in the text.

    About ``max_rows_per_language`` rows of each language are read, chosen by a hash of the id: all if there
    are fewer. A fifth of them calibrates. More than ``max_languages`` languages, or models of more than ``max_bytes``
    together, are an error that names the parameter. Without any row the model knows no language and every text
    is undetermined.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).where(F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than max_languages={max_languages} languages")
    if not sizes:
        return estimate(rows, [], order, max_bytes)
    share = F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], max_rows_per_language / row["count"])))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    rows = rows.where((place < share[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5))
    learned = rows.where(part != 0)
    languages = sorted(row["lang"] for row in learned.select("lang").distinct().collect())
    model = estimate(count_grams(learned, order), languages, order, max_bytes)
    if not model.languages:
        return model
    held = entropies(rows.where((part == 0) & F.col("lang").isin(model.languages)), model).toArrow()
    truth = np.array([model.languages.index(lang) for lang in held["lang"].to_pylist()], np.int64)
    table = np.array(held["entropy"].to_pylist()).reshape(len(truth), -1)
    calibrate(model, truth, table, held["chars"].to_numpy())
    return model


def entropies(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(lang, entropy array<double>, chars) of (lang, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(LanguageModel(*shared.value))
        for batch in batches:
            entropy, chars = scorer(batch.column(1).to_pylist())
            arrays = [batch.column(0), pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(chars)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "entropy", "chars"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, entropy array<double>, chars double")


def identify_udf(spark: SparkSession, model: LanguageModel) -> Callable[[Column], Column]:
    """Column function from a text to (lang_pred, score, rejected).

    ``lang_pred`` is the language of lowest cross-entropy per character, the first by name of equal
    ones; ``und`` with score 0 where the text is null, has no letter, or no language was learned. ``rejected``
    is true for ``und`` and for texts beyond the calibrated limit of their language.
    """
    shared = spark.sparkContext.broadcast(model.arrays())

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = LanguageModel(*shared.value)
        scorer = Scorer(model)
        for part in parts:
            names, scores, rejected = [], [], []
            for _, _, texts in text_slices(part):
                for column, values in zip((names, scores, rejected), _decide(model, scorer, texts.to_pylist()), strict=True):
                    column.extend(values)
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "rejected"])

    return F.arrow_udf(run, "struct<lang_pred:string,score:double,rejected:boolean>")


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of :func:`identify_udf` for every row."""
    found = identify_udf(docs.sparkSession, model)(F.col(text_column))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), found.alias("found")).select("doc_id", "found.*")


def _decide(model: LanguageModel, scorer: Scorer, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
    entropy, chars = scorer(texts)
    at = entropy.argmin(axis=1)
    gap = entropy - entropy.min(axis=1, keepdims=True)
    score = 1.0 / np.exp(-model.scale * gap).sum(axis=1)
    low = entropy[np.arange(len(texts)), at]
    far = deviation(low - model.centre[at], chars) > model.limit[at]
    none = chars == 0
    names = [UNDETERMINED if empty else model.languages[i] for i, empty in zip(at.tolist(), none.tolist(), strict=True)]
    return names, np.where(none, 0.0, score).tolist(), (far | none).tolist()
