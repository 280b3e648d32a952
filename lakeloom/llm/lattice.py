"""Document likelihood under a subword lattice.

A vocabulary's pieces, each with a probability, give a word as many segmentations as they tile it; the
probability of the word is the sum over all of them, by a forward recursion in log space. A document is its
words, each with a mark before it, and an end. Pieces start from the scores of the existing vocabulary, and
rounds of expected counts over the words of the training documents move them to the corpus.

Equal words have equal probability, so recursions run once per distinct word of the corpus. The most
frequent words go to every task as a bounded table; the others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, materialize

#: Stands before each word, as the vocabulary's own mark does; words cannot hold it.
MARK = b" "
VOCABULARY_MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 22
BYTES_AT_ONCE = 1 << 18
#: Words longer than this are matched block by block.
LONG = 1 << 14
DISTINCT_AT_ONCE = 200_000
LN10 = float(np.log(10.0))


@dataclass(frozen=True)
class LatticeSettings:
    """``head`` words at most, and ``head_bytes`` of them, go to every task. ``prior`` is the weight, in pieces, of the
    vocabulary's own scores against the counts of the corpus; ``rank_offset`` turns a score that is a rank into a share.
    ``whole_words`` makes every training word a piece of its own beside the vocabulary's."""

    head: int = 100_000
    head_bytes: int = 8 << 20
    whole_words: bool = False
    rounds: int = 2
    prior: float = 10_000.0
    rank_offset: float = 2.7


def vocabulary(model_file: str, rank_offset: float = 2.7) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, the mark as a space, and their prior probabilities.

    Pieces with capitals or a mark inside cannot occur in lower-cased words and are left out; all 256 single
    bytes are in, so every word has a segmentation. Scores that are ranks become shares that fall as
    one over the rank.
    """
    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    shares: dict[bytes, float] = {}
    for i in range(processor.get_piece_size()):
        if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) or processor.is_byte(i):
            continue
        text = processor.id_to_piece(i)
        piece = text.replace(VOCABULARY_MARK, " ").encode()
        if piece.lower() == piece and b" " not in piece[1:]:
            shares[piece] = 1.0 / (rank_offset - min(0.0, processor.get_score(i)))
    least = min(shares.values(), default=1.0)
    for c in range(256):
        shares.setdefault(bytes([c]), least)
    pieces = sorted(shares)
    weights = np.array([shares[piece] for piece in pieces])
    return pieces, weights / weights.sum()


class Lattice:
    """Sums over the segmentations of many words at once."""

    def __init__(self, pieces: list[bytes], log_probs: np.ndarray):
        self.longest = max(map(len, pieces))
        self.log_probs = log_probs
        lengths = np.array([len(piece) for piece in pieces])
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        for size in range(1, self.longest + 1):
            ids = np.flatnonzero(lengths == size)
            letters = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(len(ids), size)
            hashes = self._hashes(letters)[size - 1][:, 0] if len(ids) else np.zeros(0, np.uint64)
            order = np.argsort(hashes)
            self.tables.append((hashes[order], ids[order]))
            self.filter[hashes >> np.uint64(64 - FILTER_BITS)] = True

    @staticmethod
    def _spread(value: np.ndarray) -> np.ndarray:
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(29))

    def _hashes(self, letters: np.ndarray) -> list[np.ndarray]:
        """For each length, hashes of the runs of that many bytes that start at each place of a row."""
        width = letters.shape[1]
        out, value = [], np.zeros(letters.shape, np.uint64)
        for size in range(1, min(self.longest, width) + 1):
            value = value[:, : width - size + 1] * BASE + letters[:, size - 1 :] + np.uint64(1)
            out.append(self._spread(value))
        return out

    def _matches(self, letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length (row, start, piece) of the pieces that occur in rows of bytes."""
        found = []
        for (known, ids), value in zip(self.tables, self._hashes(letters), strict=False):
            row, start = np.nonzero(self.filter[value >> np.uint64(64 - FILTER_BITS)])
            if len(known):
                wanted = value[row, start]
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = known[at] == wanted
                found.append((row[hit], start[hit], ids[at[hit]]))
            else:
                found.append((row[:0], start[:0], row[:0]))
        return found

    def _steps(self, letters: np.ndarray) -> tuple[list[np.ndarray], list]:
        found = self._matches(letters)
        steps = []
        for size, (row, start, piece) in enumerate(found, 1):
            step = np.full((len(letters), letters.shape[1] - size + 1), -np.inf)
            step[row, start] = self.log_probs[piece]
            steps.append(step)
        return steps, found

    @staticmethod
    def _forward(steps: list[np.ndarray], n: int, width: int) -> np.ndarray:
        total = np.full((n, width + 1), -np.inf)
        total[:, 0] = 0.0
        for end in range(1, width + 1):
            parts = np.stack([total[:, end - size] + steps[size - 1][:, end - size] for size in range(1, min(len(steps), end) + 1)])
            top = parts.max(axis=0)
            total[:, end] = top + np.log(np.exp(parts - top).sum(axis=0))
        return total

    @staticmethod
    def _backward(steps: list[np.ndarray], n: int, width: int) -> np.ndarray:
        total = np.full((n, width + 1), -np.inf)
        total[:, width] = 0.0
        for start in range(width - 1, -1, -1):
            parts = np.stack([total[:, start + size] + steps[size - 1][:, start] for size in range(1, min(len(steps), width - start) + 1)])
            top = parts.max(axis=0)
            total[:, start] = top + np.log(np.exp(parts - top).sum(axis=0))
        return total

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word numbers, their bytes with the mark) of equal length, a bounded number at once."""
        sizes = np.array([len(word) for word in words])
        for size in np.unique(sizes):
            ids = np.flatnonzero(sizes == size)
            step = max(1, BYTES_AT_ONCE // int(size + 1))
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                data = b"".join(MARK + words[i] for i in part)
                yield part, np.frombuffer(data, np.uint8).reshape(len(part), size + 1)

    def _long_totals(self, letters: np.ndarray, backward: bool) -> np.ndarray:
        """The sums of :meth:`_forward` or :meth:`_backward` for one long word, matched block by block."""
        width, reach = len(letters), self.longest
        total = np.full(width + 1, -np.inf)
        total[width if backward else 0] = 0.0
        blocks = range(0, width, LONG)
        for low in reversed(blocks) if backward else blocks:
            high = min(low + LONG, width)
            # Pieces that start, or else end, in the block.
            a, b = (low, min(width, high + reach - 1)) if backward else (max(0, low - reach + 1), high)
            steps, _ = self._steps(letters[None, a:b])
            places = range(high - 1, low - 1, -1) if backward else range(low + 1, high + 1)
            for place in places:
                if backward:
                    sizes = range(1, min(len(steps), b - place) + 1)
                    parts = [total[place + size] + steps[size - 1][0, place - a] for size in sizes]
                else:
                    sizes = range(1, min(len(steps), place - a) + 1)
                    parts = [total[place - size] + steps[size - 1][0, place - size - a] for size in sizes]
                top = max(parts)
                total[place] = top + np.log(sum(np.exp(part - top) for part in parts if part > -np.inf))
        return total

    def log_likelihood(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        result = np.empty(len(words))
        for ids, letters in self._groups(words):
            if letters.shape[1] > LONG:
                result[ids] = [self._long_totals(row, False)[-1] for row in letters]
                continue
            steps, _ = self._steps(letters)
            result[ids] = self._forward(steps, *letters.shape)[:, -1]
        return result

    def expected_counts(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected number of each piece in the words, each word as often as ``times`` says."""
        result = np.zeros(len(self.log_probs))
        for ids, letters in self._groups(words):
            if letters.shape[1] > LONG:
                for i, row in zip(ids, letters, strict=True):
                    result += times[i] * self._long_counts(row)
                continue
            steps, found = self._steps(letters)
            ahead, behind = self._forward(steps, *letters.shape), self._backward(steps, *letters.shape)
            whole = ahead[:, -1]
            for size, (row, start, piece) in enumerate(found, 1):
                share = np.exp(ahead[row, start] + self.log_probs[piece] + behind[row, start + size] - whole[row])
                result += np.bincount(piece, share * times[ids[row]], len(result))
        return result


    def _long_counts(self, letters: np.ndarray) -> np.ndarray:
        """Expected number of each piece in one long word."""
        ahead, behind = self._long_totals(letters, False), self._long_totals(letters, True)
        result, whole = np.zeros(len(self.log_probs)), ahead[-1]
        for low in range(0, len(letters), LONG):
            high = min(low + LONG, len(letters))
            for size, (_, start, piece) in enumerate(self._matches(letters[None, low : min(len(letters), high + self.longest - 1)]), 1):
                inside = start < high - low
                start, piece = start[inside] + low, piece[inside]
                result += np.bincount(piece, np.exp(ahead[start] + self.log_probs[piece] + behind[start + size] - whole), len(result))
        return result


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def count_words(docs: DataFrame, training: Column, text_column: str = "text") -> DataFrame:
    """(word, n): every distinct word of ``docs`` as bytes, and how often the training rows hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())]
            counted.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text, counts in zip(binary_values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for word, times in Counter(tokens(text)).items():
                    counted[word] = counted.get(word, 0) + (times if counts else 0)
                if len(counted) > DISTINCT_AT_ONCE:
                    yield flushed()
        if counted:
            yield flushed()

    picked = docs.select(F.col(text_column).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    return picked.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_pieces(words: DataFrame, ends: int, pieces: list[bytes], prior: np.ndarray, settings: LatticeSettings) -> tuple[np.ndarray, float]:
    """(natural log probability of each piece, of the end), from (word, n) and the number of training texts.

    Each round adds the expected counts under the last probabilities to the prior's; pieces and the end share one unit
    of probability.
    """
    spark = words.sparkSession
    probs = prior
    counts = prior * settings.prior
    for _ in range(settings.rounds):
        shared = spark.sparkContext.broadcast((pieces, np.log(probs)))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shared.value)
            total = np.zeros(len(lattice.log_probs))
            for batch in batches:
                total += lattice.expected_counts(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "expected"])

        sums = words.where("n > 0").mapInArrow(expect, "piece long, expected double").groupBy("piece").agg(F.sum("expected"))
        found = sums.toArrow()
        counts = prior * settings.prior
        counts[found[0].to_numpy()] += found[1].to_numpy()
        probs = counts / counts.sum()
    end = (ends + 1.0) / (ends + 1.0 + counts.sum())
    return np.log(probs) + np.log1p(-end), float(np.log(end))


def with_whole_words(words: DataFrame, total: int, kinds: int, end: float) -> Column:
    """Log10 probability of a word as a piece of its own or by its segmentations, from its count and the latter.

    ``end`` is the natural log of the probability of an end, which is no word's.
    """
    spread = words.agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    discount = spread["n1"] / (spread["n1"] + 2 * spread["n2"]) if spread["n1"] and spread["n2"] else 0.5
    word = float(np.log10(-np.expm1(end)))
    rest = F.lit(float(np.log10(discount * kinds / total))) + F.col("lattice")
    whole = F.when(F.col("n") > 0, F.log10((F.col("n") - discount) / total) + word)
    # The larger first, so that neither power overflows or is lost.
    top = F.greatest(whole, rest)
    return F.when(whole.isNull(), rest).otherwise(top + F.log10(F.pow(F.lit(10.0), whole - top) + F.pow(F.lit(10.0), rest - top)))


def frequent_words(scored: DataFrame, settings: LatticeSettings) -> DataFrame:
    """The most frequent words, ``head`` of them and ``head_bytes`` at most together."""
    order = Window.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, 0)
    # One task adds up ``head`` rows; longer words than the bound allows are left out before.
    few = scored.where(F.octet_length("word") <= settings.head_bytes).orderBy(F.desc("n"), "word").limit(settings.head)
    return few.withColumn("held", F.sum(F.octet_length("word")).over(order)).where(F.col("held") <= settings.head_bytes).drop("held")


def score_documents(
    docs: DataFrame,
    training: Column,
    model_file: str,
    settings: LatticeSettings = LatticeSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``training`` marks the rows to learn from; null means no. ``score`` is the log10 probability of the
    whole text, summed over segmentations; ``base_score`` that under word counts with one added. A
    null or empty text is an end alone. Without training rows pieces keep their prior and no word is known. Equal
    and null ids are kept apart. Other columns are not read.

    With ``whole_words`` a word that was seen c times is also a piece of its own, with probability (c - d) / n: d is the absolute
    discount n1 / (n1 + 2 n2) of the words' counts, and what it takes off is the share of all other segmentations. So the
    model holds every word of the corpus, however many, and still gives each unseen one a probability.
    """
    spark = docs.sparkSession
    mark = F.coalesce(training, F.lit(False))
    words = materialize(count_words(docs, mark, text_column), "word-counts")
    ends = docs.where(mark).count()
    held = words.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    train_tokens = (held[0] or 0) + ends
    kinds = held[1] + (1 if ends else 0)
    pieces, prior = vocabulary(model_file, settings.rank_offset)
    log_probs, end = fit_pieces(words, ends, pieces, prior, settings)
    shared = spark.sparkContext.broadcast((pieces, log_probs))

    def likelihood(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(*shared.value)
        for part in parts:
            yield pa.array(lattice.log_likelihood(part.to_pylist()) / LN10)

    base = F.log10((F.col("n") + 1) / F.lit(float(train_tokens + kinds + 1)))
    scored = words.select("word", "n", base.alias("base"), F.arrow_udf(likelihood, "double")(F.col("word")).alias("lattice"))
    if settings.whole_words and held[0]:
        scored = scored.withColumn("lattice", with_whole_words(words, held[0], held[1], end))
    scored = materialize(scored, "word-scores")
    head = frequent_words(scored, settings).toArrow()
    names = head["word"].to_pylist()
    numbers = [head[name].to_numpy() for name in ("n", "base", "lattice")]
    table = spark.sparkContext.broadcast((names, numbers))
    end_base = float(np.log10((ends + 1) / (train_tokens + kinds + 1)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, (n, base, lattice) = table.value
        known = {word: i for i, word in enumerate(names)}
        n, base, lattice = (np.append(values, 0) for values in (n > 0, base, lattice))
        for batch in batches:
            rows = []
            for text in binary_values(batch.column(2)):
                found = tokens(text)
                at = np.fromiter((known.get(word, -1) for word in found), np.int64, len(found))
                rest = [found[i] for i in np.flatnonzero(at < 0)]
                rows.append((len(found) + 1, int(n[at].sum()), float(base[at].sum()), float(lattice[at].sum()), rest))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            out = [batch.column(0), batch.column(1), *columns]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "training", "n_tokens", "n_known", "base", "lattice", "rest"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), mark.alias("training"), F.col(text_column).alias("text"))
    parts = picked.mapInArrow(
        split,
        "doc_id long, training boolean, n_tokens long, n_known long, base double, lattice double, rest array<binary>",
    )
    parts = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "document-parts")
    rare = parts.select("row", F.explode("rest").alias("word")).join(scored, "word")
    rare = rare.groupBy("row").agg(
        F.sum((F.col("n") > 0).cast("long")).alias("more_known"),
        F.sum("base").alias("more_base"),
        F.sum("lattice").alias("more_lattice"),
    )
    added = {name: F.coalesce(f"more_{name}", F.lit(0)) for name in ("known", "base", "lattice")}
    return parts.drop("rest").join(rare, "row", "left").select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("n_known") + added["known"] + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + added["base"] + F.lit(end_base)).alias("base_score"),
        (F.col("lattice") + added["lattice"] + F.lit(end / LN10)).alias("score"),
    )
