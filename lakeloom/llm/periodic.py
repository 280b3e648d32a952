"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q and at least four of them, that no neighbouring word
extends. At scale B the words are cut into blocks of B words. A run whose period lies in [B, 2B) holds a
whole block near its start, and that block's next copy q words further on. For every block an exact integer
number-theoretic transform gives the sum of squared differences between the block and the window after
it, at all distances of the scale at once: a sum of zero is an occurrence, and its distance seeds the extension.

Two filters spare work and lose nothing. A block is transformed only if each of its words comes again at some distance
of the scale. And a seed inside a run of a smaller scale is a multiple of that run's period, so it is dropped. Seeds
of one stretch and distance stand in consecutive blocks, so a stretch needs a few comparisons at its two
ends only, and the work is n log^2 n at most, also for texts that are one word over and over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import binary_values, text_slices

#: Primes k * 2**m + 1, each with the primitive root 3.
PRIMES = (998_244_353, 1_004_535_809, 469_762_049)
ROOT = 3
#: Entries of one batch of transforms.
BATCH = 1 << 18
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FIELDS = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
RESULT = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


@lru_cache(maxsize=64)
def roots(size: int, prime: int, inverse: bool) -> np.ndarray:
    """The first ``size / 2`` powers of a primitive root of unity of order ``size``."""
    step = pow(ROOT, (prime - 1) // size, prime)
    step = pow(step, -1, prime) if inverse else step
    powers = np.ones(max(1, size // 2), np.uint64)
    done = 1
    while done < len(powers):
        powers[done : 2 * done] = powers[:done] * np.uint64(pow(step, done, prime)) % np.uint64(prime)
        done *= 2
    return powers


def transform(values: np.ndarray, prime: int) -> None:
    """Number-theoretic transform of each row in place, in bit-reversed order."""
    p = np.uint64(prime)
    half = values.shape[1] // 2
    while half:
        pairs = values.reshape(len(values), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + (p - high)) % p * roots(2 * half, prime, False) % p
        half //= 2


def transform_back(values: np.ndarray, prime: int) -> None:
    """The inverse of :func:`transform`, in place."""
    p = np.uint64(prime)
    half = 1
    while half < values.shape[1]:
        pairs = values.reshape(len(values), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1] * roots(2 * half, prime, True) % p
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + (p - high)) % p
        half *= 2
    values *= np.uint64(pow(values.shape[1], -1, prime))
    values %= p


def squared_differences(ids: np.ndarray, starts: np.ndarray, size: int, prime: int) -> np.ndarray:
    """For each block and each distance ``size`` to ``2 size - 1``, the sum of squared differences between
    the block and the words that far on, modulo the prime. ``ids`` reaches ``3 size`` beyond each start."""
    p = np.uint64(prime)
    block = np.zeros((len(starts), 2 * size), np.uint64)
    # Reversed, so that the product of transforms is a correlation; no distance of interest wraps round.
    block[:, -np.arange(size) % (2 * size)] = ids[starts[:, None] + np.arange(size)] % prime
    window = (ids[starts[:, None] + np.arange(size, 3 * size)] % prime).astype(np.uint64)
    squares = np.zeros((len(starts), 2 * size + 1), np.uint64)
    np.cumsum(window * window % p, axis=1, out=squares[:, 1:])
    own = (block * block % p).sum(axis=1) % p
    total = (own[:, None] + (squares[:, size : 2 * size] - squares[:, :size]) % p) % p
    transform(block, prime)
    transform(window, prime)
    block = block * window % p
    transform_back(block, prime)
    return (total + np.uint64(2) * (p - block[:, :size])) % p


def occurrences(ids: np.ndarray, starts: np.ndarray, size: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of every place where a block stands again, at distances ``size`` to ``2 size - 1``.

    A sum of squares is below ``size * largest ** 2``. Zero modulo primes whose product is above that is zero.
    """
    primes, bound = [], size * largest**2
    product = 1
    for prime in PRIMES:
        primes.append(prime)
        product *= prime
        if product > bound:
            break
    else:
        raise ValueError(f"{largest} different words in one text are too many")
    found_at, found_far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = max(1, BATCH // (2 * size))
    for at in range(0, len(starts), rows):
        some = starts[at : at + rows]
        row, far = np.nonzero(squared_differences(ids, some, size, primes[0]) == 0)
        for prime in primes[1:]:
            if len(row):
                which, row = np.unique(row, return_inverse=True)
                sums = squared_differences(ids, some[which], size, prime)
                zero = sums[row, far] == 0
                row, far = which[row[zero]], far[zero]
        found_at.append(some[row])
        found_far.append(far + size)
    return np.concatenate(found_at), np.concatenate(found_far)


def recurring_blocks(keys: np.ndarray, ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The blocks each of whose words comes again at a distance of the scale; a few words are looked up at first.

    ``keys`` are the sorted pairs of a word and a place, ``word * len(ids) + place``.
    """
    step = size
    while step and len(starts):
        offsets = np.arange(step % size, size, 2 * step) if step < size else np.zeros(1, np.int64)
        parts = []
        rows = max(1, BATCH // len(offsets))
        for at in range(0, len(starts), rows):
            some = starts[at : at + rows]
            place = some[:, None] + offsets
            first = ids[place] * len(ids) + place + size
            after = keys[np.minimum(np.searchsorted(keys, first.ravel()), len(keys) - 1)].reshape(first.shape)
            parts.append(some[((after >= first) & (after < first + size)).all(axis=1)])
        starts = np.concatenate(parts)
        step //= 2
    return starts


def periodic_runs(words: np.ndarray, longest: int, min_words: int = 6, min_periods: int = 4) -> np.ndarray:
    """(start, length, period) of all runs in a sequence of numbers 0, 1, 2 …, by start, then period.

    ``longest`` bounds the length of a run. Texts may stand one after another if numbers between them occur
    once each. ``min_periods`` is 4 at least.
    """
    if min_periods < 4:
        raise ValueError("the scales need runs of four periods at least")
    n = len(words)
    found = np.zeros((0, 3), np.int64)
    scales = []
    while 4 << len(scales) <= max(longest, 4):
        scales.append(1 << len(scales))
    if n < 4:
        return found
    beyond = int(words.max()) + 1
    ids = np.concatenate([words.astype(np.int64), np.full(3 * scales[-1], beyond, np.int64)])
    keys = np.sort(ids[:n] * len(ids) + np.arange(n))
    for size in scales:
        # How far runs of smaller scales reach that start here or before.
        reach = np.zeros(n, np.int64)
        np.maximum.at(reach, found[:, 0], found[:, 0] + found[:, 1])
        reach = np.maximum.accumulate(reach)
        starts = np.arange(0, n - size + 1, size)
        starts = starts[starts + 3 * size > reach[starts]]
        starts = recurring_blocks(keys, ids, starts, size)
        if not len(starts):
            continue
        at, far = occurrences(ids, starts, size, beyond)
        fresh = at + size + far > reach[at]
        at, far = at[fresh], far[fresh]
        if not len(at):
            continue
        order = np.lexsort((at, far))
        at, far = at[order], far[order]
        breaks = np.flatnonzero((np.diff(far) != 0) | (np.diff(at) != size)) + 1
        first, last = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(at)]]) - 1
        # A stretch of equal words that is long enough holds this many whole blocks.
        need = (((min_periods - 1) * far[first] + 1) // size) - 1
        enough = last - first + 1 >= need
        runs = []
        for low, high, period in zip(at[first[enough]], at[last[enough]] + size, far[first[enough]], strict=True):
            before = max(0, low - size + 1)
            same = ids[before:low] == ids[before + period : low + period]
            low -= len(same) if same.all() else int(same[::-1].argmin())
            same = ids[high : high + size] == ids[high + period : high + period + size]
            high += len(same) if same.all() else int(same.argmin())
            # Beyond the last word stands padding, which no word equals.
            length = min(high, n - period) - low + period
            if length >= max(min_words, min_periods * period):
                runs.append((low, length, period))
        if runs:
            found = np.concatenate([found, np.array(runs, np.int64)])
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[bytes], min_words: int, min_periods: int) -> list[tuple[list[bytes], np.ndarray]]:
    """(words, runs) of each text. Words lie between ASCII spaces, tabs and line breaks."""
    split = [text.split() for text in texts]
    numbers: dict[bytes, int] = {}
    total = sum(len(words) + 1 for words in split)
    ids = np.empty(total, np.int64)
    first = np.zeros(len(split) + 1, np.int64)
    for i, words in enumerate(split):
        a = first[i]
        b = first[i + 1] = a + len(words) + 1
        ids[a : b - 1] = [numbers.setdefault(word, len(numbers)) for word in words]
    # A number of its own after each text.
    ids[first[1:] - 1] = len(numbers) + np.arange(len(split))
    longest = max(map(len, split), default=0)
    runs = periodic_runs(ids, longest, min_words, min_periods)
    owner = np.searchsorted(first, runs[:, 0], side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(split) + 1))
    out = []
    for i, words in enumerate(split):
        own = runs[bounds[i] : bounds[i + 1]].copy()
        own[:, 0] -= first[i]
        out.append((words, own))
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that repeat a run's first period, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(marks[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def runs_udf(min_words: int = 6, min_periods: int = 4) -> Callable[[Column], Column]:
    """Column function from a text to (n_words, runs, collapsed); see :func:`find_runs`."""

    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            counts, runs, texts = [], [], []
            for _, _, some in text_slices(part):
                for words, own in runs_of_texts(list(binary_values(some)), min_words, min_periods):
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
                    texts.append(collapse(words, own))
            columns = [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.StructArray.from_arrays(columns, fields=list(FIELDS))

    return F.arrow_udf(scan, RESULT)


def find_runs(
    docs: DataFrame, min_words: int = 6, min_periods: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``; other columns are not read.

    ``runs`` are all maximal stretches of ``min_words`` words and ``min_periods`` periods at least, as (start, length,
    period) in words from 0, by start, then period. ``collapsed`` is the text without the words that
    stand in a run after its first period, joined by single blanks. Rows are judged one by one: rows with equal or
    null ids each get a row, a null or empty text has no words and no run and an empty ``collapsed``. A text is
    searched as a whole, so a task's memory grows with its longest text.
    """
    found = runs_udf(min_words, min_periods)(F.col(text_column))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), found.alias("found")).select("doc_id", "found.*")
