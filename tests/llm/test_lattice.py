from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import lattice
from lakeloom.llm.queries import VOCABULARY

PIECES = sorted({bytes([c]) for c in range(256)} | {b" a", b"ab", b"abc", b" the", b"he", b"th", "é".encode()})


def shares(seed=0):
    weights = np.random.default_rng(seed).uniform(0.1, 2.0, len(PIECES))
    return weights / weights.sum()


def segmentations(word):
    if not word:
        yield []
    for piece in PIECES:
        if word.startswith(piece):
            for rest in segmentations(word[len(piece) :]):
                yield [piece, *rest]


WORDS = [b"a", b"abc", b"the", b"theabcab", "été".encode(), b"zz", b"abcabc"]


def test_likelihood_sums_over_all_segmentations():
    probs = dict(zip(PIECES, shares(), strict=True))
    found = lattice.Lattice(PIECES, np.log(shares())).log_likelihood(WORDS)
    for word, value in zip(WORDS, found, strict=True):
        whole = sum(np.prod([probs[piece] for piece in parts]) for parts in segmentations(b" " + word))
        assert value == pytest.approx(np.log(whole))


def test_expected_counts_weight_segmentations():
    probs = dict(zip(PIECES, shares(), strict=True))
    times = np.arange(1.0, len(WORDS) + 1)
    expected = np.zeros(len(PIECES))
    for word, n in zip(WORDS, times, strict=True):
        ways = [(parts, np.prod([probs[piece] for piece in parts])) for parts in segmentations(b" " + word)]
        whole = sum(weight for _, weight in ways)
        for parts, weight in ways:
            for piece in parts:
                expected[PIECES.index(piece)] += n * weight / whole
    assert np.allclose(lattice.Lattice(PIECES, np.log(shares())).expected_counts(WORDS, times), expected)


def test_a_very_long_word():
    value = lattice.Lattice(PIECES, np.log(shares())).log_likelihood([b"ab" * 10_000])
    assert np.isfinite(value).all() and value[0] < -1000


ROWS = [
    (1, "The cat sat, the cat", "x"),
    (2, "the\tdog\n sat", "x"),
    (3, None, "x"),
    (4, "", None),
    (5, "unseen words été", "x"),
    (6, "the the the " * 300, "x"),
    (2, "the\tdog\n sat", "x"),
    (None, "cat", "x"),
]


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_scores_follow_the_definition(spark, head):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score string")
    settings = lattice.LatticeSettings(head=head, rounds=1)
    learned = F.col("doc_id").isin(1, 2, 3, 6)
    found = lattice.score_documents(docs, learned, VOCABULARY, settings).collect()

    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    counts = Counter(token for number, text, _ in ROWS if number in (1, 2, 3, 6) for token in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    pieces, prior = lattice.vocabulary(VOCABULARY)
    words = [word for word in counts if word is not None]
    model = lattice.Lattice(pieces, np.log(prior))
    sums = prior * settings.prior + model.expected_counts(words, np.array([float(counts[word]) for word in words]))
    end = (counts[None] + 1) / (counts[None] + 1 + sums.sum())
    model = lattice.Lattice(pieces, np.log(sums / sums.sum() * (1 - end)))
    expected = []
    for number, text, _ in ROWS:
        own = tokens(text)
        base = sum(np.log10((counts[token] + 1) / (total + kinds + 1)) for token in own)
        value = sum(model.log_likelihood([token])[0] for token in own if token is not None) + np.log(end)
        known = sum(counts[token] > 0 for token in own)
        expected.append((number, number in (1, 2, 3, 6), len(own), known, total, base, value / np.log(10)))

    def key(row):
        return row[0] is None, row[0] or 0, row[2]

    for row, other in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert row[:5] == other[:5]
        assert row[5:] == pytest.approx(other[5:])


def test_nothing_to_learn_and_nothing_to_score(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score string")
    found = lattice.score_documents(docs, F.lit(False), VOCABULARY).collect()
    assert {row.train_tokens for row in found} == {0} and {row.n_known for row in found} == {0}
    assert all(np.isfinite(row.score) for row in found)
    assert lattice.score_documents(docs.limit(0), F.lit(True), VOCABULARY).collect() == []


def test_long_words_are_summed_block_by_block(monkeypatch):
    word = b"theabcab" * 40 + "été".encode() + b"zz"
    whole = lattice.Lattice(PIECES, np.log(shares()))
    expected = whole.log_likelihood([word, b"abc"]), whole.expected_counts([word, b"abc"], np.array([2.0, 1.0]))
    for size in (1, 7, 64):
        monkeypatch.setattr(lattice, "LONG", size)
        assert np.allclose(whole.log_likelihood([word, b"abc"]), expected[0])
        assert np.allclose(whole.expected_counts([word, b"abc"], np.array([2.0, 1.0])), expected[1])


def test_a_very_long_word_takes_little_memory():
    import tracemalloc

    model = lattice.Lattice(PIECES, np.log(shares()))
    tracemalloc.start()
    value = model.log_likelihood([b"abc" * 100_000])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert np.isfinite(value).all() and peak < 30e6


def test_whole_words_beside_segmentations(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score string")
    learned = F.col("doc_id").isin(1, 2, 3, 6)
    plain = {}
    for whole in (False, True):
        settings = lattice.LatticeSettings(head=3, rounds=1, whole_words=whole)
        plain[whole] = lattice.score_documents(docs, learned, VOCABULARY, settings).collect()
    # Plain code from the segmentations' own likelihood of single words.
    counts = Counter(w for number, text, _ in ROWS if number in (1, 2, 3, 6) for w in (text or "").encode().lower().split())
    total, ends = sum(counts.values()), sum(number in (1, 2, 3, 6) for number, _, _ in ROWS)
    spread = Counter(counts.values())
    discount = spread[1] / (spread[1] + 2 * spread[2]) if spread[1] and spread[2] else 0.5
    pieces, prior = lattice.vocabulary(VOCABULARY)
    sums = prior * 10_000.0 + lattice.Lattice(pieces, np.log(prior)).expected_counts(list(counts), np.array([float(n) for n in counts.values()]))
    end = (ends + 1) / (ends + 1 + sums.sum())
    model = lattice.Lattice(pieces, np.log(sums / sums.sum() * (1 - end)))

    def score(text):
        value = np.log10(end)
        for word in (text or "").encode().lower().split():
            share = np.exp(model.log_likelihood([word])[0]) * discount * len(counts) / total
            value += np.log10(share + (1 - end) * max(0.0, counts[word] - discount) / total)
        return value

    texts = {(number, len((text or "").split())): text for number, text, _ in ROWS}
    for row in plain[True]:
        assert row.score == pytest.approx(score(texts[row.doc_id, row.n_tokens - 1]))
    assert [row[:6] for row in sorted(plain[True], key=str)] == [row[:6] for row in sorted(plain[False], key=str)]


def test_the_head_is_bounded_in_bytes(spark):
    rows = [(b"a" * n, n, 0.0, 0.0) for n in range(1, 40)]
    scored = spark.createDataFrame(rows, "word binary, n long, base double, lattice double")
    for limit in (0, 39, 100, 10_000):
        settings = lattice.LatticeSettings(head=30, head_bytes=limit)
        held = [len(row.word) for row in lattice.frequent_words(scored, settings).collect()]
        assert sum(held) <= limit and len(held) <= 30
        assert held == sorted(held, reverse=True)
