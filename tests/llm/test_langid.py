import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from lakeloom.llm import langid

ENGLISH = "the house that was there and with this water from other people which would have been said about them".split()
GERMAN = "das Haus und die Strasse nicht aber über schön wenn auch wieder nach einem größeren zwischen".split()


class PlainKneserNey:
    """Plain code: probabilities of one language's grams, and the back-off weight of each context.

    The highest order uses counts; the others use the number of different characters seen before a
    gram, or its count where it starts at a word's boundary. One discount per order, n1 / (n1 + 2 n2).
    """

    def __init__(self, levels: list[dict[str, int]], alphabet: int):
        self.uniform = 1.0 / alphabet
        self.probs: dict[str, float] = {}
        self.weights: dict[str, float] = {}
        for k, level in enumerate(levels):
            if k + 1 < len(levels):
                before = Counter(gram[1:] for gram in levels[k + 1])
                level = {gram: before[gram] or n for gram, n in level.items()}
            spread = Counter(level.values())
            discount = spread[1] / (spread[1] + 2 * spread[2]) if spread[1] and spread[2] else 0.5
            total: Counter = Counter()
            kinds: Counter = Counter()
            for gram, n in level.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            self.weights |= {context: discount * kinds[context] / total[context] for context in total}
            self.probs |= {
                gram: (n - discount) / total[gram[:-1]] + self.weights[gram[:-1]] * self.prob(gram[1:])
                for gram, n in level.items()
            }

    def prob(self, gram: str) -> float:
        if not gram:
            return self.uniform
        known = self.probs.get(gram)
        return self.weights.get(gram[:-1], 1.0) * self.prob(gram[1:]) if known is None else known


def corpus(n=120):
    rng = np.random.default_rng(1)
    return [
        (i, " ".join(rng.choice(ENGLISH if i % 3 else GERMAN, 15)), "en" if i % 3 else "de") for i in range(n)
    ]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    return langid.train(docs.where("doc_id % 7 <> 0"), order=4)


def test_held_out_texts(spark, model):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string").where("doc_id % 7 = 0")
    found = {row.doc_id: row for row in langid.identify(docs, model).collect()}
    assert all(found[row.doc_id].lang_pred == row.lang for row in docs.collect())
    assert not any(row.rejected for row in found.values())


def test_probabilities_of_each_context_sum_to_one():
    words = ["abca", "abd", "b", "aab"]
    grams: dict[str, int] = {}
    for word in words:
        padded = f"\n{word}\n"
        for end in range(2, len(padded) + 1):
            for start in range(max(0, end - 3), end):
                grams[padded[start:end]] = grams.get(padded[start:end], 0) + 1
    levels = [{g: n for g, n in grams.items() if len(g) == k} for k in (1, 2, 3)]
    part = PlainKneserNey(levels, alphabet=6)
    # Five characters were seen; the sixth stands for all others.
    for context in ("", "a", "ab", "\n", "\nb", "zz", "za"):
        assert sum(part.prob(context + c) for c in "abcd\nz") == pytest.approx(1.0)


def test_arrays_agree_with_plain_back_off(spark):
    rows = [("en", "the"), ("en", "then"), ("en", "a😀b"), ("de", "der"), ("de", "den"), ("de", "den")]
    counts: dict[tuple[str, str], int] = {}
    for lang, word in rows:
        padded = f"\n{word}\n"
        for end in range(2, len(padded) + 1):
            for start in range(max(0, end - 4), end):
                counts[lang, padded[start:end]] = counts.get((lang, padded[start:end]), 0) + 1
    table = spark.createDataFrame([(lang, gram, n) for (lang, gram), n in counts.items()], "lang string, gram string, n long")
    model = langid.estimate(table, ["de", "en"], 4, 1 << 20)
    with pytest.raises(ValueError, match="max_bytes"):
        langid.estimate(table, ["de", "en"], 4, 100)
    alphabet = len({gram for _, gram in counts if len(gram) == 1}) + 1
    for i, lang in enumerate(model.languages):
        levels = [{g: n for (own, g), n in counts.items() if own == lang and len(g) == k} for k in (1, 2, 3, 4)]
        part = PlainKneserNey(levels, alphabet)
        for word in ("the", "dent", "xyz", "é", "d", "a😀", "den"):
            padded = f"\n{word}\n"
            expected = sum(np.log(part.prob(padded[max(0, end - 3) : end + 1])) for end in range(1, len(padded)))
            assert model.words([word, "z"])[0, i] == pytest.approx(expected)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (None, "das Haus"), (4, "the " * 40_000), (4, "the " * 40_000), (5, "x" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = langid.identify(docs.selectExpr("*", "'q' AS lang_pred"), model).collect()
    assert sorted((row.doc_id or 0, row.lang_pred) for row in found)[:4] == [(0, "de"), (1, "und"), (2, "und"), (3, "und")]
    assert [row.lang_pred for row in found if row.doc_id == 4] == ["en", "en"]
    assert all(0 <= row.score <= 1 for row in found)
    assert all(row.rejected and row.score == 0 for row in found if row.lang_pred == "und")
    assert langid.identify(docs.limit(0), model).collect() == []


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    for rows in (docs, docs.limit(0)):
        model = langid.train(rows)
        assert [row.lang_pred for row in langid.identify(docs, model).collect()] == ["und"] * 3


def test_too_many_languages_are_an_error(spark):
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        langid.train(docs, max_languages=3)


def test_numerals_are_no_letters(spark, model):
    assert langid.words_of("½ ² Ⅷ x² ab½cd 12 e٣") == ["x", "ab", "cd", "e"] and langid.words_of(None) == []
    docs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "① ٣")], "doc_id long, text string")
    assert {row.lang_pred for row in langid.identify(docs, model).collect()} == {"und"}


def test_decisions_and_calibration_against_plain_code(spark, model):
    """Cross-entropies by the model's words, then score, limit and choice spelled out."""
    rows = [(i, text) for i, text, _ in corpus()] + [(500, "zzz qqq xxx jjj"), (501, "über the"), (502, "1 2"), (503, None)]
    found = {row.doc_id: row for row in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        words = langid.words_of(text)
        if not words:
            assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
            continue
        chars = sum(len(word) + 1 for word in words)
        entropy = -sum(model.words([word, "z"])[0] for word in words) / chars
        best = int(entropy.argmin())
        score = 1 / sum(np.exp(-model.scale * (e - entropy[best])) for e in entropy)
        far = (entropy[best] - model.centre[best]) * np.sqrt(min(chars, langid.SETTLED)) > model.limit[best]
        assert found[i].lang_pred == model.languages[best] and found[i].rejected == far
        assert found[i].score == pytest.approx(score)


def test_limits_are_twice_the_largest_deviation():
    model = langid.LanguageModel(["a", "b"])
    truth, chars = np.array([0, 0, 1]), np.array([100, 900, 50])
    entropy = np.array([[1.0, 3.0], [1.4, 2.0], [4.0, 2.0]])
    langid.calibrate(model, truth, entropy, chars)
    assert model.centre.tolist() == [1.2, 2.0]
    assert model.limit[0] == pytest.approx(2 * 0.2 * 20) and model.limit[1] == pytest.approx(2e-9)


def test_executors_need_not_have_the_package(spark, tmp_path):
    """The driver finds the package by a path set in its own process, which workers do not inherit."""
    program = """
import sys
sys.path.insert(0, sys.argv[1])
from lakeloom import get_session
from lakeloom.llm import langid
spark = get_session("alone", master="local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2", spark__sql__warehouse__dir=sys.argv[2])
docs = spark.createDataFrame([(i, t, l) for i in range(20) for t, l in (("the house", "en"), ("das Haus", "de"))], "doc_id long, text string, lang string")
model = langid.train(docs, order=3)
print(sorted({row.lang_pred for row in langid.identify(docs, model).collect()}))
"""
    root = str(Path(__file__).resolve().parents[2])
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", program, root, str(tmp_path / "wh")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("['de', 'en']"), done.stderr[-2000:]
