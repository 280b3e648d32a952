import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import pii
from lakeloom.llm.queries import op13_personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = ["a", "b.c", "@", "@", "x.com", ".", "-", " ", "1", "23", "255", "256", "0001", ".1", ".2.3", "+1", "+", "(555)", " 555-", "_", "%", "\n", "é", "٣"]
PIECES += ["4111111111111111", "4111 1111 1111 1111", "12-", "0", "9", "ab at c.de", "[at]", " dot "]


def passes(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in span.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [
        (k, *match.span())
        for k, kind in enumerate(pii.KINDS)
        for match in re.finditer(PLAIN[kind], text)
        if passes(kind, match.group())
    ]


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_follow_the_patterns(seed):
    rnd = random.Random(seed)
    for _ in range(4000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 24)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_stay_and_loose_ones_touch_none():
    rnd = random.Random(7)
    for _ in range(4000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 24)))
        found = pii.candidates(text)
        base = [(kind, a, b) for kind, a, b, own in found if own]
        loose = sorted((a, b) for _, a, b, own in found if not own)
        assert base == plain_spans(text)
        assert all(b <= c or d <= a for a, b in loose for _, c, d in base)
        assert all(b <= c for (_, b), (c, _) in zip(loose, loose[1:], strict=False))
        for kind, a, b, own in found:
            assert 0 <= pii.code_of(pii.votes(text, kind, a, b, own), pii.shape(text, kind, a, b)) < 3**5 << 8


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "+1 ", "1 ", "a at b ", "(at)", "1111 ", "ffff:", "é"])
def test_long_unspaced_texts_take_linear_time(unit):
    pii.candidates(unit * (400_000 // len(unit)))


def test_expectation_maximisation_finds_the_reliabilities():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.8, 0.9, 0.7, 0.6])
    agrees = rng.random((len(truth), 5)) < right
    given = np.where(agrees == truth[:, None], pii.YES, pii.NO)
    rows, counts = np.unique(given, axis=0, return_counts=True)
    chance, tables, share = pii.expect_maximise(rows, counts.astype(float))
    assert share == pytest.approx(0.3, abs=0.02)
    assert np.allclose(tables[1][:, pii.YES], right, atol=0.03) and np.allclose(tables[0][:, pii.NO], right, atol=0.03)
    # Bayes' rule with the true reliabilities, as plain code.
    def odds(row):
        return np.log(0.3 / 0.7) + sum(np.log(r / (1 - r)) * (1 if v == pii.YES else -1) for r, v in zip(right, row, strict=True))

    assert np.abs(chance - [1 / (1 + np.exp(-odds(row))) for row in rows]).max() < 0.1


def test_no_candidates_give_a_model():
    empty = np.zeros(0)
    chance, _, share = pii.expect_maximise(np.zeros((0, 5), int), empty)
    assert len(chance) == 0 and share == 0.5
    assert not pii.fit_logistic(pii.inputs_of(np.zeros(0, np.int64)), empty, empty).any()


def luhn_number(rnd):
    body = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if passes("card", body + d))


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts with planted spans: plain ones, loose ones to be added, and decoys to be left alone."""
    rnd = random.Random(4)
    rows, wanted, decoys = [], {}, {}
    for i in range(400):
        name = "".join(rnd.choice("abcdefgh") for _ in range(6))
        number = f"{rnd.randint(200, 999)}-{rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"
        card = luhn_number(rnd)
        wrong = card[:-1] + str((int(card[-1]) + 5) % 10)
        dots = ".".join(card[k : k + 4] for k in (0, 4, 8, 12))
        kinds = [
            (f"mail {name}.x@post.example.com", None, None),
            (f"call +1 {number}", None, None),
            (f"from {rnd.randint(11, 99)}.{rnd.randint(1, 250)}.7.9", None, None),
            (f"card {card}", None, None),
            (f"email {name} [at] post [dot] com", f"{name} [at] post [dot] com", None),
            (f"phone {number}", number, None),
            (f"visa {dots}", dots, None),
            (f"order {wrong}", None, wrong),
            (f"look at me.now token={wrong[:13]}x", None, wrong[:13]),
            ("plain words, 3 or 4 of them, version 2.0", None, None),
        ]
        text, add, leave = kinds[i % len(kinds)]
        text = f"some words {text} and more"
        rows.append((i, text))
        if add:
            wanted[i] = (text.index(add), text.index(add) + len(add))
        if leave:
            decoys[i] = leave
    return spark.createDataFrame(rows, "doc_id long, text string"), wanted, decoys


def test_the_method_adds_loose_spans_and_leaves_decoys(corpus):
    docs, wanted, decoys = corpus
    found = {row.doc_id: row.spans for row in pii.find_personal_data(docs).collect()}
    added = {i: [(s.start, s.end) for s in spans if not s.base] for i, spans in found.items()}
    assert np.mean([span in added[i] for i, span in wanted.items()]) > 0.95
    assert not [i for i in decoys if added[i]]
    assert not [i for i, spans in added.items() if spans and i not in wanted]


def test_odd_rows(spark, corpus):
    rows = [(None, "mail a@b.com"), (1, None), (2, ""), (3, "x" * 300_000 + " a@b.com"), (3, "é 10.20.30.40"), (3, "é 10.20.30.40")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x")).withColumn("kind", F.lit(1))
    found = pii.find_personal_data(docs)
    assert found.columns == ["doc_id", "spans"]
    got = sorted(((row.doc_id or 0), [(s.kind, s.start, s.end) for s in row.spans]) for row in found.collect())
    ip, far = [("ip", 2, 13)], [("email", 300_001, 300_008)]
    assert got == sorted([(0, [("email", 5, 12)]), (1, []), (2, []), (3, far), (3, ip), (3, ip)])
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_query_against_plain_code(spark, testdata):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    found = {row.doc_id: row for row in op13_personal_data(spark, testdata).collect()}
    assert sorted(found) == sorted(texts)
    for doc_id, text in texts.items():
        spans = plain_spans(text)
        row, listed = found[doc_id], [f"{pii.KINDS[kind]}:{a}:{b}" for kind, a, b in spans]
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for k, _, _ in spans) for i in range(4)]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(","))
