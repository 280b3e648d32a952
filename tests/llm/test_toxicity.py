import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import toxicity
from lakeloom.llm.common import binary_values, text_slices, unambiguous_labels
from lakeloom.llm.wordhash import WordHasher, mixed

SETTINGS = toxicity.FtrlSettings(bits=14, shards=2, l1=0.5, rounds=6)


def corpus(n=240):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        words = [f"w{k}" for k in rng.integers(0, 60, 20)]
        if i % 4 == 0:
            words[rng.integers(0, 20)] = "vile"
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_words_are_hashed_by_content_alone():
    texts = [b"", b"one two", b"TWO, one!", "à b".encode(), b"  "]
    words, owner = WordHasher()(texts)
    assert owner.tolist() == [1, 1, 2, 2, 3, 3]
    assert words[0] == words[3] and words[1] == words[2] and len(set(words.tolist())) == 4


def test_features_do_not_depend_on_slices():
    texts = [f"word{i} next{i % 3} one two".encode() for i in range(50)]
    whole = toxicity.features(texts, 20, WordHasher())
    runs = list(text_slices(pa.array([text.decode() for text in texts]), 100))
    parts = [toxicity.features(list(binary_values(part)), 20, WordHasher()) for _, _, part in runs]
    shift = [a for a, _, _ in runs]
    assert np.array_equal(whole[0], np.concatenate([own + at for (own, _), at in zip(parts, shift, strict=True)]))
    assert np.array_equal(whole[1], np.concatenate([feature for _, feature in parts]))


def test_features_count_once_per_text_and_stay_inside_it():
    owner, feature = toxicity.features([b"a b", b"c", b"a b a b"], 20, WordHasher())
    per_text = [set(feature[owner == i].tolist()) for i in range(3)]
    assert [len(part) for part in per_text] == [3, 1, 8]
    assert per_text[0] < per_text[2] and not per_text[1] & per_text[0]


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, toxic int")
    return docs, labels, toxicity.train(docs, labels, SETTINGS)


def test_held_out_documents_are_told_apart(learned):
    docs, _, weights = learned
    scored = toxicity.score(docs, weights, 0.3).where("doc_id % 5 = 0").collect()
    assert np.mean([row.predicted == int(row.doc_id % 4 == 0) for row in scored]) > 0.9
    assert np.count_nonzero(weights) < 400


def test_training_again_gives_the_same_weights(learned):
    docs, labels, weights = learned
    assert np.allclose(toxicity.train(docs.repartition(3), labels, SETTINGS), weights, atol=1e-9)


def test_odd_rows_have_a_score(spark, learned):
    rows = [(None, "vile"), (1, None), (2, ""), (3, "vile " * 50_000), (3, "vile " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    found = {(row.doc_id, round(row.score, 9)): row for row in toxicity.score(docs, learned[2]).collect()}
    bias = round(float(0.5 * (1 + np.tanh(learned[2][-1] / 2))), 9)
    assert (1, bias) in found and (2, bias) in found and len(found) == 4


def test_without_labels_every_score_is_a_half(spark, learned):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert unambiguous_labels(none, "toxic").count() == 0
    weights = toxicity.train(learned[0], none, SETTINGS)
    assert {row.score for row in toxicity.score(learned[0], weights).collect()} == {0.5}
    assert toxicity.score(learned[0].limit(0), weights).collect() == []


def plain_features(text, bits):
    """Hashed words, pairs, triples and pairs with a gap, one set per text."""
    words = [int(word) for word in WordHasher()([text.encode()])[0]]

    def place(value):
        return int(mixed(np.array([value & (1 << 64) - 1], np.uint64))[0]) >> (64 - bits)

    found = {place(w * toxicity.UNIGRAM) for w in words}
    found |= {place(a * toxicity.BIGRAM + b) for a, b in zip(words, words[1:], strict=False)}
    found |= {place((a * toxicity.TRIGRAM + b) * toxicity.TRIGRAM + c) for a, b, c in zip(words, words[1:], words[2:], strict=False)}
    return found | {place(a * toxicity.SKIP + c) for a, c in zip(words, words[2:], strict=False)}


def plain_ftrl(rows, s, number, z, n):
    """One pass of FTRL-proximal, coordinate by coordinate."""
    z, n = dict(z), dict(n)

    def weight(k):
        size, own = n.get(k, 0.0), z.get(k, 0.0)
        rate = (s.beta + size**0.5) / s.alpha + s.l2
        if k == "bias":
            return -own / rate
        return 0.0 if abs(own) <= s.l1 else ((1 if own > 0 else -1) * s.l1 - own) / rate

    for i in np.random.default_rng(number).permutation(len(rows)):
        places, label = rows[i]
        weights = {k: weight(k) for k in [*places, "bias"]}
        slope = 1 / (1 + math.exp(-sum(weights.values()))) - label
        for k, w in weights.items():
            size = n.get(k, 0.0)
            z[k] = z.get(k, 0.0) + slope - ((size + slope * slope) ** 0.5 - size**0.5) / s.alpha * w
            n[k] = size + slope * slope
    return z, n


def test_training_is_plain_ftrl_averaged_over_shards(spark, learned):
    docs, labels, weights = learned
    s = SETTINGS
    shard_of = {row.id: row.shard for row in spark.range(300).selectExpr("id", f"pmod(xxhash64(id, 1), {s.shards}) AS shard").collect()}
    shards = {}
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in sorted(labels.collect()):
        shards.setdefault(shard_of[row.doc_id], []).append((plain_features(texts[row.doc_id], s.bits), row.toxic))
    z, n = {}, {}
    for number in range(s.rounds):
        states = [plain_ftrl(rows, s, number, z, n) for rows in shards.values()]
        z, n = ({k: sum(state[i].get(k, 0.0) for state in states) / len(states) for k in {k for state in states for k in state[i]}} for i in (0, 1))
    expected = np.zeros(len(weights))
    for k, own in z.items():
        rate = (s.beta + n[k] ** 0.5) / s.alpha + s.l2
        if k == "bias":
            expected[-1] = -own / rate
        elif abs(own) > s.l1:
            expected[k] = ((1 if own > 0 else -1) * s.l1 - own) / rate
    # States travel at single precision.
    assert np.allclose(weights, expected, atol=1e-3)
    scored = {row.doc_id: row.score for row in toxicity.score(docs, weights).collect()}
    for i, text in texts.items():
        total = sum(weights[k] for k in plain_features(text, s.bits)) + weights[-1]
        assert scored[i] == pytest.approx(1 / (1 + math.exp(-total)))


def test_a_shard_is_streamed_in_many_batches(spark, learned):
    """The state goes on from batch to batch and the rounds tell labels apart all the same."""
    docs, labels, _ = learned
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        weights = toxicity.train(docs, labels, SETTINGS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    scored = toxicity.score(docs, weights, 0.3).where("doc_id % 5 = 0").collect()
    assert np.mean([row.predicted == int(row.doc_id % 4 == 0) for row in scored]) > 0.9
