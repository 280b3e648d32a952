from fractions import Fraction

import pytest
from conftest import plan

from lakeloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, taken string"


def words(n):
    return " ".join(["w"] * n)


def plain_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2)):
    """Share out, stop at twice the size, share again what is over."""
    names = sorted((name for name in sizes if name is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {name: weights[i % 3] for i, name in enumerate(names)}
    left, targets, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[name] for name in open_)
        over = {name for name in open_ if left * weight[name] / total > 2 * sizes[name]}
        if not over:
            return targets | {name: left * weight[name] / total for name in open_}
        for name in over:
            targets[name] = Fraction(2 * sizes[name])
            left -= targets[name]
        open_ -= over
    return targets


SIZES = {"a": [40, 1, 9, 0], "B": [500, 3], "é": [7], None: [30, 30], "c": [1] * 60, "": [0, 0], "zz": [2]}


@pytest.fixture(scope="module")
def mixed(spark):
    rows, number = [], 0
    for source, sizes in SIZES.items():
        for size in sizes:
            rows.append((number, words(size) if size else None if number % 2 else " \n", source, "x"))
            number += 1
    rows += [(900, words(5), "a", "x"), (900, words(5), "a", "x"), (None, words(4), "a", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs, rows, mixing.taken(mixing.schedule(docs)).collect()


def test_targets_and_taken_words(mixed):
    _, rows, found = mixed
    assert len(found) == len(rows)
    sizes = {source: 0 for source in SIZES}
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    targets = plain_targets(sizes)
    by_size = {row.doc_id: row for row in found}
    for number, text, source, _ in rows:
        row = by_size[number]
        assert row.size == len((text or "").split()) and row.source_size == sizes[source]
        assert row.target == pytest.approx(float(targets[source]))
        assert row.taken <= 2 * row.size
    source_of = {number: source for number, _, source, _ in rows}
    for source in sizes:
        taken = sum(row.taken for row in found if source_of[row.doc_id] == source)
        assert taken == int(float(targets[source]) + 1e-9)


def test_reruns_and_other_orders_agree(mixed):
    docs, _, found = mixed
    again = mixing.taken(mixing.schedule(docs.repartition(5))).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)


def test_slots_hold_sources_in_their_shares_everywhere(spark):
    rows = [(i, words(20), "abc"[i % 3], "") for i in range(300)]
    pieces = mixing.schedule(spark.createDataFrame(rows, SCHEMA), mixing.MixSettings(slot_bits=8)).where("slot is not null")
    slots = sorted({(row.slot, row.key) for row in pieces.collect()})
    names = [key for _, key in slots]
    for start in range(0, len(names) - 64, 16):
        part = names[start : start + 64]
        assert abs(part.count("0a") / 64 - names.count("0a") / len(names)) < 0.1


def test_empty_tables_and_tables_without_words(spark):
    docs = spark.createDataFrame([(1, None, None, ""), (2, " ", "a", "")], SCHEMA)
    found = mixing.taken(mixing.schedule(docs)).collect()
    assert sorted((row.doc_id, row.size, row.target, row.taken) for row in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixing.taken(mixing.schedule(docs.limit(0))).collect() == []


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b", "a", "")], SCHEMA)
    text = plan(mixing.taken(mixing.schedule(docs)))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


def test_rows_of_no_id_and_equal_rows_are_spread(spark):
    """Two thirds of the rows have no id: they are sorted in many buckets, and equal rows travel as one."""
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, id, NULL) AS doc_id",
        "if(id % 3 = 1, 'same text here', concat('w ', id)) AS text",
        "'s' AS source",
    )
    pieces = mixing.schedule(rows)
    found = mixing.taken(pieces).collect()
    assert len(found) == 3000
    assert sum(row.taken for row in found) == pytest.approx(1.5 * (1000 * 3 + 2000 * 2), abs=3)
    assert all(row.taken <= 2 * row.size for row in found)
    buckets = pieces.select("key", "bucket", "row", "copy", "doc_id").distinct().collect()
    per_bucket = {}
    for row in buckets:
        per_bucket.setdefault(row.bucket, set()).add(row.row)
    assert max(map(len, per_bucket.values())) < 40
    again = mixing.taken(mixing.schedule(rows.repartition(7))).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
