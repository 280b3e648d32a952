from itertools import combinations

import numpy as np
import pytest
import xxhash

from lakeloom.llm import simhash
from lakeloom.llm.components import connected_components


def plain_fingerprint(text, size=4):
    words = text.lower().split()
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(words, distance):
    labels = list(range(len(words)))
    for i, a in enumerate(words):
        for j, b in enumerate(words[:i]):
            if bin(int(a) ^ int(b)).count("1") <= distance and labels[i] != labels[j]:
                low, high = sorted((labels[i], labels[j]))
                labels = [low if label == high else label for label in labels]
    return labels


def noisy(seed, centres, n, flips):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, 1 << 63, centres, dtype=np.uint64)[rng.integers(0, centres, n)]
    for _ in range(flips):
        words = words ^ np.left_shift(np.uint64(1), rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(words)


TEXTS = [b"", b"  \t\n", b"one", b"One TWO three", b"a b c d", b"a b c d e a b c d e", "Été à la mer été".encode(), b"x\x0by\x0cz w v u " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_follows_the_definition(text):
    assert simhash.fingerprint(text, 4) == plain_fingerprint(text)


def test_white_space_beyond_ascii_is_part_of_words():
    assert simhash.fingerprint("a b c d e".encode(), 4) == plain_fingerprint("a b c d e".encode())


@pytest.mark.parametrize(("centres", "n", "flips"), [(1, 1, 0), (1, 40, 2), (3, 300, 3), (20, 400, 4), (1, 250, 5)])
def test_tree_links_what_comparison_links(centres, n, flips):
    words = noisy(n, centres, n, flips)
    rank = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    words = words[np.argsort(rank)]
    labels = simhash.linked(words, None, 4).tolist()
    expected = plain_groups(words, 4)
    assert len(set(zip(labels, expected, strict=True))) == len(set(labels)) == len(set(expected))


def test_groups_of_many_chunks_are_compared_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    words = noisy(7, 6, 220, 4)
    frame = spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "fp long")
    found = connected_components(simhash.links(frame, 4)).collect()
    labels = {row.node: row.component for row in found}
    got = [labels.get(int(x), int(x)) for x in words.view(np.int64)]
    expected = plain_groups(words, 4)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_any_choice_of_segments_finds_the_same_groups(spark, k):
    words = noisy(k, 8, 200, 4)
    frame = spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "fp long")
    plan = list(combinations(simhash.segments(4 + k), k))
    labels = {row.node: row.component for row in connected_components(simhash.links(frame, 4, plan)).collect()}
    got = [labels.get(int(x), int(x)) for x in words.view(np.int64)]
    expected = plain_groups(words, 4)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def test_more_fingerprints_get_more_bits():
    sizes = [sum(width for _, width in simhash.key_plan(4, n)[0]) for n in (10, 10**5, 10**7, 10**9, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] in (12, 13) and sizes[2] >= 21 and sizes[-1] >= 27
    for n in (10, 10**7, 10**12):
        for distance in (0, 1, 4, 8):
            plan = simhash.key_plan(distance, n)
            assert all(sum(width for _, width in chosen) <= 42 or len(plan[0]) == 1 for chosen in plan)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    frame = spark.createDataFrame(path + star, "a long, b long")
    labels = {row.node: row.component for row in connected_components(frame).collect()}
    assert {labels[i] for i in range(41)} == {0}
    assert {labels[i] for i in range(100, 140)} == {100}


def test_near_duplicates_of_odd_rows(spark):
    rows = [
        (5, None, "x"),
        (4, "", "y"),
        (9, " \n", None),
        (7, "the cat sat on the mat today", "z"),
        (3, "The CAT sat on\tthe mat today", "z"),
        (3, "The CAT sat on\tthe mat today", "z"),
        (None, "quite another text of some more words here", "z"),
        (8, "single", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    zero = "0" * 16
    same = f"{plain_fingerprint(rows[3][1].encode()):016x}"
    expected = [(5, zero, 4), (4, zero, 4), (9, zero, 4), (7, same, 3), (3, same, 3), (3, same, 3)]
    expected += [(None, f"{plain_fingerprint(rows[6][1].encode()):016x}", None)]
    expected += [(8, f"{plain_fingerprint(b'single'):016x}", 8)]
    assert found == sorted(expected, key=str)


def test_no_documents(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
