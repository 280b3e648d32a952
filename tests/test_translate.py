from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from lakeloom.operators.translate import compact_store, translate_column, translate_in_batches


def stub():
    def factory():
        return lambda texts: [f"[en] {text}" for text in texts]

    return factory


def logging_stub(folder):
    """Writes one file per call, one line per text."""

    def factory():
        import uuid

        def translate(texts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.writelines(text + "\n" for text in texts)
            return [text.upper() for text in texts]

        return translate

    return factory


def calls(folder):
    return sorted(line for file in folder.iterdir() for line in file.read_text().split())


@pytest.mark.parametrize("operator", [translate_column, translate_in_batches])
def test_translation_keeps_rows_and_nulls(spark, operator):
    df = spark.createDataFrame(
        [(1, "uno"), (2, None), (3, "dos"), (4, "uno"), (5, ""), (6, None)], "id int, t string"
    )
    result = operator(df, "t", "en", stub())
    assert result.columns == ["id", "t", "en"]
    assert rows(result) == [
        (1, "uno", "[en] uno"),
        (2, None, None),
        (3, "dos", "[en] dos"),
        (4, "uno", "[en] uno"),
        (5, "", "[en] "),
        (6, None, None),
    ]


def test_each_distinct_text_is_translated_once(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('t', id % 5) AS t")
    result = translate_column(df, "t", "en", logging_stub(str(tmp_path)), tasks=3)
    assert result.filter("en = upper(t)").count() == 1000
    assert calls(tmp_path) == ["t0", "t1", "t2", "t3", "t4"]


def test_a_store_keeps_translations(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, t string")
    first = translate_column(df, "t", "en", logging_stub(str(log)), store=store)
    expected = [(1, "a", "A"), (2, "b", "B"), (3, "a", "A"), (4, None, None)]
    # Several actions, one call per text.
    assert rows(first) == rows(first) == expected
    assert calls(log) == ["a", "b"]
    # Only the new text is translated; the name of the output does not matter.
    more = df.unionByName(spark.createDataFrame([(5, "c")], "id int, t string"))
    second = translate_column(more, "t", "english", logging_stub(str(log)), store=store)
    assert rows(second) == [*expected, (5, "c", "C")]
    assert calls(log) == ["a", "b", "c"]
    # Its size is known, so the rows are joined where they are.
    assert "Exchange hashpartitioning" not in plan(second)


def test_batches_share_calls(spark, tmp_path):
    df = spark.createDataFrame([("spital",)] * 5, "t string").coalesce(1)
    assert translate_in_batches(df, "t", "en", logging_stub(str(tmp_path))).count() == 5
    assert calls(tmp_path) == ["spital"]


@pytest.mark.parametrize("operator", [translate_column, translate_in_batches])
def test_a_call_gets_a_bounded_part_of_a_batch(spark, tmp_path, operator):
    # 12 texts, 8 of 300 KB and 4 of 1.2 MB, each twice, and a null, in one batch.
    text = "rpad(concat(id % 12, ':é'), if(id % 3 = 0, 1200000, 300000), 'x')"
    df = spark.range(25).selectExpr("id", f"if(id = 24, null, {text}) AS t").coalesce(1)
    result = operator(df, "t", "en", logging_stub(str(tmp_path)))
    measured = result.selectExpr("id", "upper(t) <=> en AS same", "length(en) AS size").collect()
    assert sorted((row["id"], row["same"], row["size"]) for row in measured) == [
        (i, True, 1200000 if i % 3 == 0 else 300000) for i in range(24)
    ] + [(24, True, None)]
    # No call gets more than 1 MB, but for a single text that is longer.
    found = [file.read_text().split() for file in tmp_path.iterdir()]
    assert sorted(text.split(":")[0] for texts in found for text in texts) == sorted(map(str, range(12)))
    assert all(len(texts) == 1 or sum(len(text.encode()) for text in texts) <= 1 << 20 for texts in found)
    assert any(len(texts) > 1 for texts in found)


def test_a_failing_call_is_tried_again(spark):
    def factory():
        failures = []

        def translate(texts):
            if not failures:
                failures.append(1)
                raise ConnectionError
            return texts

        return translate

    df = spark.createDataFrame([("a",)], "t string")
    assert translate_column(df, "t", "en", factory, retry_wait=0.0).first()["en"] == "a"


def test_a_short_answer_is_an_error(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    with pytest.raises(Exception, match="translations"):
        translate_in_batches(df, "t", "en", lambda: lambda texts: texts[:-1]).collect()


def test_empty_input(spark):
    df = spark.createDataFrame([], "t string")
    assert translate_column(df, "t", "en", stub()).count() == 0
    assert translate_in_batches(df, "t", "en", stub()).count() == 0


def test_the_join_carries_digests(spark, testdata):
    df = spark.read.parquet(f"{testdata}/documents.parquet")
    text = plan(translate_column(df, "text", "en", stub()).select("doc_id", "en"))
    assert "sha2" in text and "MapInArrow" in text
    # Other columns are not read.
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_a_store_with_a_text_twice_multiplies_no_row(spark, tmp_path):
    """Two runs that start together both translate a text; each writes a folder of its own."""
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, t string")
    digest = F.sha2(F.lit("a"), 256).alias("_digest")
    for result in ("A2", "A1"):
        spark.range(1).select(digest, F.lit(result).alias("_result")).write.parquet(f"{store}/run={result}")
    log = tmp_path / "log"
    log.mkdir()
    for _ in range(2):
        found = translate_column(df, "t", "en", logging_stub(str(log)), store=store)
        assert rows(found) == [(1, "a", "A1"), (2, "a", "A1"), (3, "b", "B")]
    assert calls(log) == ["b"]
    compact_store(spark, store)
    assert len(list((tmp_path / "store").glob("run=*"))) == 1
    assert rows(translate_column(df, "t", "en", logging_stub(str(log)), store=store)) == rows(found)
    assert calls(log) == ["b"]


def test_two_runs_at_a_time(spark, tmp_path):
    store, log = str(tmp_path / "store"), tmp_path / "log"
    log.mkdir()
    df = spark.range(40).selectExpr("id", "concat('t', id % 10) AS t")
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(translate_column, df, "t", "en", logging_stub(str(log)), store) for _ in range(2)]
        frames = [run.result() for run in runs]
    for frame in (*frames, translate_column(df, "t", "en", logging_stub(str(log)), store)):
        assert rows(frame) == [(i, f"t{i % 10}", f"T{i % 10}") for i in sorted(range(40), key=repr)]
