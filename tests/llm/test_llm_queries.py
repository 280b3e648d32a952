"""Registered queries against their SQL, and the pipeline against its stages one by one."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import TABLES, canonical

import __spark_entry__ as driver
import corpus_pipeline
from lakeloom.llm import decontaminate, langid, mixing, simhash, toxicity
from lakeloom.llm.common import remainder
from lakeloom.llm.oracle import ORACLE_SQL
from lakeloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def engine(testdata):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{testdata}/{name}.parquet'")
    return connection


def test_all_are_registered():
    assert set(QUERIES) < set(driver.queries()) and "pipeline" in driver.queries()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE_SQL) < set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, engine, testdata, name):
    result = QUERIES[name](spark, testdata)
    cursor = engine.execute(ORACLE_SQL[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    actual = canonical(result.columns, [tuple(row) for row in result.collect()])
    assert actual == canonical(columns, cursor.fetchall())


def odd_conversations():
    turns = [(0, t, role, text) for t, role, text in [(1, "user", "a"), (2, "assistant", "b"), (2, "assistant", "b"), (3, None, "c"), (3, "user", None)]]
    turns += [(1, 1, "user", "a"), (1, 2, "assistant", None), (1, 2, "assistant", "z"), (1, None, "system", "s"), (1, 4, "user", "")]
    turns += [(2, 1, "user", "alone"), (2, 2, "assistant", "no neighbour"), (4, 1, None, None), (None, 1, "user", "x")]
    turns += [(6, t, "assistant" if t % 2 else "user", f"<|t{t}|>") for t in range(40)] + [(7, 39, "assistant", "other")]
    return turns


def test_conversations_with_repeated_rows_and_nulls(spark, tmp_path):
    """The query's SQL says what its docstring says, also where the given tables have no such rows."""
    frame = spark.createDataFrame(odd_conversations(), "conv_id long, turn int, role string, text string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = QUERIES["op4_chat"](spark, str(tmp_path))
    cursor = engine.execute(ORACLE_SQL["op4_chat"])
    columns = [column[0] for column in cursor.description]
    actual = canonical(result.columns, [tuple(row) for row in result.collect()])
    assert actual == canonical(columns, cursor.fetchall()) and len(actual) == 6


def test_pipeline_without_labels_or_languages_drops_nothing_there(spark, testdata, tmp_path):
    docs = spark.read.parquet(f"{testdata}/documents.parquet").limit(40)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 40
    nameless = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.keep_known_languages(spark, nameless, testdata).count() == 40


def test_near_duplicates_of_odd_rows(spark, testdata):
    """Null and repeated ids, a long text, columns with clashing names, and a map, which has no order."""
    schema = "doc_id long, text string, lang string, component_id string, n int, row map<string,int>"
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (None, "one two three four five", "en", "x", 1, {"a": 1}),
        (3, "one two three four five", "en", "x", 1, {"a": 1}),
        (7, "alpha beta gamma delta epsilon", "en", "x", 2, {"b": 2}),
        (7, "alpha beta gamma delta epsilon", "en", "x", 1, {"c": 2, "a": 3}),
        (7, "alpha beta gamma delta epsilon", "en", "x", 1, {"a": 2}),
        (8, "alpha beta gamma delta epsilon", "en", "x", 1, None),
        (9, long_text, "en", "x", 1, {}),
        (10, long_text, "en", "x", 1, {}),
        (11, "something else entirely here now", "en", "x", 1, {}),
    ]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, schema), testdata)
    assert kept.columns == ["doc_id", "text", "lang", "component_id", "n", "row"]
    found = sorted((row.doc_id or 0, row.n, row.row) for row in kept.collect())
    # Which of a null id and 3 stands for a group is the operator's rule; one of them does.
    assert [row for row in found if row[0] > 3] == [(7, 1, {"a": 2}), (9, 1, {}), (11, 1, {})]
    assert len(found) == 4
    nothing = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([], schema), testdata)
    assert nothing.collect() == []


def test_run_is_its_stages_one_after_another(spark, testdata):
    """Each stage by its operator in plain steps: what is kept, then how much the mix takes of it."""
    docs = [row for row in spark.read.parquet(f"{testdata}/documents.parquet").collect()]
    schema = spark.read.parquet(f"{testdata}/documents.parquet").schema
    kept = docs

    def frame():
        return spark.createDataFrame(kept, schema)

    labels = spark.read.parquet(f"{testdata}/labels.parquet").where(remainder("doc_id", 4) != 2)
    weights = toxicity.train(frame(), labels)
    toxic = {row.doc_id for row in toxicity.score(frame(), weights, 0.3).collect() if row.predicted}
    kept = [row for row in kept if row.doc_id not in toxic]
    model = langid.train(frame().where(remainder("doc_id", 5) != 0))
    unknown = {row.doc_id for row in langid.identify(frame(), model).collect() if row.rejected}
    kept = [row for row in kept if row.doc_id not in unknown]
    copies = {row.doc_id for row in simhash.near_duplicates(frame(), shingle=4, distance=4).collect() if row.doc_id != row.component_id}
    kept = [row for row in kept if row.doc_id not in copies]
    bad = decontaminate.contamination(frame(), spark.read.parquet(f"{testdata}/benchmark.parquet"), window=13, share=20)
    bad = {row.doc_id for row in bad.collect() if row.contaminated}
    kept = [row for row in kept if row.doc_id not in bad]
    expected = mixing.taken(mixing.schedule(frame())).collect()
    found = corpus_pipeline.run(spark, testdata).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected)) and len(found) == len(kept) < len(docs)
    assert copies and bad


def test_pipeline_keeps_columns_and_drops_what_stages_reject(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet").limit(60).cache()
    columns = docs.columns
    extra = [(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 0), (9003, "the same text twice over", "en", "s", 0)]
    extra += [(9003, "the same text twice over", "en", "s", 0), (9004, "the same text twice over", "en", "s", 0)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = corpus_pipeline.materialize(stage(spark, kept, testdata), "test-stage")
        assert kept.columns == columns, name
        assert kept.count() <= before
    ids = [row.doc_id for row in kept.select("doc_id").collect()]
    assert ids.count(9003) == 1 and not {9001, 9002, 9004} & set(ids)
    mixed = corpus_pipeline.STAGES[-1][1](spark, kept, testdata).collect()
    assert sorted(row.doc_id for row in mixed) == sorted(ids)


def test_pipeline_of_an_empty_table(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, testdata).collect() == []
