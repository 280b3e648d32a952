from datetime import datetime
from pathlib import Path
from random import Random

import pytest

from conftest import rows
from lakeloom.operators.snapshots import SnapshotTable, latest_states, version_id

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2024, 1, 3)
SCHEMA = "id int, status string, updated_at timestamp_ntz"
PLACED_SHIPPED = [
    (1, "placed", T1, T2),
    (1, "shipped", T2, None),
    (2, "shipped", T1, None),
    (3, "placed", T2, None),
]


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return SnapshotTable(spark, str(tmp_path / "history"), ["id"], "updated_at", schema)


def states(df):
    return rows(df.select("id", "status", "valid_from", "valid_to"))


def apply(table, *given):
    return table.apply(table.spark.createDataFrame(list(given), SCHEMA))


def test_runs_close_changed_rows_and_keep_the_rest(table):
    assert table.history().count() == 0
    assert apply(table, (1, "placed", T1), (2, "shipped", T1)) == 1
    assert states(table.history()) == [(1, "placed", T1, None), (2, "shipped", T1, None)]

    second = [(1, "shipped", T2), (2, "shipped", T1), (3, "placed", T2)]
    assert apply(table, *second) == 2
    assert states(table.history()) == PLACED_SHIPPED
    # The same state again changes nothing.
    apply(table, *second)
    assert states(table.history()) == PLACED_SHIPPED
    # A key that is missing stays open; an older state is not a change.
    apply(table, (1, "shipped", T2), (3, "older", T1))
    assert states(table.history()) == PLACED_SHIPPED

    assert states(table.current()) == [r for r in PLACED_SHIPPED if r[3] is None]
    assert states(table.changed()) == [r for r in PLACED_SHIPPED if r[0] == 1]
    assert table.runs() == [1, 2, 3, 4]


def test_one_row_per_state_id(table):
    apply(table, (1, "a", T1), (2, "a", T1))
    apply(table, (1, "b", T2))
    history = table.history()
    assert history.select("scd_id").distinct().count() == 3
    assert history.filter("scd_updated_at <> valid_from").count() == 0


def test_only_the_latest_state_of_a_batch_counts(spark, table):
    batch = [(1, "a", T1), (1, "c", T3), (1, "b", T2), (2, "x", T1), (2, "y", T1)]
    apply(table, *batch)
    assert states(table.history()) == [(1, "c", T3, None), (2, "y", T1, None)]
    latest = latest_states(spark.createDataFrame(batch, SCHEMA), ["id"], "updated_at")
    assert rows(latest) == [(1, "c", T3), (2, "y", T1)]


def test_what_a_cut_off_run_left_is_not_seen(spark, table):
    apply(table, (1, "a", T1))
    debris = spark.createDataFrame([(9, "lost", T1)], SCHEMA)
    debris.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.root}/run=2/is_open=true"
    )
    assert table.runs() == [1]
    assert states(table.history()) == [(1, "a", T1, None)]
    # Whose it is, is not known, so it is neither overwritten nor deleted unasked.
    with pytest.raises(RuntimeError, match="discard_unfinished"):
        apply(table, (1, "b", T2))
    table.discard_unfinished()
    assert apply(table, (1, "b", T2)) == 2
    assert states(table.history()) == [(1, "a", T1, T2), (1, "b", T2, None)]


def test_runs_sort_by_number(table):
    for day in range(1, 12):
        apply(table, (1, f"s{day}", datetime(2024, 1, day)))
    assert table.runs() == list(range(1, 12))
    history = states(table.history())
    assert len(history) == 11
    assert [r for r in history if r[3] is None] == [(1, "s11", datetime(2024, 1, 11), None)]


def test_other_columns_are_an_error(spark, table):
    with pytest.raises(ValueError, match="columns"):
        table.apply(spark.createDataFrame([(1, T1)], "id int, updated_at timestamp_ntz"))


def test_composite_keys_and_null_times(spark, tmp_path):
    schema = "a int, b string, v int, at timestamp_ntz"
    table = SnapshotTable(
        spark, str(tmp_path / "h"), ["a", "b"], "at", spark.createDataFrame([], schema).schema
    )
    table.apply(spark.createDataFrame([(1, "x", 1, T1), (1, "y", 1, None)], schema))
    table.apply(spark.createDataFrame([(1, "x", 2, T2), (1, "y", 2, T2)], schema))
    assert rows(table.history().select("a", "b", "v", "valid_to")) == [
        (1, "x", 1, T2),
        (1, "x", 2, None),
        # Nothing is later than an unknown time.
        (1, "y", 1, None),
    ]


def test_expiry_keeps_the_history(table):
    for day in range(1, 5):
        apply(table, (1, f"s{day}", datetime(2024, 1, day)), (2, "same", T1))
    before = states(table.history())
    table.expire(keep=2)
    assert states(table.history()) == before
    assert len(list((Path(table.root)).glob("run=*/is_open=true"))) == 2
    apply(table, (1, "s9", datetime(2024, 1, 9)))
    assert len(states(table.history())) == len(before) + 1
    with pytest.raises(ValueError):
        table.expire(keep=0)


def test_random_runs_match_a_simulation(spark, table):
    """Six runs over thirty keys, with late, repeated and tied changes, against plain Python."""
    random = Random(7)
    history = []
    for _ in range(6):
        batch = [
            (random.randrange(30), f"s{random.randrange(4)}", datetime(2024, 1, random.randrange(1, 25)))
            for _ in range(60)
        ]
        latest = {}
        for key, status, at in batch:
            if key not in latest or (at, status) > latest[key]:
                latest[key] = (at, status)
        for key, (at, status) in latest.items():
            known = next((row for row in history if row[0] == key and row[3] is None), None)
            if known is not None and at > known[2]:
                known[3] = at
            if known is None or at > known[2]:
                history.append([key, status, at, None])
        apply(table, *batch)
    assert states(table.history()) == sorted(map(tuple, history), key=lambda r: tuple(map(repr, r)))
    changed = {row[0] for row in history if row[3] is not None}
    assert {r[0] for r in states(table.changed())} == changed


def test_history_is_kept_where_spark_leaves_no_marks(spark, table):
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(name, "false")
    try:
        apply(table, (1, "a", T1))
        apply(table, (1, "b", T2))
    finally:
        conf.unset(name)
    assert table.runs() == [1, 2]
    assert states(table.history()) == [(1, "a", T1, T2), (1, "b", T2, None)]


def test_a_taken_number_is_not_written_over(spark, table):
    apply(table, (1, "a", T1))
    other = Path(table.root) / "_marks" / "taken-2"
    other.touch()
    with pytest.raises(RuntimeError, match="taken"):
        apply(table, (1, "b", T2))
    table.discard_unfinished()
    apply(table, (1, "b", T2))
    assert len(states(table.history())) == 2


def test_a_failed_run_gives_its_number_back(spark, table):
    apply(table, (1, "a", T1))
    with pytest.raises(Exception, match="no good"):
        source = spark.createDataFrame([(1, "b", T2)], table.source_schema)
        table.apply(source.selectExpr("id", "if(id = 1, raise_error('no good'), status) AS status", "updated_at"))
    apply(table, (1, "b", T2))
    assert table.runs() == [1, 2] and len(states(table.history())) == 2


def test_parts_of_composite_keys_stay_apart(spark):
    given = [("a|b", "c", T1), ("a", "b|c", T1), (None, "b", T1), ("", "b", T1)]
    df = spark.createDataFrame(given, "a string, b string, at timestamp_ntz")
    assert df.select(version_id(df, ["a", "b"], "at").alias("id")).distinct().count() == 4


@pytest.fixture
def bucketed(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return SnapshotTable(spark, str(tmp_path / "bucketed"), ["id"], "updated_at", schema, buckets=16)


def files_of(table):
    return {path: path.stat().st_mtime_ns for path in Path(table.root).rglob("*.parquet")}


def test_a_run_rewrites_the_buckets_that_change_and_no_other_file(spark, bucketed):
    start = spark.range(1000).selectExpr("CAST(id AS INT) AS id", "'a' AS status", "timestamp_ntz '2024-01-01' AS updated_at")
    bucketed.apply(start)
    before, first = files_of(bucketed), bucketed.manifest(1)
    assert set(first) == set(range(16)) and set(first.values()) == {1}
    # One key in a hundred changes, all in two buckets; every key is in the source, as in a full extract.
    chosen = [row.id for row in start.where(bucketed.bucket().isin(3, 7)).limit(10).collect()]
    source = start.selectExpr("id", f"if(id IN ({', '.join(map(str, chosen))}), 'b', status) AS status", f"if(id IN ({', '.join(map(str, chosen))}), timestamp_ntz '2024-01-02', updated_at) AS updated_at")
    bucketed.apply(source)
    after, second = files_of(bucketed), bucketed.manifest(2)
    assert {bucket for bucket, run in second.items() if run == 2} <= {3, 7}
    assert {path: after[path] for path in before} == before
    assert {path.parent.name for path in after if path not in before} <= {"bucket=3", "bucket=7"}
    history = bucketed.history()
    assert history.count() == 1010 and history.where("valid_to IS NOT NULL").count() == 10
    assert bucketed.current().count() == 1000 and bucketed.changed().count() == 20
    # Nothing new: nothing is written.
    bucketed.apply(source)
    assert files_of(bucketed) == after and bucketed.manifest(3) == second
    assert bucketed.history().count() == 1010


def test_buckets_give_the_same_history(spark, table, bucketed):
    random = Random(11)
    for _ in range(5):
        batch = [(random.choice([None, *range(40)]), f"s{random.randrange(4)}", datetime(2024, 1, random.randrange(1, 25))) for _ in range(30)]
        batch = [row for row in batch if row[0] is not None]
        apply(table, *batch)
        apply(bucketed, *batch)
    assert states(bucketed.history()) == states(table.history())
    assert states(bucketed.changed()) == states(table.changed())


def test_expiry_keeps_buckets_that_later_runs_carry(bucketed):
    apply(bucketed, *[(i, "a", T1) for i in range(60)])
    for day in range(2, 6):
        apply(bucketed, (1, f"s{day}", datetime(2024, 1, day)))
    before = states(bucketed.history())
    bucketed.expire(keep=1)
    assert states(bucketed.history()) == before
    kept = {(path.parent.parent.name, path.name) for path in Path(bucketed.root).glob("run=*/is_open=true/bucket=*")}
    assert len(kept) == len(bucketed.manifest(5)) and len([k for k in kept if k[0] == "run=5"]) == 1


def test_another_number_of_buckets_is_an_error(spark, bucketed):
    apply(bucketed, (1, "a", T1))
    other = SnapshotTable(spark, bucketed.root, ["id"], "updated_at", bucketed.source_schema, buckets=4)
    with pytest.raises(ValueError, match="buckets 16"):
        other.history()
