import os
import time

import pytest
from conftest import rows
from lakeloom.sinks.files import write_delimited, write_json
from lakeloom.streaming.ingest import ingest_new_files, ingested


def run(spark, tmp_path, **options):
    paths = [str(tmp_path / name) for name in ("landing", "target", "checkpoint")]
    ingest_new_files(spark, *paths, "id bigint", **options)
    return ingested(spark, paths[1], "id bigint")


def test_each_file_is_taken_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write_json(spark.range(1), landing)
    assert run(spark, tmp_path).count() == 1
    assert run(spark, tmp_path).count() == 1
    write_json(spark.range(1, 3), landing, mode="append")
    assert rows(run(spark, tmp_path)) == [(0,), (1,), (2,)]
    assert run(spark, tmp_path).count() == 3


def test_a_backlog_is_taken_in_batches(spark, tmp_path):
    write_json(spark.range(0, 20, numPartitions=5), str(tmp_path / "landing"))
    assert run(spark, tmp_path, max_files_per_batch=2).count() == 20
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) == 3


def test_delimited_arrivals(spark, tmp_path):
    write_delimited(spark.range(4), str(tmp_path / "landing"))
    assert run(spark, tmp_path, fmt="csv", options={"sep": "|", "header": "true"}).count() == 4


def test_files_of_any_age_arrive(spark, tmp_path):
    landing = tmp_path / "landing"
    write_json(spark.range(1), str(landing))
    assert run(spark, tmp_path).count() == 1
    (landing / "late.json").write_text('{"id": 5}\n')
    old = time.time() - 30 * 24 * 3600
    os.utime(landing / "late.json", (old, old))
    assert rows(run(spark, tmp_path)) == [(0,), (5,)]
    with pytest.raises(ValueError, match="maxfileage"):
        run(spark, tmp_path, options={"maxFileAge": "1d"})


def test_records_that_do_not_parse_fail_or_are_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"id": 1}\nnot json\n{"id": "zz"}\n')
    with pytest.raises(Exception, match="error while reading file .*a.json"):
        run(spark, tmp_path)
    paths = [str(tmp_path / name) for name in ("landing", "kept", "other-checkpoint")]
    schema = "id bigint, _corrupt_record string"
    ingest_new_files(spark, *paths, schema, options={"mode": "PERMISSIVE"})
    assert rows(ingested(spark, paths[1], schema)) == [(1, None), (None, "not json"), (None, '{"id": "zz"}')]


def test_finished_files_are_archived(spark, tmp_path):
    write_json(spark.range(2), str(tmp_path / "landing"))
    for _ in range(3):
        run(spark, tmp_path, archive=str(tmp_path / "archive"))
        write_json(spark.range(1), str(tmp_path / "landing"), mode="append")
    assert list((tmp_path / "archive").rglob("part-*.json"))
    assert run(spark, tmp_path).count() == 5
