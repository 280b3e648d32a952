import pytest

from conftest import rows
from lakeloom.sinks.files import write_json
from lakeloom.streaming.ledger import LedgerIngest


@pytest.fixture
def ingest(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("landing", "target", "ledger")]
    return LedgerIngest(spark, *paths, "id bigint", max_files_per_batch=2)


def test_each_file_is_taken_once(spark, ingest):
    assert ingest.run() == 0 and ingest.rows().count() == 0
    write_json(spark.range(0, 9, 1, 5), ingest.landing)
    assert ingest.run() == 5
    assert ingest.run() == 0
    write_json(spark.range(9, 12, 1, 2), f"{ingest.landing}/later/day=1")
    write_json(spark.range(12, 13), ingest.landing, mode="append")
    assert ingest.run() == 3
    assert rows(ingest.rows()) == sorted([(i,) for i in range(13)], key=repr)
    assert ingest.taken().select("path").distinct().count() == ingest.taken().count() == 8


def test_a_run_that_is_cut_off_leaves_nothing_that_counts(spark, ingest, monkeypatch):
    write_json(spark.range(0, 4, 1, 1), ingest.landing)
    ingest.run()
    write_json(spark.range(4, 8, 1, 1), ingest.landing, mode="append")
    # Cut off before the batch counts: rows and names are there, the last mark is not.
    import lakeloom.streaming.ledger as module

    real = module.create_mark
    monkeypatch.setattr(module, "create_mark", lambda spark, path: "complete" not in path and real(spark, path))
    ingest.run()
    monkeypatch.undo()
    assert ingest.rows().count() == 4 and ingest.taken().count() == 1
    with pytest.raises(RuntimeError, match="discard_unfinished"):
        ingest.run()
    ingest.discard_unfinished()
    assert ingest.run() == 1 and ingest.run() == 0
    assert rows(ingest.rows()) == sorted([(i,) for i in range(8)], key=repr)


def test_a_bad_record_fails_its_batch_alone(spark, ingest, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text('{"id": 1}\nnot json\n')
    with pytest.raises(Exception, match="a.json"):
        ingest.run()
    assert ingest.rows().count() == 0 and ingest.batches() == []
    (tmp_path / "landing" / "a.json").write_text('{"id": 1}\n')
    assert ingest.run() == 1 and rows(ingest.rows()) == [(1,)]


def test_bad_records_can_be_kept(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text('{"id": 1}\nnot json\n')
    paths = [str(tmp_path / name) for name in ("landing", "target", "ledger")]
    ingest = LedgerIngest(spark, *paths, "id bigint, _corrupt_record string", options={"mode": "PERMISSIVE"})
    assert ingest.run() == 1
    assert rows(ingest.rows()) == [(1, None), (None, "not json")]


def test_odd_names_and_delimited_files(spark, tmp_path):
    folder = tmp_path / "landing" / "a b[1]{x}"
    folder.mkdir(parents=True)
    (folder / "p*q?.csv").write_text("id\n1\n")
    (folder / "_hidden.csv").write_text("id\n2\n")
    paths = [str(tmp_path / name) for name in ("landing", "target", "ledger")]
    ingest = LedgerIngest(spark, *paths, "id bigint", "csv", options={"header": "true"})
    assert ingest.run() == 1 and ingest.run() == 0
    assert rows(ingest.rows()) == [(1,)]


def test_batches_hold_a_bounded_number_of_names(spark, ingest):
    write_json(spark.range(0, 40, 1, 20), ingest.landing)
    ingest.run()
    sizes = [spark.read.parquet(f"{ingest.ledger}/files/batch={n}").count() for n in ingest.batches()]
    assert sum(sizes) == 20 and max(sizes) <= 8
