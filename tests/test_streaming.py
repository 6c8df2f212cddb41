import json

import pytest
from helpers import day as _day
from helpers import tuples
from test_ingest import _document

from daytally.operators.venues import combine
from daytally.plans import daily
from daytally.streaming import load_landed

PULL = "2020-01-04"


def _land(path, spark, *documents):
    lines = [json.dumps(dict(zip(("exchange", "Symbol", "SourceURL", "body"), d))) for d in documents]
    path.write_text("\n".join(lines) + "\n")


def test_each_landed_file_is_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, checkpoint, bad = (str(tmp_path / n) for n in ("store", "checkpoint", "bad"))
    _land(landing / "a.json", spark, _document(spark, "FB", "2020-01-02", [("2020-01-02", 5, 1, 9), ("2020-01-01", 4, 1, 9)]))
    load_landed(spark, str(landing), store, checkpoint, PULL, bad)
    assert spark.read.parquet(store).count() == 2
    load_landed(spark, str(landing), store, checkpoint, PULL, bad)
    assert spark.read.parquet(store).count() == 2
    _land(landing / "b.json", spark, _document(spark, "FB", "2020-01-03", [("2020-01-03", 6, 1, 9), ("2020-01-02", 5, 1, 9)]))
    _land(landing / "c.json", spark, _document(spark, "FB", "2020-01-03", [("2020-01-03", 7, 1, 9)], "NASDAQ"))
    load_landed(spark, str(landing), store, checkpoint, PULL, bad, files_per_batch=1)
    stored = spark.read.parquet(store)
    # The day that came again, in another batch, is stored once.
    assert stored.count() == 4
    assert [v for (v,) in tuples(combine(stored), "short_volume")] == [4.0, 5.0, 13.0]


def test_a_new_checkpoint_replaces_no_stored_row(spark, tmp_path):
    store, bad = str(tmp_path / "store"), str(tmp_path / "bad")
    for name, symbol in (("one", "FB"), ("two", "GOOG")):
        landing = tmp_path / name
        landing.mkdir()
        rows = [("2020-01-02", 5, 1, 9), ("10.01.2020", 4, 1, 9), ("2020-01-01", 4, 1, 9)]
        _land(landing / "a.json", spark, _document(spark, symbol, "2020-01-02", rows))
        load_landed(spark, str(landing), store, str(tmp_path / f"checkpoint_{name}"), PULL, bad)
    assert tuples(spark.read.parquet(store), "Symbol") == [("FB",), ("FB",), ("GOOG",), ("GOOG",)]
    assert tuples(spark.read.parquet(bad), "Symbol", "reason") == [("FB", "Date"), ("GOOG", "Date")]


def test_the_daily_jobs_read_what_the_stream_stored(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, combined = str(tmp_path / "store"), str(tmp_path / "combined")
    _land(landing / "a.json", spark, _document(spark, "FB", "2020-01-02", [("2020-01-02", 5, 1, 9), ("2020-01-01", 4, 1, 9)]))
    load_landed(spark, str(landing), store, str(tmp_path / "checkpoint"), PULL, str(tmp_path / "bad"))
    known = daily.known_dates(spark, store, str(tmp_path / "marks"), "2020-01-05")
    assert [str(d) for (d,) in tuples(known, "last_date")] == ["2020-01-02"]
    assert [str(d) for d in daily.publish_changes(spark, store, combined, PULL)] == ["2020-01-01", "2020-01-02"]
    assert tuples(spark.read.parquet(combined), "short_volume") == [(4.0,), (5.0,)]


def test_one_row_for_a_key_over_batches_and_restarts(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, checkpoint, bad = (str(tmp_path / n) for n in ("store", "checkpoint", "bad"))
    days = [[("2020-01-02", 5, 1, 9), ("2020-01-02", 6, 1, 9)], [("2020-01-02", 7, 1, 99), ("2020-01-01", 4, 1, 9)], [("2020-01-01", 8, 1, 9)]]
    for k, rows in enumerate(days):
        _land(landing / f"{k}.json", spark, _document(spark, "FB", "2020-01-02", rows), _document(spark, "FB", "2020-01-02", rows, "NASDAQ"))
        if k:  # the first two in one run, the third after a restart
            load_landed(spark, str(landing), store, checkpoint, PULL, bad, files_per_batch=1)
    for venue in ("NYSE", "NASDAQ"):
        rows = spark.read.parquet(store).where(f"exchange = '{venue}'")
        assert tuples(rows, "Date", "ShortVolume") in ([(_day("2020-01-01"), 4.0), (_day("2020-01-02"), 6.0)],
                                                       [(_day("2020-01-01"), 4.0), (_day("2020-01-02"), 7.0)])
    assert spark.read.parquet(bad).count() == 0


def test_a_batch_that_is_repeated_after_a_failure_gives_the_same_rows(spark, tmp_path, monkeypatch):
    from daytally.streaming import landing as module

    folder = tmp_path / "landing"
    folder.mkdir()
    store, checkpoint, bad = (str(tmp_path / n) for n in ("store", "checkpoint", "bad"))
    _land(folder / "a.json", spark, _document(spark, "FB", "2020-01-02", [("2020-01-02", 5, 1, 9), ("2020-01-01", 4, 1, 9)]))
    with monkeypatch.context() as patched:
        def fail(*_):
            raise RuntimeError("the driver is lost")
        patched.setattr(module, "bad_rows", fail)
        with pytest.raises(Exception):
            load_landed(spark, str(folder), store, checkpoint, PULL, bad)
    assert spark.read.parquet(store).count() == 2
    load_landed(spark, str(folder), store, checkpoint, PULL, bad)
    assert tuples(spark.read.parquet(store), "Date", "ShortVolume") == [(_day("2020-01-01"), 4.0), (_day("2020-01-02"), 5.0)]


def test_rows_outside_the_window_are_set_aside(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, checkpoint, bad = (str(tmp_path / n) for n in ("store", "checkpoint", "bad"))
    rows = [("2020-01-05", 5, 1, 9), ("2020-01-04", 4, 1, 9), ("2019-12-31", 3, 1, 9), ("04.01.2020", 2, 1, 9)]
    _land(landing / "a.json", spark, _document(spark, "FB", "2020-01-05", rows), _document(spark, "QUIET", "2020-01-05", []))
    load_landed(spark, str(landing), store, checkpoint, PULL, bad, start="2020-01-01")
    assert tuples(spark.read.parquet(store), "Date") == [(_day("2020-01-04"),)]
    found = spark.read.parquet(bad)
    assert tuples(found, "reason") == [("Date",), ("window",), ("window",)]
    assert any('"Date":"2020-01-05"' in r["row"] for r in found.collect())
