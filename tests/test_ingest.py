import re

import pytest
from helpers import day, shorts, tuples

from daytally.operators import ingest
from daytally.operators.maintenance import append_batch
from daytally.operators.quality import CheckFailed
from daytally.plans import daily

PULL, START = "2020-01-10", "2013-04-01"


def _symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "Symbol string")


def _known(spark, **dates):
    return spark.createDataFrame([(s, day(d)) for s, d in dates.items()], "Symbol string, last_date date")


def test_actions(spark):
    plan = ingest.incremental_plan(
        _symbols(spark, "NEW", "OLD", "SAME", "LATER"),
        _known(spark, OLD="2020-01-08", SAME="2020-01-10", LATER="2020-01-11", GONE="2020-01-01"), START, PULL,
    )
    assert tuples(plan, "Symbol", "start_date", "end_date", "action") == [
        ("LATER", day("2020-01-11"), day(PULL), "skip"),
        ("NEW", day(START), day(PULL), "full"),
        ("OLD", day("2020-01-08"), day(PULL), "partial"),
        ("SAME", day(PULL), day(PULL), "skip"),
    ]


def test_nothing_stored_gives_full_requests(spark):
    plan = ingest.incremental_plan(_symbols(spark, "A", "B"), None, START, PULL)
    assert tuples(plan, "Symbol", "action") == [("A", "full"), ("B", "full")]


def test_fixed_plan(spark):
    symbols = _symbols(spark, "A")
    assert tuples(ingest.fixed_plan(symbols, True, START, PULL), "start_date", "end_date") == [(day(PULL), day(PULL))]
    assert tuples(ingest.fixed_plan(symbols, False, START, PULL), "start_date", "end_date") == [(day(START), day(PULL))]


def test_boundary_day_is_not_taken_again(spark):
    plan = ingest.incremental_plan(_symbols(spark, "A", "B"), _known(spark, A="2020-01-08"), START, PULL)
    rows = shorts(
        spark, ("NYSE", "2020-01-08", "A", 1.0, 1.0, 1.0), ("NYSE", "2020-01-09", "A", 1.0, 1.0, 1.0),
        ("NYSE", "2020-01-09", "A", 1.0, 1.0, 1.0), ("NYSE", "2020-01-11", "A", 1.0, 1.0, 1.0),
        ("NYSE", "2013-03-31", "B", 1.0, 1.0, 1.0), ("NYSE", "2013-04-01", "B", 1.0, 1.0, 1.0),
        ("NYSE", "2020-01-09", "UNLISTED", 1.0, 1.0, 1.0),
    )
    assert tuples(ingest.new_rows(ingest.wanted(rows, plan)), "Symbol", "Date") == [("A", day("2020-01-09")), ("B", day(START))]


def test_advance_last_dates_equals_a_full_scan(spark):
    rows = shorts(spark, ("NYSE", "2020-01-08", "A", 1.0, 1.0, 1.0), ("NYSE", "2020-01-09", "A", 1.0, 1.0, 1.0),
                  ("NYSE", "2020-01-09", "B", 1.0, 1.0, 1.0), ("NYSE", "2020-01-02", "C", 1.0, 1.0, 1.0))
    before = rows.where("Date <= '2020-01-08'")
    advanced = ingest.advance_last_dates(ingest.last_dates(before), rows.where("Date > '2020-01-08'"))
    assert tuples(advanced, "*") == tuples(ingest.last_dates(rows), "*")


def _document(spark, symbol, newest, rows, exchange="NYSE"):
    cells = ",".join(f'["{d}",{s},{x},{t}]' for d, s, x, t in rows)
    names = '["Date","ShortVolume","ShortExemptVolume","TotalVolume"]'
    return (exchange, symbol, f"http://h/{symbol}?api_key=K",
            f'{{"dataset":{{"column_names":{names},"data":[{cells}],"newest_available_date":"{newest}"}}}}')


LANDED = "exchange string, Symbol string, SourceURL string, body string"


def test_loading_twice_adds_nothing_and_the_next_day_adds_one_row(spark, tmp_path):
    store, marks = str(tmp_path / "store"), str(tmp_path / "marks")
    symbols = spark.createDataFrame([("NYSE", "FB")], "exchange string, Symbol string")
    first = spark.createDataFrame([_document(spark, "FB", "2020-01-10", [("2020-01-10", 5, 1, 9), ("2020-01-09", 4, 1, 9)])], LANDED)
    daily.load_day(spark, first, symbols, store, marks, START, "2020-01-10")
    once = tuples(spark.read.parquet(store), "*")
    assert len(once) == 2
    daily.load_day(spark, first, symbols, store, marks, START, "2020-01-10")
    assert tuples(spark.read.parquet(store), "*") == once

    second = spark.createDataFrame([_document(spark, "FB", "2020-01-11", [("2020-01-11", 6, 1, 9), ("2020-01-10", 5, 1, 9)])], LANDED)
    daily.load_day(spark, second, symbols, store, marks, START, "2020-01-11")
    stored = spark.read.parquet(store)
    assert tuples(stored, "Date", "pull_date")[-1] == (day("2020-01-11"), day("2020-01-11"))
    assert stored.count() == 3
    assert "K" not in "".join(r["SourceURL"] for r in stored.collect())


def test_a_later_pull_date_keeps_earlier_partitions(spark, tmp_path):
    store = str(tmp_path / "store")
    append_batch(shorts(spark, ("NYSE", "2020-01-08", "A", 1.0, 1.0, 1.0)), store, "2020-01-08")
    append_batch(shorts(spark, ("NYSE", "2020-01-09", "A", 1.0, 1.0, 1.0)), store, "2020-01-09")
    append_batch(shorts(spark, ("NYSE", "2020-01-09", "A", 2.0, 2.0, 2.0)), store, "2020-01-09")
    assert tuples(spark.read.parquet(store), "Date", "ShortVolume") == [(day("2020-01-08"), 1.0), (day("2020-01-09"), 2.0)]


def _folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("store", "marks", "combined", "export", "checks", "quarantine")}


def test_a_whole_day(spark, tmp_path):
    folders = _folders(tmp_path)
    symbols = spark.createDataFrame([("NYSE", "GECCL"), ("NASDAQ", "GECCL"), ("NASDAQ", "FB")], "exchange string, Symbol string")
    landed = spark.createDataFrame([
        _document(spark, "GECCL", "2020-01-10", [("2020-01-10", 5.5, 1, 9)]),
        _document(spark, "GECCL", "2020-01-10", [("2020-01-10", 2, 1, 9)], "NASDAQ"),
        _document(spark, "FB", "2020-01-10", [("2020-01-10", 7, 1, 9), ("2020-01-09", 3, "null", 9)], "NASDAQ"),
    ], LANDED)
    daily.run_day(spark, landed, symbols, folders, START, PULL)
    published = spark.read.csv(folders["export"], header=True)
    assert tuples(published, "date", "symbol", "short_exempt_volume", "short_volume") == [
        ("2020-01-09", "FB", None, "3.0"), ("2020-01-10", "FB", "1.0", "7.0"), ("2020-01-10", "GECC_L", "2.0", "7.5"),
    ]


def test_saved_dates_and_stored_rows_give_the_same_answer(spark, tmp_path):
    store, marks = str(tmp_path / "store"), str(tmp_path / "marks")
    keys = ("exchange", "Symbol")
    for pull, symbol in (("2020-01-08", "A"), ("2020-01-09", "B"), ("2020-01-10", "A")):
        append_batch(shorts(spark, ("NYSE", pull, symbol, 1.0, 1.0, 1.0)), store, pull)
        if pull != "2020-01-09":  # as if the run had stopped before saving
            daily.save_dates(spark, store, marks, pull)
    for pull in ("2020-01-09", "2020-01-10", "2020-01-11"):
        earlier = spark.read.parquet(store).where(f"pull_date < '{pull}'")
        assert tuples(daily.known_dates(spark, store, marks, pull), "*") == tuples(ingest.last_dates(earlier, keys), "*")


def test_publishing_the_changed_dates_equals_publishing_all(spark, tmp_path):
    store, combined, whole = (str(tmp_path / n) for n in ("store", "combined", "whole"))
    append_batch(shorts(spark, ("NYSE", "2020-01-07", "A", 1.0, 1.0, 1.0), ("NYSE", "2020-01-08", "A", 1.0, 1.0, 1.0)), store, "2020-01-08")
    daily.publish_changes(spark, store, combined, "2020-01-08")
    append_batch(shorts(spark, ("NASDAQ", "2020-01-08", "A", 1.0, 2.0, 1.0), ("NYSE", "2020-01-09", "A", 1.0, 5.0, 1.0)), store, "2020-01-09")
    for _ in range(2):
        daily.publish_changes(spark, store, combined, "2020-01-09")
        daily.publish_all(spark, store, whole)
        published = spark.read.parquet(combined)
        assert tuples(published, "date", "symbol", "short_volume") == [
            (day("2020-01-07"), "A", 1.0), (day("2020-01-08"), "A", 3.0), (day("2020-01-09"), "A", 5.0)
        ]
        assert tuples(published, "date", "short_volume") == tuples(spark.read.parquet(whole), "date", "short_volume")


def _symbols_of(spark, *names):
    return spark.createDataFrame([("NYSE", n) for n in names], "exchange string, Symbol string")


def _answer(spark, *documents):
    return spark.createDataFrame(list(documents), LANDED)


def test_quiet_skipped_and_delisted_symbols_do_not_stop_the_run(spark, tmp_path):
    folders = _folders(tmp_path)
    symbols = _symbols_of(spark, "FB", "QUIET", "SKIPPED", "DELISTED")
    first = [_document(spark, s, "2020-01-08", [("2020-01-08", 5, 1, 9), ("2020-01-07", 4, 1, 9)]) for s in ("FB", "QUIET", "SKIPPED", "DELISTED")]
    daily.run_day(spark, _answer(spark, *first), symbols, folders, START, "2020-01-08")
    # Nothing new for one symbol, no request for another, and one that is no longer listed.
    second = [_document(spark, "FB", "2020-01-09", [("2020-01-09", 6, 1, 9)]), _document(spark, "QUIET", "2020-01-08", [])]
    daily.run_day(spark, _answer(spark, *second), _symbols_of(spark, "FB", "QUIET", "SKIPPED"), folders, START, "2020-01-09")
    checks = spark.read.parquet(f"{folders['checks']}/pull_date=2020-01-09")
    assert checks.where("status = 'FAIL'").count() == 0
    assert tuples(checks.where("check = 'answered'"), "subject", "actual") == [("NYSE/FB", "data"), ("NYSE/QUIET", "no data")]
    # A failed and a malformed request fail, and nothing else does; what came is stored all the same.
    third = [_document(spark, "FB", "2020-01-10", [("2020-01-10", 7, 1, 9)]), ("NYSE", "QUIET", "u", None), ("NYSE", "SKIPPED", "u", "<html>")]
    with pytest.raises(CheckFailed, match="2 are in"):
        daily.run_day(spark, _answer(spark, *third), _symbols_of(spark, "FB", "QUIET", "SKIPPED"), folders, START, "2020-01-10")
    failed = spark.read.parquet(f"{folders['checks']}/pull_date=2020-01-10").where("status = 'FAIL'")
    assert tuples(failed, "check", "subject", "actual") == [("answered", "NYSE/QUIET", "failed"), ("answered", "NYSE/SKIPPED", "malformed")]
    assert spark.read.parquet(folders["store"]).where("Symbol = 'FB'").count() == 4


def test_bad_rows_are_set_aside_counted_and_reported(spark, tmp_path):
    folders = _folders(tmp_path)
    rows = [("2020-01-08", 5, 1, 9), ("10.01.2020", 4, 1, 9), ("2020-01-07", '"abc"', 1, 9), ("2020-01-06", "1e17", 1, 9),
            ("2020-01-05", '"NaN"', 1, 9), ("2020-01-04", "null", 1, 9), ("2020-01-03", 4, 1, '"Infinity"')]
    documents = _answer(spark, _document(spark, "FB", "2020-01-08", rows))
    with pytest.raises(CheckFailed, match="readable rows documents: 5 instead of 0"):
        daily.run_day(spark, documents, _symbols_of(spark, "FB"), folders, START, "2020-01-08")
    bad = spark.read.parquet(f"{folders['quarantine']}/pull_date=2020-01-08")
    assert tuples(bad, "reason") == [("Date",), ("ShortVolume",), ("ShortVolume",), ("ShortVolume",), ("TotalVolume",)]
    assert tuples(spark.read.parquet(folders["store"]), "Date", "ShortVolume") == [(day("2020-01-04"), None), (day("2020-01-08"), 5.0)]


def test_the_second_day_exports_and_checks_its_own_dates(spark, tmp_path):
    folders = _folders(tmp_path)
    symbols = _symbols_of(spark, "FB")
    daily.run_day(spark, _answer(spark, _document(spark, "FB", "2020-01-08", [("2020-01-08", 5, 1, 9), ("2020-01-07", 4, 1, 9)])),
                  symbols, folders, START, "2020-01-08")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "export").rglob("*.csv")}
    daily.run_day(spark, _answer(spark, _document(spark, "FB", "2020-01-09", [("2020-01-09", 6, 1, 9)])), symbols, folders, START, "2020-01-09")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "export").rglob("*.csv")}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    published = spark.read.csv(folders["export"], header=True)
    assert tuples(published, "date", "short_volume") == [("2020-01-07", "4.0"), ("2020-01-08", "5.0"), ("2020-01-09", "6.0")]
    checked = spark.read.parquet(f"{folders['checks']}/pull_date=2020-01-09/stage=published").where("check = 'reconciliation'")
    assert tuples(checked, "subject") == [("2020-01-09/FB",)]
    dates = daily.changed_dates(spark, folders["store"], "2020-01-09")
    plan = daily.published(spark, folders["combined"], dates)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)
    plan = daily.rows_of(spark, folders["store"], dates)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*pull_date", plan) and re.search(r"PushedFilters: \[[^\]]*Date", plan)


def test_a_day_parses_its_documents_once(spark, tmp_path, monkeypatch):
    from daytally.sources import documents as parser

    plans, whole = [], parser.F.from_json

    def counted(*given):
        plans.append(given)
        return whole(*given)

    monkeypatch.setattr(parser.F, "from_json", counted)
    folders = _folders(tmp_path) | {"landed": str(tmp_path / "landed")}
    documents = _answer(spark, _document(spark, "FB", "2020-01-08", [("2020-01-08", 5, 1, 9)]), _document(spark, "QUIET", "2020-01-08", []))
    daily.run_day(spark, documents, _symbols_of(spark, "FB", "QUIET"), folders, START, "2020-01-08")
    assert len(plans) == 1
    landed = spark.read.parquet(folders["landed"])
    assert tuples(landed, "Symbol", "status", "has_row", "ShortVolume", "reason", "row") == [
        ("FB", "data", True, 5.0, None, None), ("QUIET", "no data", False, None, None, None)]
    assert "K" not in "".join(r["SourceURL"] for r in landed.collect())
