"""Published totals hold every stored row of their dates, whichever batch brought it and in whatever order."""

import re

import pytest
from helpers import day, shorts, tuples
from pyspark.sql import functions as F

from daytally.operators import maintenance as m
from daytally.operators.maintenance import append_batch
from daytally.plans import daily


def _row(venue, date, symbol, volume):
    return (venue, date, symbol, 1.0, volume, 1.0)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "store"), str(tmp_path / "combined")


def _failed(spark, store, combined, dates):
    return tuples(daily.check_published(spark, store, combined, dates).where("status = 'FAIL'"), "subject", "actual")


def test_a_row_pulled_before_its_date_is_in_the_total(spark, folders):
    store, combined = folders
    append_batch(shorts(spark, _row("NYSE", "2020-02-21", "EARLY", 3.0)), store, "2020-02-20", "stream-0")
    append_batch(shorts(spark, _row("NYSE", "2020-02-21", "FB", 5.0)), store, "2020-02-21")
    dates = daily.publish_changes(spark, store, combined, "2020-02-21")
    assert dates == [day("2020-02-21")]
    assert tuples(spark.read.parquet(combined), "symbol", "short_volume") == [("EARLY", 3.0), ("FB", 5.0)]
    assert _failed(spark, store, combined, dates) == []


def test_a_withheld_batch_fails_the_reconciliation(spark, folders):
    store, combined = folders
    append_batch(shorts(spark, _row("NYSE", "2020-02-21", "EARLY", 3.0)), store, "2020-02-20", "stream-0")
    append_batch(shorts(spark, _row("NYSE", "2020-02-21", "FB", 5.0)), store, "2020-02-21")
    m._write_entries(spark, store, "2020-02-20", "stream-0", [(None, None, False)])
    dates = daily.publish_changes(spark, store, combined, "2020-02-21")
    assert tuples(spark.read.parquet(combined), "symbol") == [("FB",)]
    assert _failed(spark, store, combined, dates) == [("2020-02-21/EARLY", None)]


def test_batches_without_the_dates_are_not_read(spark, folders):
    store, _ = folders
    for k in range(1, 10):
        append_batch(shorts(spark, _row("NYSE", f"2020-01-0{k}", "A", 1.0)), store, f"2020-01-0{k}")
    rows = daily.rows_of(spark, store, [day("2020-01-03")])
    assert tuples(rows, "Date") == [(day("2020-01-03"),)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning[^\]]*pull_date|PartitionFilters: \[[^\]]*pull_date[^\]]*dynamicpruning", plan)


def test_a_rerun_without_a_venue_leaves_none_of_its_rows(spark, folders):
    store, combined = folders
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "A", 1.0), _row("NASDAQ", "2020-01-08", "A", 2.0), _row("NYSE", "2020-01-07", "B", 4.0)), store, "2020-01-08")
    daily.publish_changes(spark, store, combined, "2020-01-08")
    append_batch(shorts(spark, _row("NASDAQ", "2020-01-08", "A", 2.0)), store, "2020-01-08")
    assert tuples(spark.read.parquet(store), "exchange", "Symbol") == [("NASDAQ", "A")]
    dates = daily.publish_changes(spark, store, combined, "2020-01-08")
    assert dates == [day("2020-01-07"), day("2020-01-08")]
    assert tuples(spark.read.parquet(combined), "date", "short_volume") == [(day("2020-01-08"), 2.0)]
    assert _failed(spark, store, combined, dates) == []


def test_a_rerun_without_rows_leaves_none(spark, folders):
    store, combined = folders
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "A", 1.0)), store, "2020-01-08")
    daily.publish_changes(spark, store, combined, "2020-01-08")
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "A", 1.0)).limit(0), store, "2020-01-08")
    assert daily.publish_changes(spark, store, combined, "2020-01-08") == [day("2020-01-08")]
    assert (spark.read.parquet(store).count(), spark.read.parquet(combined).count()) == (0, 0)
    assert daily.changed_dates(spark, store, "2020-01-09") == []


def test_a_run_that_stops_before_the_index_is_done_hides_no_row(spark, folders, monkeypatch):
    store, combined = folders
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "A", 1.0)), store, "2020-01-08")

    def stop(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as patched:
        patched.setattr(m, "_entries", stop)
        with pytest.raises(RuntimeError):
            append_batch(shorts(spark, _row("NYSE", "2020-01-08", "B", 2.0), _row("NASDAQ", "2020-01-06", "C", 3.0)), store, "2020-01-09", "late")
    assert daily.changed_dates(spark, store, "2020-01-09") == [day("2020-01-06"), day("2020-01-08")]
    assert tuples(daily.rows_of(spark, store, [day("2020-01-08")]), "Symbol") == [("A",), ("B",)]
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "B", 2.0)), store, "2020-01-09", "late")
    assert tuples(spark.read.parquet(store), "Symbol") == [("A",), ("B",)]
    assert daily.changed_dates(spark, store, "2020-01-09") == [day("2020-01-06"), day("2020-01-08")]


def test_a_store_from_before_the_index_is_indexed_once(spark, folders):
    store, combined = folders
    named = shorts(spark, _row("NYSE", "2020-01-08", "OLD", 1.0)).select(
        "*", F.lit("2020-01-08").cast("date").alias("pull_date"), F.lit("daily").alias("batch"))
    m.replace_partitions(named, store, m.STORE_PARTITIONS)
    assert tuples(daily.rows_of(spark, store, [day("2020-01-08")]), "Symbol") == [("OLD",)]
    append_batch(shorts(spark, _row("NYSE", "2020-01-08", "NEW", 2.0)), store, "2020-01-09")
    daily.publish_changes(spark, store, combined, "2020-01-09")
    assert tuples(spark.read.parquet(combined), "symbol") == [("NEW",), ("OLD",)]


def test_partition_names_with_coded_characters_are_cleared(spark, folders):
    store, _ = folders
    for rows in ([_row("A:B/C", "2020-01-08", "A", 1.0), _row("NYSE", "2020-01-08", "A", 1.0)], [_row("NYSE", "2020-01-08", "A", 1.0)]):
        append_batch(shorts(spark, *rows), store, "2020-01-08", "x=1")
    assert tuples(spark.read.parquet(store), "exchange") == [("NYSE",)]
