import pytest
from helpers import day, shorts, tuples
from pyspark.sql import functions as F

from daytally.operators import fixes as x
from daytally.operators import quality, sizes, venues
from daytally.plans import daily
from daytally.operators.maintenance import append_batch


def _fixes(spark, *rows):
    return spark.createDataFrame([(w, r, day(f) if f else None, day(t) if t else None) for w, r, f, t in rows], x.FIX_SCHEMA)


def _row(date, symbol, volume, venue="NYSE"):
    return (venue, date, symbol, 1.0, volume, 1.0)


def test_a_symbol_is_corrected_by_its_day(spark):
    table = _fixes(spark, ("A", "A1", None, "2020-01-02"), ("A", "A2", "2020-01-04", "2020-01-05"), (None, "x", None, None), ("B", None, None, None))
    rows = shorts(spark, *[_row(f"2020-01-0{k}", "A", 1.0) for k in range(1, 7)], _row("2020-01-01", "B", 1.0), _row("2020-01-01", None, 1.0), _row(None, "A", 1.0))
    found = x.fix_symbols(rows, table, into="now")
    assert tuples(found, "Date", "Symbol", "now") == [
        (None, "A", "A"), (day("2020-01-01"), None, None), (day("2020-01-01"), "A", "A1"), (day("2020-01-01"), "B", "B"),
        *[(day(f"2020-01-0{k}"), "A", now) for k, now in ((2, "A1"), (3, "A"), (4, "A2"), (5, "A2"), (6, "A"))]]


def test_overlapping_corrections_are_refused(spark):
    x.check_fixes(_fixes(spark, ("A", "B", None, "2020-01-01"), ("A", "C", "2020-01-02", None), ("C", "A", None, None)))
    for rows in ([("A", "B", None, "2020-01-02"), ("A", "C", "2020-01-02", None)], [("A", "B", None, None), ("A", "B", None, None)],
                 [("A", "B", "2020-01-02", "2020-01-01")], [("A", "B", "2020-01-01", "2020-12-31"), ("A", "C", "2020-02-01", "2020-02-02"), ("A", "D", "2020-03-01", None)]):
        with pytest.raises(x.OverlappingFixes, match="A from"):
            venues.combine(shorts(spark, _row("2020-01-01", "A", 1.0)), _fixes(spark, *rows))


def test_thousands_of_corrections_with_and_without_a_broadcast(spark, monkeypatch):
    """Two for each of 3,000 symbols; duplicates of a stored symbol count once, symbols with one correction are added up."""
    ids = spark.range(3000)
    d = lambda t: F.lit(t).cast("date")
    table = ids.select(F.concat(F.lit("S"), "id").alias("wrong"), F.explode(F.array(
        F.struct(F.concat(F.lit("T"), (F.col("id") % 100)).alias("right"), d(None).alias("valid_from"), d("2020-01-01").alias("valid_to")),
        F.struct(F.lit("U").alias("right"), d("2020-01-03").alias("valid_from"), d(None).alias("valid_to")))).alias("f")).select("wrong", "f.*")
    rows = ids.select(F.lit("NYSE").alias("exchange"), F.explode(F.array(d("2020-01-01"), d("2020-01-02"), d("2020-01-03"), d("2020-01-03"))).alias("Date"),
                      F.concat(F.lit("S"), "id").alias("Symbol"), F.lit(1.0).alias("ShortExemptVolume"), F.lit(2.0).alias("ShortVolume"), F.lit(3.0).alias("TotalVolume"))
    for limit in (sizes.BROADCAST_BYTES, 0):
        monkeypatch.setattr(x, "broadcast_if_small", lambda df, limit=limit: sizes.broadcast_if_small(df, limit))
        found = venues.combine(rows, table)
        assert found.where("date = '2020-01-01'").select("symbol", "short_volume").distinct().count() == 100
        assert tuples(found.where("date = '2020-01-01' AND symbol = 'T7'"), "short_volume") == [(60.0,)]
        assert tuples(found.where("date = '2020-01-03'"), "symbol", "short_volume") == [("U", 6000.0)]
        assert found.where("date = '2020-01-02'").count() == 3000
        assert quality.reconcile(found, rows, table).where("status = 'FAIL'").count() == 0


def test_a_table_of_fixes_that_always_hold_equals_the_few(spark):
    rows = shorts(spark, _row("2020-01-01", "GECCL", 1.0), _row("2020-01-01", "GECC_L", 2.0), _row("2020-01-01", "GECCL", 4.0, "NASDAQ"), _row("2020-01-01", "FB", 8.0))
    few = {"GECCL": "GECC_L"}
    assert tuples(venues.combine(rows, x.fixes_of(spark, few)), "*") == tuples(venues.combine(rows, few), "*")


def test_publishing_and_its_check_share_the_table(spark, tmp_path):
    store, combined = str(tmp_path / "store"), str(tmp_path / "combined")
    table = _fixes(spark, ("A", "NEW", "2020-01-08", None))
    append_batch(shorts(spark, _row("2020-01-07", "A", 1.0), _row("2020-01-08", "A", 2.0), _row("2020-01-08", "NEW", 3.0)), store, "2020-01-08")
    dates = daily.publish_changes(spark, store, combined, "2020-01-08", table)
    assert tuples(spark.read.parquet(combined), "symbol", "short_volume") == [("A", 1.0), ("NEW", 5.0)]
    failed = lambda fixes: tuples(daily.check_published(spark, store, combined, dates, fixes).where("status = 'FAIL'"), "subject")
    assert failed(table) == []
    assert failed({}) == [("2020-01-08/A",), ("2020-01-08/NEW",)]
