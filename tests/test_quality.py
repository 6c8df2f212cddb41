import pytest
from helpers import shorts, tuples
from pyspark.sql import functions as F
from test_ingest import LANDED, _document

from daytally.operators import quality, venues

D = "2020-02-21"


def _clean(spark):
    return shorts(
        spark, ("NASDAQ", D, "SPY", 1.0, 10.0, 100.0), ("NYSE", D, "SPY", 2.0, 20.0, 200.0),
        ("NYSE", D, "SPY", 2.0, 20.0, 200.0), ("NASDAQ", D, "FB", 1.0, 7.0, 70.0), ("NYSE", D, "TXG", 1.0, None, 70.0),
    )


def _fails(checks):
    return tuples(checks.where("status = 'FAIL'"), "check", "subject", "expected", "actual")


def test_reconcile_passes_with_duplicates_one_venue_and_nulls(spark):
    rows = _clean(spark)
    checks = quality.reconcile(venues.combine(rows), rows)
    assert checks.columns == ["check", "subject", "status", "expected", "actual"]
    assert checks.count() == 3 and _fails(checks) == []


def test_each_fault_is_one_fail(spark):
    rows = _clean(spark)
    combined = venues.combine(rows)
    off = combined.withColumn("short_volume", F.col("short_volume") + F.when(F.col("symbol") == "SPY", 1).otherwise(0))
    assert _fails(quality.reconcile(off, rows)) == [("reconciliation", f"{D}/SPY", "30.000000", "31.000000")]
    assert _fails(quality.reconcile(combined.where("symbol <> 'FB'"), rows)) == [("reconciliation", f"{D}/FB", "7.000000", None)]
    assert _fails(quality.reconcile(combined, rows.where("Symbol <> 'FB'"))) == [("reconciliation", f"{D}/FB", None, "7.000000")]


def test_corrected_symbols_reconcile(spark):
    rows = shorts(spark, ("NYSE", D, "GECCL", 1.0, 3.0, 9.0), ("NYSE", D, "GECC_L", 1.0, 4.0, 9.0))
    assert _fails(quality.reconcile(venues.combine(rows), rows)) == []


def test_freshness_and_accuracy(spark):
    documents = spark.createDataFrame([
        _document(spark, "GOOD", D, [(D, 5, 1, 9)]),
        _document(spark, "STALE", "2020-02-24", [("2020-02-24", 5, 1, 9), (D, 5, 1, 9)]),
        _document(spark, "WRONG", D, [(D, 5, 1, 9)]),
        _document(spark, "UNSTORED", D, [(D, 5, 1, 9)]),
        _document(spark, "EMPTY", D, []),
    ], LANDED)
    stored = shorts(
        spark, ("NYSE", D, "GOOD", 1.0, 5.00001, 9.0), ("NYSE", "2020-02-20", "GOOD", 1.0, 99.0, 9.0),
        ("NYSE", D, "STALE", 1.0, 5.0, 9.0), ("NYSE", D, "WRONG", 1.0, 6.0, 9.0), ("NYSE", D, "NOSOURCE", 1.0, 6.0, 9.0),
    )
    failed = [(c, s) for c, s, *_ in _fails(quality.quality_vs_source(stored, documents))]
    # A symbol the source had nothing for, and one that was not asked for, have nothing to be compared with.
    assert failed == sorted([("freshness", "NYSE/STALE"), ("accuracy", "NYSE/WRONG"), ("freshness", "NYSE/UNSTORED")])


def test_accuracy_is_compared_on_the_stored_day(spark):
    documents = spark.createDataFrame([
        _document(spark, "LATER", "2020-02-24", [("2020-02-24", 8, 1, 9), (D, 5, 1, 9)]),
        _document(spark, "PARTIAL", "2020-02-24", [("2020-02-24", 8, 1, 9)]),
    ], LANDED)
    stored = shorts(spark, ("NYSE", D, "LATER", 1.0, 5.0, 9.0), ("NYSE", D, "PARTIAL", 1.0, 5.0, 9.0))
    checks = quality.quality_vs_source(stored, documents)
    assert tuples(checks, "check", "subject", "status") == [
        ("accuracy", "NYSE/LATER", "SUCCESS"), ("freshness", "NYSE/LATER", "FAIL"), ("freshness", "NYSE/PARTIAL", "FAIL")]


def test_all_checks_are_written_before_the_run_stops(spark, tmp_path):
    rows = spark.range(30).select(F.lit("c").alias("check"), F.col("id").cast("string").alias("subject"), F.lit("FAIL").alias("status"),
                                  F.lit("a").alias("expected"), F.lit("b").alias("actual"))
    with pytest.raises(quality.CheckFailed, match="all 30 are in"):
        quality.enforce(rows, str(tmp_path / "checks"))
    assert spark.read.parquet(str(tmp_path / "checks")).count() == 30


def test_latest_row_is_one_per_symbol_whatever_the_order(spark):
    rows = shorts(
        spark, ("NYSE", D, "B", 1.0, 2.0, 3.0), ("NYSE", D, "A", 1.0, 2.0, 3.0),
        ("NYSE", D, "A", 1.0, 9.0, 3.0), ("NYSE", "2020-02-20", "A", 1.0, 2.0, 99.0),
    )
    for order in ("Symbol", "ShortVolume"):
        latest = quality.latest_rows(rows.orderBy(order), ["Symbol"])
        assert tuples(latest, "Symbol", "ShortVolume") == [("A", 9.0), ("B", 2.0)]


def test_basic_quality(spark, tmp_path):
    rows = _clean(spark)
    paths = {n: str(tmp_path / n) for n in ("full", "header_only", "empty_folder", "missing")}
    rows.write.parquet(paths["full"])
    rows.limit(0).write.parquet(paths["header_only"])
    (tmp_path / "empty_folder").mkdir()
    checks = quality.basic_quality(spark, paths)
    assert tuples(checks, "subject", "status", "actual") == [
        ("empty_folder", "FAIL", "does not exist"), ("full", "SUCCESS", "5"),
        ("header_only", "FAIL", "0"), ("missing", "FAIL", "does not exist"),
    ]


def test_basic_quality_of_csv(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("Symbol,ShortVolume\n")
    checks = quality.basic_quality(spark, {"t": str(tmp_path / "t"), "none": str(tmp_path / "none")}, "csv")
    assert tuples(checks, "subject", "status") == [("none", "FAIL"), ("t", "FAIL")]


def test_gate(spark):
    rows = _clean(spark)
    good = quality.reconcile(venues.combine(rows), rows)
    quality.enforce(good)
    assert tuples(quality.gate_summary(good), "*") == [("reconciliation", 3, 0, True)]
    bad = quality.reconcile(venues.combine(rows).where("symbol <> 'FB'"), rows)
    with pytest.raises(quality.CheckFailed, match="2020-02-21/FB"):
        quality.enforce(bad)
