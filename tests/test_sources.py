import json
from datetime import date

import pytest
from helpers import day, tuples
from pyspark.sql import functions as F
from test_ingest import LANDED, _document

from daytally.operators.venues import combine_raw
from daytally.sources import csv_tables, documents, listings, tables

HEADER = "Date,ShortExemptVolume,ShortVolume,SourceURL,Symbol,TotalVolume"


def _folder(path, **files):
    path.mkdir()
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_lines_that_do_not_fit_are_set_aside_and_in_no_sum(spark, tmp_path):
    nyse = _folder(tmp_path / "nyse", a="\n".join([
        HEADER, "2020-01-02,1,10,u,FB,100", "2020-01-02,1,1000", "2020-01-02,1,5000,u,FB,100,extra",
        "2020-01-02,1,abc,u,FB,100", "2020-01-03,,7,u,FB,100",
    ]), b=HEADER + "\n2020-01-04,1,3,u,FB,100\n")
    landed = str(tmp_path / "landed")
    csv_tables.union_layouts(spark, {"NYSE": nyse}).write.parquet(landed)
    good, bad = csv_tables.split_bad_rows(spark.read.parquet(landed))
    assert bad.count() == 3 and good.count() == 3
    assert tuples(combine_raw(good), "date", "short_volume") == [
        (day("2020-01-02"), 10.0), (day("2020-01-03"), 7.0), (day("2020-01-04"), 3.0)
    ]
    scan = csv_tables.union_layouts(spark, {"NYSE": nyse})
    assert tuples(combine_raw(csv_tables.split_bad_rows(scan)[0]), "short_volume") == [(3.0,), (7.0,), (10.0,)]


def test_files_of_another_column_order_land_in_the_right_columns(spark, tmp_path):
    one = _folder(tmp_path / "one", a=HEADER + "\n2020-01-02,1,10,u,FB,100\n")
    two = _folder(tmp_path / "two", a="Date,ShortExemptVolume,ShortVolume,Symbol,TotalVolume,SourceURL\n2020-01-02,1,20,FB,100,u\n")
    rows, bad = csv_tables.split_bad_rows(csv_tables.union_layouts(spark, {"NASDAQ": one, "NYSE": two}))
    assert tuples(rows, "Symbol", "SourceURL", "TotalVolume") == [("FB", "u", 100.0)] * 2
    assert rows.schema["ShortVolume"].dataType.simpleString() == "double"
    assert tuples(combine_raw(rows), "short_volume") == [(30.0,)]


def test_text_scan_and_trim(spark, tmp_path):
    path = _folder(tmp_path / "t", a="Symbol, Price\nFB, 5\n")
    assert tuples(csv_tables.read_csv_text(spark, path, trim=True), "Price") == [("5",)]
    assert tuples(csv_tables.read_csv_text(spark, path, trim=True, infer=True), "Price") == [(5,)]
    typed = csv_tables.read_csv_layout(spark, _folder(tmp_path / "u", a="Symbol,TotalVolume\nFB, 5\n"), trim=True)
    assert tuples(typed, "Symbol", "TotalVolume") == [("FB", 5.0)]


def test_table_exists(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    spark.range(3).write.parquet(str(tmp_path / "full"))
    assert tables.table_exists(spark, str(tmp_path / "full"))
    assert not tables.table_exists(spark, str(tmp_path / "empty"))
    assert not tables.table_exists(spark, str(tmp_path / "missing"))
    assert not tables.table_exists(spark, str(tmp_path / "missing"), "csv")
    assert tables.table_exists(spark, _folder(tmp_path / "csv", a=HEADER + "\n"), "csv")


def test_documents(spark):
    names = ["Date", "ShortVolume", "Extra", "TotalVolume", "ShortExemptVolume"]
    body = json.dumps({"dataset": {"column_names": names, "newest_available_date": "2020-01-03", "data": [
        ["2020-01-03", 12345678.0, "x", 5e7, None], ["2020-01-02", 7, "x"], ["never", "abc", "x", 1, 2],
    ]}})
    landed = spark.createDataFrame([("NYSE", "FB", "http://h/d?api_key=K&a=1", body)], LANDED)
    rows = documents.parse_documents(landed)
    assert tuples(rows, "Date", "ShortVolume", "TotalVolume", "ShortExemptVolume") == [
        (date(2020, 1, 2), 7.0, None, None), (date(2020, 1, 3), 12345678.0, 5e7, None),
    ]
    bad = documents.bad_document_rows(landed)
    assert tuples(bad, "Symbol", "reason", "row") == [("FB", "Date", '["never","abc","x","1","2"]')]
    assert {r["SourceURL"] for r in rows.collect()} == {"http://h/d?a=1"}
    maps = documents.explode_maps(documents.document_maps(landed), "short_interests")
    assert [len(r["col"]) for r in maps.collect()] == [5, 3, 5]


def test_status_tells_quiet_symbols_from_failed_ones(spark):
    landed = spark.createDataFrame([
        _document(spark, "FULL", "2020-01-02", [("2020-01-02", 1, 1, 1)]), _document(spark, "QUIET", "2020-01-02", []),
        ("NYSE", "FAILED", "u", None), ("NYSE", "BROKEN", "u", "<html>"), ("NYSE", "ODD", "u", "{}"),
    ], LANDED)
    assert tuples(documents.document_status(landed), "Symbol", "status", "n_rows") == [
        ("BROKEN", "malformed", 0), ("FAILED", "failed", 0), ("FULL", "data", 1), ("ODD", "malformed", 0), ("QUIET", "no data", 0),
    ]
    assert documents.parse_documents(landed).count() == 1
    offered = documents.newest_offered(landed)
    assert tuples(offered.where("Symbol = 'QUIET'"), "newest_date", "source_volume") == [(day("2020-01-02"), None)]


def test_explode_keeps_symbols_without_data_on_request(spark):
    frame = spark.sql("SELECT 'A' AS Symbol, array(map('k', 'v')) AS m UNION ALL SELECT 'B', array()")
    assert documents.explode_maps(frame, "m").count() == 1
    assert tuples(documents.explode_maps(frame, "m", keep_empty=True), "Symbol") == [("A",), ("B",)]


def test_landed_files(spark, tmp_path):
    (tmp_path / "BRK_A.json").write_text(_document(spark, "x", "2020-01-02", [("2020-01-02", 1, 1, 1)])[3])
    rows = documents.parse_documents(documents.read_documents(spark, str(tmp_path), "NYSE"))
    assert tuples(rows, "exchange", "Symbol", "ShortVolume") == [("NYSE", "BRK_A", 1.0)]


def test_fetch_runs_on_the_executors_and_reports_failures(spark):
    plan = spark.createDataFrame(
        [("NYSE", "A", day("2020-01-01"), day("2020-01-02"), "full"), ("NYSE", "B", day("2020-01-01"), day("2020-01-02"), "partial"),
         ("NYSE", "C", day("2020-01-01"), day("2020-01-02"), "skip")],
        "exchange string, Symbol string, start_date date, end_date date, action string")

    def fetch(exchange, symbol, start, end):
        url = f"http://h/{exchange}_{symbol}?start={start}&end={end}&api_key=K"
        return url, None if symbol == "B" else '{"dataset":{"column_names":[],"data":[]}}'

    found = documents.fetch_documents(plan, fetch)
    assert tuples(found, "Symbol", "SourceURL") == [
        ("A", "http://h/NYSE_A?start=2020-01-01&end=2020-01-02"), ("B", "http://h/NYSE_B?start=2020-01-01&end=2020-01-02")
    ]
    assert tuples(documents.document_status(found), "Symbol", "status") == [("A", "no data"), ("B", "failed")]


def test_many_symbols_are_fetched_by_many_tasks(spark):
    plan = spark.range(6674).select(
        F.lit("NYSE").alias("exchange"), F.concat(F.lit("S"), "id").alias("Symbol"), F.lit(day("2020-01-01")).alias("start_date"),
        F.lit(day("2020-01-02")).alias("end_date"), F.lit("full").alias("action"))

    def fetch(exchange, symbol, start, end):
        from pyspark import TaskContext

        return f"http://h/{TaskContext.get().partitionId()}", "{}"

    found = documents.fetch_documents(plan, fetch, tasks=16)
    by_task = found.groupBy("SourceURL").count().collect()
    assert len(by_task) == 16 and sum(r["count"] for r in by_task) == 6674
    assert max(r["count"] for r in by_task) < 3 * 6674 / 16


def test_lines_with_numbers_that_can_not_be_summed_are_set_aside(spark, tmp_path):
    path = _folder(tmp_path / "n", a="\n".join([HEADER, *(f"2020-01-02,1,{v},u,FB,100" for v in ("5", "NaN", "Infinity", "1e17", "0.0000001", ""))]))
    good, bad = csv_tables.split_bad_rows(csv_tables.union_layouts(spark, {"NYSE": path}))
    assert tuples(good, "ShortVolume") == [(None,), (5.0,)]
    assert bad.count() == 4
    assert tuples(combine_raw(good), "short_volume") == [(5.0,)]


def test_listing(spark):
    raw = spark.createDataFrame([("BRK.A", "[quote]", None), ("FB", None, None)], "Symbol string, `Summary Quote` string, _c8 string")
    assert tuples(listings.clean_listing(raw), "*") == [("BRK_A", "quote"), ("FB", None)]


def test_symbol_universe(spark):
    listed = spark.createDataFrame([("C",), ("A",), ("B",), ("A",), (None,)], "Symbol string")
    assert tuples(listings.symbol_universe(spark, listed), "Symbol") == [("A",), ("B",), ("C",)]
    assert tuples(listings.symbol_universe(spark, listed, limit=2), "Symbol") == [("A",), ("B",)]
    assert tuples(listings.symbol_universe(spark, listed, inline=["FB", "GOOG"]), "Symbol") == [("FB",), ("GOOG",)]


def test_csv_payload(spark):
    frame = spark.createDataFrame([("p", bytearray("Symbol,V\r\nÄ,1.5\r\n\"B,C\",x\n".encode()))], "id string, body binary")
    rows = listings.parse_csv_lines(listings.csv_lines(frame, "body", "id"), "Symbol STRING, V DOUBLE", "id")
    assert tuples(rows, "id", "Symbol", "V") == [("p", "B,C", None), ("p", "Ä", 1.5)]


def test_sql_view(spark):
    assert tables.sql_view(spark.range(5), "numbers", "SELECT max(id) AS m FROM numbers").first()["m"] == 4


def test_filters_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'FB' AS Symbol, DATE'2020-01-02' AS Date, 1D AS ShortVolume, 2D AS TotalVolume").write.parquet(path)
    found = tables.read_table(spark, path).where((F.col("Symbol") == "FB") & (F.col("Date") == F.lit(day("2020-01-02")))).select("ShortVolume")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Symbol,FB)" in plan and "EqualTo(Date,2020-01-02)" in plan and "TotalVolume" not in plan


@pytest.mark.parametrize("limit", [10, 1000])
def test_broadcast_only_after_the_size_check(spark, limit):
    from daytally.operators.sizes import broadcast_if_small
    joined = spark.range(100).join(broadcast_if_small(spark.range(5), limit), "id")
    hinted = "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()
    assert hinted is (limit == 1000) and joined.count() == 5


def test_the_size_is_measured_without_gathering_rows(spark):
    from daytally.operators.sizes import ROW_BYTES, measured_bytes

    rows = spark.createDataFrame([("ab", None), (None, 123)], "a string, b long")
    assert measured_bytes(rows) == 2 * ROW_BYTES + 2 + 3
    assert measured_bytes(rows.limit(0)) == 0
