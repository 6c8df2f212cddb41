import json

import pytest
from helpers import day, tuples

from daytally.sources import documents, requests

ROWS = "exchange string, Symbol string, start_date date, end_date date, action string"


def _plan(spark, *symbols):
    return spark.createDataFrame([("NYSE", s, day("2020-01-01"), day("2020-01-02"), a) for s, a in symbols], ROWS)


def _folder_fetch(folder, log):
    """Bodies from files; notes each request in a file of its own; a symbol named FLAKY fails at first."""
    def fetch(exchange, symbol, start, end):
        import pathlib
        import uuid

        pathlib.Path(log, f"{symbol}-{uuid.uuid4().hex}").write_text("")
        if symbol.startswith("FLAKY") and len(list(pathlib.Path(log).glob(f"{symbol}-*"))) < 3:
            raise TimeoutError("too slow")
        found = pathlib.Path(folder, f"{symbol}.json")
        return f"http://h/{symbol}?api_key=K&start_date={start}", found.read_text() if found.exists() else None

    return fetch


@pytest.fixture
def folders(tmp_path):
    for name in ("landed", "log"):
        (tmp_path / name).mkdir()
    return tmp_path / "landed", tmp_path / "log"


def _land(folder, symbol):
    data = {"dataset": {"column_names": ["Date", "ShortVolume", "ShortExemptVolume", "TotalVolume"], "data": [["2020-01-02", 5, 1, 9]], "newest_available_date": "2020-01-02"}}
    (folder / f"{symbol}.json").write_text(json.dumps(data))


def test_documents_with_the_status_of_each_request(spark, folders):
    landed, log = folders
    for symbol in ("A", "B", "FLAKY"):
        _land(landed, symbol)
    plan = _plan(spark, ("A", "full"), ("B", "partial"), ("FLAKY", "full"), ("GONE", "full"), ("OLD", "skip"))
    found = requests.read_requests(spark, plan, _folder_fetch(str(landed), str(log)), tasks=2)
    path = str(landed / "stored")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    assert tuples(found, "Symbol", "answered", "attempts", "error") == [
        ("A", True, 1, None), ("B", True, 1, None), ("FLAKY", True, 3, None), ("GONE", False, 3, "no body")]
    assert {r["SourceURL"] for r in found.where("Symbol = 'A'").collect()} == {"http://h/A?start_date=2020-01-01"}
    assert tuples(documents.parse_documents(found), "Symbol", "ShortVolume") == [("A", 5.0), ("B", 5.0), ("FLAKY", 5.0)]
    assert tuples(documents.document_status(found), "Symbol", "status")[-1] == ("GONE", "failed")
    assert not list(log.glob("OLD-*"))


def test_requests_are_dealt_out_and_bounded(spark, folders):
    landed, log = folders
    plan = _plan(spark, *[(f"S{k:02d}", "full") for k in range(10)])
    found = requests.read_requests(spark, plan, _folder_fetch(str(landed), str(log)), tasks=4, attempts=1)
    assert found.rdd.getNumPartitions() == 4 and found.count() == 10
    assert requests.read_requests(spark, _plan(spark, ("X", "skip")), _folder_fetch("x", "x")).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        requests.read_requests(spark, plan, _folder_fetch("x", "x"), tasks=0)


def test_a_failing_partition_repeats_only_its_own_requests():
    """The source itself, as a task runs it: a partition is read again from its start, the others are not."""
    asked = []

    def fetch(exchange, symbol, start, end):
        asked.append(symbol)
        return "u", "{}"

    planned = [("NYSE", f"S{k}", "a", "b") for k in range(6)]
    reader = requests.document_source(fetch, planned, 3, 1)({}).reader(None)
    first, second, third = reader.partitions()
    lost = reader.read(first)
    next(lost)
    assert [r[1] for part in (second, third, first) for r in reader.read(part)] == ["S1", "S4", "S2", "S5", "S0", "S3"]
    assert sorted(asked) == ["S0", "S0", "S1", "S2", "S3", "S4", "S5"]
