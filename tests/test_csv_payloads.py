import csv
import io
import random

import pytest
from helpers import tuples

from daytally.sources import csv_payloads as c

SCHEMA = "name STRING, volume DOUBLE, day DATE"
HEADER = "name,volume,day\r\n"


def _read(spark, text, schema=SCHEMA):
    payloads = spark.createDataFrame([("k", bytearray(text.encode()))], "key string, payload binary")
    return c.read_records(c.csv_records(payloads, "payload", "key"), schema, "key")


def _good(spark, text, schema=SCHEMA):
    return [tuple(r) for r in _read(spark, text, schema).where("reason IS NULL").orderBy("record_no").select("row.*").collect()]


def test_quoted_commas_line_ends_and_quotes_survive(spark):
    text = HEADER + '"a,b",1,2020-01-01\n"line\r\nend, ""said""\n",2,\r\n"",3.5,2020-01-02\n,4,2020-01-03\n"\x01n\x01a",5,\nlast\\,6,'
    assert [(n, v, str(d) if d else None) for n, v, d in _good(spark, text)] == [
        ("a,b", 1.0, "2020-01-01"), ('line\r\nend, "said"\n', 2.0, None), ("", 3.5, "2020-01-02"), (None, 4.0, "2020-01-03"),
        ("\x01n\x01a", 5.0, None), ("last\\", 6.0, None)]


def test_every_bad_line_is_kept_with_its_reason(spark):
    text = HEADER + "a,abc,2020-01-01\n\nb,1\nc,1,2020-01-01,x\nd,2,2020-01-01\ne,3,01.02.2020\n\"f,4,2020-01-01\ng,5,2020-01-01\n"
    found = _read(spark, text)
    assert tuples(c.rejects(found, "key"), "record_no", "reason", "record") == [
        (1, "volume", "a,abc,2020-01-01"), (3, "fields: 2", "b,1"), (4, "fields: 4", "c,1,2020-01-01,x"),
        (6, "day", "e,3,01.02.2020"), (7, "quote", '"f,4,2020-01-01\ng,5,2020-01-01\n')]
    assert tuples(c.good_records(found, "key"), "key", "name") == [("k", "d")]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_what_a_writer_writes_is_read_back(spark, end):
    draw = random.Random(4)
    cells = ["", "a", ",", '"', "\n", "\r\n", "x,y", '"q"', "é漢", " lead", "tail ", "\x01", "a\nb", '""', "'"]
    rows = [["".join(draw.choice(cells) for _ in range(draw.randint(1, 4))) or "-" for _ in range(3)] for _ in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows([["a", "b", "c"], *rows])
    assert _good(spark, out.getvalue(), "a STRING, b STRING, c STRING") == [tuple(r) for r in rows]


def test_null_and_empty_payloads_have_no_records(spark):
    payloads = spark.createDataFrame([(None,), (bytearray(b""),), (bytearray(b"\n\n"),)], "payload binary")
    assert c.csv_records(payloads, "payload").count() == 0


def test_a_long_payload_is_read_in_proportion(spark):
    rows = 20_000
    text = HEADER + "".join(f'"a ""{k}"", b\n",{k},2020-01-01\n' for k in range(rows))
    found = _good(spark, text)
    assert len(found) == rows and found[-1][:2] == (f'a "{rows - 1}", b\n', rows - 1.0)


def test_a_record_is_parsed_once_whatever_is_asked_of_it(spark):
    found = _read(spark, HEADER + "a,abc,2020-01-01\nb,1,2020-01-01\n")
    for asked in (c.good_records(found, "key"), c.rejects(found, "key")):
        assert asked._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
        assert asked.count() == 1
