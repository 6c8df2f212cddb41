import base64
import gzip
import hashlib

import pytest

from daytally.llm import warc
from daytally.llm.warc import captures, pages, read, write

SCHEMA = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def digest(text: str) -> str:
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows, least=0):
    first = {}
    for k, (i, _, t) in enumerate(rows):
        order = (i is None, i or 0, k)
        first[t or ""] = min(first.get(t or "", order), order)
    out = []
    for k, (i, _, t) in enumerate(rows):
        body = t or ""
        size, top = len(body.encode()), first[body]
        again = size >= least and top[2] != k
        named = None if top[0] else top[1]
        out.append((i, size, digest(body), "revisit" if again else "response", named if again else None))
    return sorted(out, key=repr)


def round_trip(spark, rows, folder, least=0, schema=SCHEMA):
    write(spark.createDataFrame(rows, schema).coalesce(1), folder, least)
    found = pages(captures(read(spark, folder, with_payload=False)))
    assert found.filter("NOT coalesce(sound, false)").count() == 0
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)


ROWS = [
    (3, "http://a.example.org/x?q=1#top", "<p>one</p>"), (1, "https://b.example.org", "<p>one</p>"),
    (2, "http://c.example.org/", None), (4, "http://d.example.org/", ""), (None, None, "<p>one</p>"), (None, None, None),
    (5, "http://e.example.org/a b\r\nWARC-Type: none", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (6, "http://f.example.org/é", "\r\n"), (7, "x", "\r\n\r\n"), (8, "x", "\r\n\r\r\n\r\n\n"), (9, "x", "é漢🙂" * 1000),
    (10, "x", "long " * 400_000), (11, "x", "long " * 400_000), (12, "x", "same row"), (12, "x", "same row"), (-5, "x", "same row"),
    (13, "x", "tie"), (13, "x", "tie"), (2**62, "x", " \t\r"), (14, "x", "\x00\x01"),
]


def test_what_is_written_is_read_back(spark, tmp_path):
    assert round_trip(spark, ROWS, str(tmp_path / "a")) == expected(ROWS)


def test_short_payloads_are_all_responses(spark, tmp_path):
    assert round_trip(spark, ROWS, str(tmp_path / "a"), 9) == expected(ROWS, 9)


def test_extra_columns_with_clashing_names(spark, tmp_path):
    extra = ("place", "id", "payload", "size", "digest", "first", "name", "again", "http", "value", "path")
    rows = [(*r, *["?"] * len(extra)) for r in ROWS]
    found = round_trip(spark, rows, str(tmp_path / "a"), schema=SCHEMA + "".join(f", {c} string" for c in extra))
    assert found == expected(ROWS)


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, [], str(tmp_path / "a")) == []


def test_a_third_of_all_rows_with_one_payload(spark, tmp_path):
    rows = [(k, "u", "same" if k % 3 == 0 else f"page {k}") for k in range(900)]
    assert round_trip(spark, rows, str(tmp_path / "a")) == expected(rows)


def test_nested_captures_hold_request_metadata_and_payload(spark, tmp_path):
    folder = str(tmp_path / "a")
    write(spark.createDataFrame(ROWS[:2], SCHEMA).coalesce(1), folder)
    found = {r["kind"]: r for r in captures(read(spark, folder)).collect()}
    response, revisit = found["response"], found["revisit"]
    assert bytes(response["response"]["payload"]) == b"<p>one</p>" and response["response"]["status"] == 200
    assert revisit["refers_to"] == response["capture_id"] and revisit["response"]["payload"] is None
    assert revisit["request"]["head"] == "GET /x?q=1 HTTP/1.1\r\nHost: a.example.org"
    assert [tuple(f) for f in response["metadata"]["fields"]] == [("page-id", "1")]
    assert (response["n_requests"], response["n_metadata"]) == (1, 1)


def test_an_archive_is_one_gzip_file_that_starts_with_a_record(spark, tmp_path):
    folder = tmp_path / "a"
    write(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), str(folder), records_per_file=6)
    files = sorted(folder.glob("*.gz"))
    assert len(files) == 3 * len(ROWS) // 6
    texts = [gzip.open(f).read() for f in files]
    assert all(t.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and t.endswith(b"\r\n\r\n") for t in texts)


def record(kind, name, block=b"", *more):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + name, *more, b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"content-type: application/http;msgtype=response"


def test_archives_of_others(spark, tmp_path):
    """One gzip member for each record, links in either direction, repeated and missing records, folded headers."""
    records = [
        record(b"warcinfo", b"<i>", b"software: x\r\n", b"Content-Type: application/warc-fields"),
        record(b"response", b"<a>", b"HTTP/1.0 404 No\r\nX: y\r\n\r\nbody", HTTP, b"WARC-Concurrent-To: <qa>", b"WARC-Target-URI:\r\n\thttp://a"),
        record(b"request", b"<qa>", b"GET / HTTP/1.0\r\n\r\n", b"Content-Type: application/http"),
        record(b"metadata", b"<m2>", b"k: 2\r\n", b"Content-Type: application/warc-fields", b"WARC-Concurrent-To: <qz>", b"WARC-Concurrent-To: <a>"),
        record(b"metadata", b"<m1>", b"k: 1\r\n", b"Content-Type: application/warc-fields", b"warc-concurrent-to: <a>"),
        record(b"request", b"<qb>", b"", b"WARC-Concurrent-To: <gone>"),
        record(b"metadata", b"<alone>", b"k: 3"),
        record(b"response", b"<b>", b"no http", b"Content-Type: text/dns"),
    ]
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    found = {r["capture_id"]: r for r in captures(read(spark, str(folder))).collect()}
    assert set(found) == {"<a>", "<b>", "<gone>", "<alone>", "<qz>"}
    a = found["<a>"]
    assert (a["request"]["record_id"], a["metadata"]["record_id"], a["n_metadata"]) == ("<qa>", "<m1>", 2)
    assert (a["target_uri"], a["response"]["status"], bytes(a["response"]["payload"])) == ("http://a", 404, b"body")
    assert bytes(found["<b>"]["response"]["payload"]) == b"no http"
    assert found["<gone>"]["response"] is None and found["<gone>"]["request"]["record_id"] == "<qb>"


def test_faults_are_rows(spark, tmp_path):
    good = record(b"response", b"<a>", b"abc")
    short = record(b"response", b"<s>", b"abc").replace(b"Length: 3", b"Length: 1")
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "1.gz").write_bytes(gzip.compress(b"noise\r\n\r\nmore\r\n\r\n" + good + short + good.replace(b"<a>", b"<b>") + b"\r\n" + good[:-9]))
    (folder / "2.gz").write_bytes(gzip.compress(good.replace(b"Content-Length: 3", b"Content-Length: x") + good.replace(b"<a>", b"<c>")))
    rows = read(spark, str(folder)).collect()
    assert sorted(r["fault"] for r in rows if r["fault"]) == [
        "does not end where it says", "no length", "no record begins here", "the archive ends within a record"]
    assert sorted(r["record_id"] for r in rows if not r["fault"]) == ["<a>", "<b>", "<c>"]


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(record(b"response", b"<a>", b"abc"))
    with pytest.raises(Exception, match="must be compressed"):
        read(spark, str(tmp_path)).collect()


def test_pieces_may_be_cut_anywhere():
    texts = [record(b"response", b"<%d>" % k, b"\r\n" * k + b"x\r\n\r\n" * (k % 3)) for k in range(40)]
    data, found = b"".join(texts), []
    stream = warc._Stream()
    pieces = data.split(b"\r\n\r\n")
    for piece in pieces if pieces[-1] else pieces[:-1]:
        stream.feed(piece)
        found += [(h, b, f) for h, b, f in stream.records()]
    assert [b for _, b, _ in found] == [b"\r\n" * k + b"x\r\n\r\n" * (k % 3) for k in range(40)]
    assert not any(f for _, _, f in found) and stream.rest() is None
