"""Web archives: pages written as WARC records, and captures put together again from the records.

A capture is a transaction of three records: a request, a response and metadata. The request and the metadata name the
response in ``WARC-Concurrent-To`` (or it names them). Of pages with equal payloads one is stored as a response; the
others are revisits, which have its HTTP headers and digest, name it in ``WARC-Refers-To``, and hold no payload.

**Writing** is one text write: a record ends with two line ends, which Spark's writer puts after every value, so
Spark commits the files and compresses them, on any file system. Records of a page are written together. Which pages are
revisits is told by an aggregate over digests and sizes of payloads, and a join with those that occur more
than once.

**Reading** takes the same two line ends as the separator. Spark decompresses each file in one task, whose pieces a small
parser joins and cuts by ``Content-Length``; it holds one record at a time besides a batch of pieces. Files are
whole-file compressed (``.gz`` with one member or many, ``.bz2`` refused): other files would be split between tasks
in the middle of a record, and are refused.

**Assembly** takes for each request and metadata record the identifiers it names and the responses that name it, brings
them down to one request and one metadata record for each response, by an aggregate that combines before the shuffle, and
joins these with the responses. So a response that very many records name is no hot group.

Rows and edge cases. Writing: one capture for each row. A null payload counts as empty. A null URL gives records without a
target; white space and control characters in a URL are percent-encoded. Of equal payloads the row with the smallest id is the
response, null ids last; of rows that repeat the id and the payload, the first as stored (the table is read
twice and must then have the same rows in the same places, as files have). Payloads under ``least_bytes`` are all
responses. An empty table gives archives without records. Other columns are not read. Reading: what is no record, or does
not end where it says, gives a row with a ``fault``; a header may be folded, repeated, and written in any case.
Assembly: of several requests or metadata records the one with the smallest identifier is taken, and ``n_requests`` and
``n_metadata`` tell; a record whose response is not there gives a capture without one; a response read twice gives two
captures. A revisit whose response is not there has a null ``original``.
"""

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm.shared import small, stored

# Fixed values of the archive format: version line, end of a record, profile of revisits, alphabet of base 32.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Pages have no time of their own.
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 300_000
ANCHORS = ("response", "revisit", "resource")

# What a batch of parsed records holds at most, unless one record alone is longer.
_BATCH_ROWS, _BATCH_BYTES = 2000, 8 << 20
_END, _MARK = END.encode(), b"WARC/"

RECORD_SCHEMA = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()),
    ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("target_uri", pa.string()),
    ("date", pa.string()), ("declared_digest", pa.string()), ("status", pa.int32()), ("head", pa.string()),
    ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("fault", pa.string()),
])
RECORD_DDL = (
    "file string, place long, kind string, record_id string, concurrent_to array<string>, refers_to string, "
    "target_uri string, date string, declared_digest string, status int, head string, "
    "fields array<struct<name: string, value: string>>, payload_bytes long, payload_digest string, payload binary, "
    "fault string")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: each five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _identifier(*parts: Column | str) -> Column:
    """A record's name, made from what it is about, so that others can name it without having seen it."""
    named = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    h = F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in named]))
    s = lambda start, n: F.substring(h, start, n)
    return F.concat(F.lit("<urn:uuid:"), s(1, 8), F.lit("-"), s(9, 4), F.lit("-8"), s(14, 3), F.lit("-a"), s(18, 3),
                    F.lit("-"), s(21, 12), F.lit(">"))


def _safe(url: Column) -> Column:
    """No white space or control characters, which would end a header."""
    encoded = url
    for code in (*range(33), 127):
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), encoded).otherwise(url)


def _record(kind: Column | str, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """The text of a record without its end. Headers that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [(("WARC-Type"), kind), *headers, ("Content-Type", F.lit(content_type)),
             ("Content-Length", F.octet_length(block).cast("string"))]
    head = F.concat_ws("\r\n", F.lit(VERSION), *[F.concat(F.lit(f"{name}: "), value) for name, value in lines])
    return F.concat(head, F.lit(END), block)


def write(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE, id_column: str = "page_id",
    url_column: str = "url", payload_column: str = "html", records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Three records for each row of ``pages``, in compressed archives in ``folder``, which is new."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("place"), F.col(id_column).cast("long").alias("id"),
        _safe(F.col(url_column).cast("string")).alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))})
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "place", "url")
    firsts = rows.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(
        F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(small(stored(firsts)), ["digest", "size"], "left")

    again = F.coalesce(F.col("first.place") != F.col("place"), F.lit(False))
    original = _identifier(folder, "response", F.col("digest"), F.col("size"))
    alone = _identifier(folder, "response at", F.col("place"))
    rows = rows.withColumns({
        "again": again,
        "name": F.when(again, _identifier(folder, "revisit", F.col("place")))
        .when(F.col("size") >= least_bytes, original).otherwise(alone),
        "http": F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                         F.col("size").cast("string"), F.lit(END)),
    })
    name, url, when = F.col("name"), F.col("url"), F.lit(date)
    server = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)"
    path = F.coalesce(F.regexp_extract(url, server, 2), F.lit(""))
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    get = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "),
                   F.coalesce(F.regexp_extract(url, server, 1), F.lit("")), F.lit(END))
    fields = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit("")))
    answer = _record(
        F.when(again, "revisit").otherwise("response"),
        [("WARC-Record-ID", name), ("WARC-Date", when), ("WARC-Target-URI", url),
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("WARC-Profile", F.when(again, SAME_PAYLOAD)), ("WARC-Refers-To", F.when(again, original)),
         ("WARC-Refers-To-Target-URI", F.when(again, F.col("first.url")))],
        "application/http; msgtype=response",
        F.concat("http", F.when(again, "").otherwise(F.col("payload"))))
    request = _record(
        "request",
        [("WARC-Record-ID", _identifier(folder, "request", F.col("place"))), ("WARC-Date", when),
         ("WARC-Target-URI", url), ("WARC-Concurrent-To", name)],
        "application/http; msgtype=request", get)
    metadata = _record(
        "metadata",
        [("WARC-Record-ID", _identifier(folder, "metadata", F.col("place"))), ("WARC-Date", when),
         ("WARC-Target-URI", url), ("WARC-Concurrent-To", name)],
        "application/warc-fields", fields)
    (
        rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
        .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


class _Stream:
    """Cuts the bytes of one archive into records."""

    def __init__(self) -> None:
        self.buffer, self.start, self.seen, self.lost = bytearray(), 0, 0, False

    def feed(self, piece: bytes) -> None:
        if self.start > 1 << 20 and 2 * self.start > len(self.buffer):
            del self.buffer[:self.start]
            self.seen, self.start = self.seen - self.start, 0
        self.buffer += piece
        self.buffer += _END

    def records(self) -> Iterator[tuple[list[tuple[str, str]], bytes, str | None]]:
        """Headers, block and fault of each record that is complete."""
        while True:
            while self.buffer.startswith(b"\r\n", self.start):
                self.start += 2
            end = self.buffer.find(_END, max(self.start, self.seen - 3))
            if end < 0:
                self.seen = len(self.buffer)
                return
            if not self.buffer.startswith(_MARK, self.start):
                if not self.lost:
                    yield [], b"", "no record begins here"
                self.lost, self.start, self.seen = True, end + 4, 0
                continue
            headers = _headers(bytes(self.buffer[self.start:end]))
            length = dict(headers).get("content-length", "").strip()
            if not re.fullmatch(r"[0-9]{1,18}", length):
                yield headers, b"", "no length"
                self.lost, self.start, self.seen = True, end + 4, 0
                continue
            stop = end + 4 + int(length)
            if len(self.buffer) < stop + 4:
                # The headers are found again at once when more has come.
                self.seen = end
                return
            fits = self.buffer.startswith(_END, stop)
            yield headers, bytes(self.buffer[end + 4:stop]), None if fits else "does not end where it says"
            self.start, self.seen, self.lost = stop + 4 if fits else stop, 0, not fits

    def rest(self) -> str | None:
        left = bytes(self.buffer[self.start:]).strip(b"\r\n")
        return "the archive ends within a record" if left and not self.lost else None


def _headers(text: bytes) -> list[tuple[str, str]]:
    """Names in lower case with their values; a line that begins with white space goes on with the one before."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", text).split(b"\r\n")
    pairs = [line.decode("utf-8", "replace").partition(":") for line in lines[1:]]
    return [(name.strip().lower(), value.strip()) for name, colon, value in pairs if colon]


def _row(path: str, place: int, headers: list, block: bytes, fault: str | None, keep: bool) -> dict:
    first: dict[str, str] = {}
    for name, value in headers:
        first.setdefault(name, value)
    kind, media = first.get("warc-type"), first.get("content-type", "").lower()
    digest = first.get("warc-payload-digest", "")
    row = {
        "file": path, "place": place, "kind": kind, "record_id": first.get("warc-record-id"),
        "concurrent_to": [v for n, v in headers if n == "warc-concurrent-to"], "refers_to": first.get("warc-refers-to"),
        "target_uri": first.get("warc-target-uri"), "date": first.get("warc-date"),
        "declared_digest": digest[5:] if digest.startswith("sha1:") else None, "fault": fault,
    }
    payload = block
    if media.startswith("application/http"):
        head, _, payload = block.partition(_END)
        row["head"] = head.decode("utf-8", "replace")
        status = re.match(rb"HTTP/[0-9.]+ ([0-9]{3})\b", head)
        row["status"] = int(status[1]) if status else None
        if kind == "revisit":
            declared = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*$", head.replace(b"\r", b""))
            row["payload_bytes"], row["payload_digest"] = int(declared[1]) if declared else None, row["declared_digest"]
    elif media.startswith("application/warc-fields"):
        row["fields"] = [{"name": n, "value": v} for n, v in _headers(b"\r\n" + block)]
    if kind in ("response", "resource") and not fault:
        row["payload_bytes"] = len(payload)
        row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row["payload"] = payload if keep else None
    return row


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in ``folder``, one row each (:data:`RECORD_DDL`)."""
    pieces = spark.read.option("lineSep", END).text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream, place, held, size = None, _Stream(), 0, [], 0
        for batch in batches:
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if at != path:
                    if stream.rest():
                        held.append(_row(path, place, [], b"", stream.rest(), with_payload))
                    if not at.endswith(".gz"):
                        raise ValueError(f"archives must be compressed as .gz: {at}")
                    path, stream, place = at, _Stream(), 0
                stream.feed(piece.as_py())
                for headers, block, fault in stream.records():
                    held.append(_row(path, place, headers, block, fault, with_payload))
                    size += len(block) if with_payload else 0
                    place += 1
                    if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, RECORD_SCHEMA)
                        held, size = [], 0
        if stream.rest():
            held.append(_row(path, place, [], b"", stream.rest(), with_payload))
        if held:
            yield pa.RecordBatch.from_pylist(held, RECORD_SCHEMA)

    return pieces.mapInArrow(parse, RECORD_DDL)


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each capture: ``capture_id, kind, target_uri, date, refers_to, response, request, metadata,
    n_requests, n_metadata``.

    ``records`` is used several times and should be stored.
    """
    sound = records.filter("fault IS NULL AND record_id IS NOT NULL")
    anchor = F.col("kind").isin(*ANCHORS)
    anchors, others = sound.filter(anchor), sound.filter(F.col("kind").isin("request", "metadata"))
    others = others.select("kind", "concurrent_to", F.struct("record_id", "head", "fields", "target_uri").alias("record"))
    # A record that names none stays by itself; those named by a response follow.
    own = others.select("kind", "record", F.explode_outer("concurrent_to").alias("names"))
    own = own.select("kind", "record", F.coalesce("names", "record.record_id").alias("capture_id"))
    named = anchors.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("names"))
    # Without names of its own a record is taken over by the response that names it.
    taken = own.join(named.select(F.col("names").alias("taken"), F.col("capture_id").alias("taker")).distinct(),
                     F.col("record.record_id") == F.col("taken"), "left")
    free = F.col("capture_id") == F.col("record.record_id")
    sides = taken.select("kind", "record", F.when(free, F.coalesce("taker", "capture_id")).otherwise(F.col("capture_id")).alias("capture_id"))
    request, metadata = F.col("kind") == "request", F.col("kind") == "metadata"
    sides = sides.groupBy("capture_id").agg(
        F.min(F.when(request, F.col("record"))).alias("request"), F.count_if(request).alias("n_requests"),
        F.min(F.when(metadata, F.col("record"))).alias("metadata"), F.count_if(metadata).alias("n_metadata"))
    answers = anchors.select(
        F.col("record_id").alias("answer_id"), "kind", "target_uri", "date", "refers_to",
        F.struct("record_id", "status", "head", "payload_bytes", "payload_digest", "declared_digest", "payload").alias("response"))
    whole = answers.join(sides, F.col("answer_id") == F.col("capture_id"), "full_outer")
    return whole.select(
        F.coalesce("answer_id", "capture_id").alias("capture_id"), "kind",
        F.coalesce("target_uri", "request.target_uri", "metadata.target_uri").alias("target_uri"), "date", "refers_to",
        "response", F.struct("request.record_id", "request.head").alias("request"),
        F.struct("metadata.record_id", "metadata.fields").alias("metadata"),
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def field(name: str) -> Column:
    """A field of the capture's metadata record; null if it has none of that name."""
    same = F.filter(F.col("metadata.fields"), lambda f: f["name"] == name)
    return F.get(same, F.lit(0))["value"]


def pages(found: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, sound, capture_id`` for each capture that has a
    response or revisit, with the size and digest of the full payload and the page that a revisit refers to.

    ``sound`` says whether the payload that was read has the digest its record states.
    """
    narrow = stored(found.filter("response.record_id IS NOT NULL").select(
        "capture_id", "kind", "refers_to", field("page-id").try_cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_digest").alias("digest"),
        F.col("response.declared_digest").alias("declared")))
    # Stored, so that both sides of the join are shuffled for it and Spark can split the revisits of one response.
    originals = stored(narrow.filter("kind <> 'revisit'").groupBy(F.col("capture_id").alias("refers_to")).agg(
        F.min(F.struct("page_id", "bytes", "digest")).alias("original")))
    resolved = narrow.join(small(originals), "refers_to", "left")
    original = F.col("kind") == "revisit"
    return resolved.select(
        "page_id", F.when(original, F.coalesce("original.bytes", "bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(original, F.coalesce("original.digest", "digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"), F.when(original, F.col("original.page_id")).alias("refers_to"),
        F.when(original, F.col("original.digest") == F.col("declared"))
        .otherwise(F.col("digest") == F.col("declared")).alias("sound"),
        "capture_id")
