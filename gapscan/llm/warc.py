"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: a request, a response (or a revisit of an earlier
equal payload) and metadata; request and metadata name the response's record
id in ``WARC-Concurrent-To``. ``write_archives`` writes WARC/1.1 files with
Spark's text writer (a record ends with two line ends, which is the writer's
line separator; files are gzip streams). ``read_records`` parses them by
Content-Length, file by file as a stream of bytes, and ``assemble`` joins the
records of each capture to one nested row.

Damage. A record whose header cannot be read, whose length does not end at a
record's end, that is cut, or whose payload differs from its digest becomes an
error row with the file, the offset in the unpacked file and the bytes up to
where the next record may begin; reading goes on there, so later records come
back. With ``strict`` it is an exception that names file and offset. Archives
that are not packed must lie in one input split, else reading is an error: a
split could begin inside a payload.

Revisits. Of the rows with equal payloads of at least ``min_bytes`` bytes, the
one with the largest page_id is the response, the others are revisits that
refer to it and carry no payload; smaller payloads are always responses.

Defined cases: a null html is an empty payload; payloads may hold any text,
record separators and line ends included; repeated rows with the same page_id
and payload are all responses (or all revisits of another page); rows without
page_id are written and read back with a null page_id, and are revisits when
a page with an id has the same payload, else responses; an empty table gives
no records.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscan.staging import stage, staging_path

MIN_BYTES = 0
BREAK = "\r\n\r\n"
START = "WARC/1."
ROWS_PER_FILE = 100_000
DATE = "2024-01-01T00:00:00Z"

RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, url string, page_id bigint, "
          "payload_bytes bigint, payload_digest string, head string, payload string, "
          "error string, file string, offset bigint")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(batches):
    for b in batches:
        raw = [(t or "").encode() for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([len(r) for r in raw], pa.int64()),
             pa.array([_digest(r) for r in raw], pa.string())], ["page_id", "k", "payload_bytes", "payload_digest"])


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """payload_bytes, payload_digest, refers_to (null for responses) and the
    number of rows for each row key ``k`` of ``pages``: only digests move, never the pages."""
    own = stage(pages.select("page_id", "k", "html").mapInArrow(
        _digests, "page_id bigint, k string, payload_bytes bigint, payload_digest string"), "digests")
    payload = ["payload_digest", "payload_bytes"]
    largest = (own.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
                  .groupBy(*payload).agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1"))
    # payloads that occur once need no partner, except for a row without page_id
    lone = own.where("page_id is null").select(*payload).distinct()
    if not lone.isEmpty():
        largest = largest.drop("n").unionByName(
            own.where(F.col("payload_bytes") >= min_bytes).join(lone, payload, "left_semi")
               .groupBy(*payload).agg(F.max("page_id").alias("largest")).where("largest is not null")).distinct()
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return (own.join(largest, payload, "left").groupBy("k", *payload, refers.alias("refers_to"))
               .agg(F.count(F.lit(1)).alias("rows")))


def _record_id(kind: str, row: Column) -> Column:
    """A stable record id: a version-3 style UUID of the kind and the row."""
    h = F.md5(F.concat(F.lit(kind + ":"), row))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", part(1, 8), part(9, 4), F.concat(F.lit("3"), part(14, 3)), F.concat(F.lit("8"), part(18, 3)),
        part(21, 12)), F.lit(">"))


def _record(kind: Column, rid: Column, url: Column, content_type: str, extra: list[Column], body: Column) -> Column:
    """The text of one record without the two line ends that close it."""
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
                        F.concat(F.lit("WARC-Record-ID: "), rid), F.lit(f"WARC-Date: {DATE}"),
                        F.concat(F.lit("WARC-Target-URI: "), url), *extra,
                        F.lit(f"Content-Type: {content_type}"),
                        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    return F.concat(lines, F.lit(BREAK), body)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write three records for each row (page_id, url, html) of ``pages``.

    The pages move once, to meet what is known of their payloads. A row is
    named by its page_id and a hash of its text; equal rows also by a number
    that differs from row to row (their three records are made in one place, so
    any will do), and need not meet in one task.
    """
    key = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                      F.hex(F.xxhash64("url", "html")))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", key.alias("k"))
    rows = keyed.join(revisits(keyed, min_bytes), "k")
    rows = rows.withColumn("row", F.concat_ws(":", "k", F.when(
        F.col("rows") > 1, F.monotonically_increasing_id()).cast("string")))
    # header values are one line each
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]+", "%0A")
    html = F.coalesce(F.col("html"), F.lit(""))
    main, again = _record_id("response", F.col("row")), F.col("refers_to").isNotNull()
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(BREAK))
    response = _record(
        F.when(again, "revisit").otherwise("response"), main, url, "application/http; msgtype=response",
        [field("WARC-Page-ID", F.col("page_id")),
         F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
         F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
         field("WARC-Refers-To-Page-ID", F.col("refers_to"))],
        F.when(again, http).otherwise(F.concat(http, html)))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), main)
    request = _record(F.lit("request"), _record_id("request", F.col("row")), url, "application/http; msgtype=request",
                      [concurrent], F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1" + BREAK)))
    metadata = _record(F.lit("metadata"), _record_id("metadata", F.col("row")), url, "application/warc-fields",
                       [concurrent], F.lit("fetchTimeMs: 0\r\n"))
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    (records.write.option("lineSep", BREAK).option("compression", "gzip")
            .option("maxRecordsPerFile", 3 * ROWS_PER_FILE).text(path))


def _fields(head: str) -> dict[str, list[str]]:
    """Header values by lower-case name, each name's in order and once."""
    out: dict[str, list[str]] = {}
    for line in head.split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        values = out.setdefault(name.strip().lower(), [])
        if colon and value.strip() not in values:
            values.append(value.strip())
    return out


class _Damaged(Exception):
    """What is wrong with a record."""


def _one(fields: dict[str, list[str]], name: str) -> str:
    values = fields.get(name.lower())
    if not values:
        raise _Damaged(f"no {name}")
    return values[0]


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _record_row(head: str, body: bytes, keep_payload: bool) -> tuple:
    """The columns of a whole record, without error, file and offset."""
    fields = _fields(head)
    first = lambda name: (fields.get(name) or [None])[0]
    kind, record_id = _one(fields, "WARC-Type"), _one(fields, "WARC-Record-ID")
    text = lambda raw: raw.decode(errors="replace")
    size, digest, payload, http_head = None, None, None, text(body)
    if kind in ("response", "revisit"):
        top, _, content = body.partition(BREAK.encode())
        http_head = text(top)
        stated = first("warc-payload-digest")
        digest = stated.removeprefix("sha1:") if stated else None
        if kind == "response":
            size, own = len(content), _digest(content)
            if stated and stated.startswith("sha1:") and digest != own:
                raise _Damaged("the payload differs from its digest")
            digest = own
            payload = text(content) if keep_payload else None
        else:  # the full payload is the one it refers to
            size = _number((_fields("\r\n" + http_head).get("content-length") or [None])[0])
    return (record_id, kind, fields.get("warc-concurrent-to", []), first("warc-refers-to-page-id"),
            first("warc-target-uri"), _number(first("warc-page-id")), size, digest, http_head, payload)


class _Reader:
    """The records of one file, from its bytes as they come.

    ``at`` is where the next record begins in ``held``; what is before it is
    dropped from time to time, so every byte is copied a bounded number of times
    and looked at once for each record that claims it.
    """

    def __init__(self, file: str, keep_payload: bool):
        self.file, self.keep = file, keep_payload
        self.held, self.at, self.dropped = bytearray(), 0, 0
        self.searched = 0              # no next record begins before this place
        self.fault: str | None = None  # of the record at ``at``, whose end is not known yet

    def add(self, piece: bytes, over: bool):
        """Yield the rows that are known once ``piece`` has come; ``over``: it was the last."""
        self.held += piece
        while (row := self._next(over)) is not None:
            yield row
            if self.at > 1 << 20 and self.at > len(self.held) // 2:
                del self.held[:self.at]
                self.dropped, self.searched, self.at = self.dropped + self.at, self.searched - self.at, 0

    def _next(self, over: bool):
        gap, start = BREAK.encode(), START.encode()
        if self.fault is None:
            while self.held.startswith(b"\r\n", self.at):
                self.at += 2
            if self.at >= len(self.held) - (0 if over else len(gap)):
                return None
            try:
                return self._whole(over)
            except _Damaged as e:
                self.fault, self.searched = str(e), self.at + 1
        found = self.held.find(gap + start, self.searched)
        if found < 0 and not over:
            self.searched = max(self.at + 1, len(self.held) - len(gap + start))
            return None
        end = len(self.held) if found < 0 else found
        raw, offset, fault = bytes(self.held[self.at:end]), self.dropped + self.at, self.fault
        self.at, self.fault = end, None
        return (None, None, [], None, None, None, None, None, None,
                raw.decode(errors="replace") if self.keep else None, fault, self.file, offset)

    def _whole(self, over: bool):
        """The row of the record at ``at``, or None while it may still grow."""
        gap = BREAK.encode()
        head_end = self.held.find(gap, max(self.at, self.searched))
        if not self.held.startswith(START.encode(), self.at) and (over or len(self.held) - self.at >= len(START)):
            raise _Damaged("no record begins here")
        if head_end < 0:
            if over:
                raise _Damaged("the header does not end")
            self.searched = max(self.at, len(self.held) - len(gap))
            return None
        head = self.held[self.at:head_end].decode(errors="replace")
        length = _number(_one(_fields(head), "Content-Length"))
        if length is None:
            raise _Damaged("Content-Length is no number")
        begin = head_end + len(gap)
        end = begin + length
        if len(self.held) < end + len(gap) and not over:
            self.searched = head_end
            return None
        if len(self.held) < end:
            raise _Damaged("the file ends inside the record")
        if self.held[end:end + len(gap)] not in (gap, b"")[:2 if end == len(self.held) else 1]:
            raise _Damaged("the record does not end where its length says")
        row = _record_row(head, bytes(self.held[begin:end]), self.keep)
        offset, self.at, self.searched = self.dropped + self.at, min(end + len(gap), len(self.held)), 0
        return (*row, None, self.file, offset)


def _parse(keep_payload: bool, strict: bool = False):
    """Arrow task: (file, piece of its bytes, place of its split) in file order ->
    records. The reader cuts where a "WARC/1." line follows two line ends;
    where records begin and end is decided by Content-Length alone."""
    between = (BREAK + START).encode()
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    types = [kinds[f.split()[1]] for f in RECORD.split(", ")]

    def batch(rows: list[tuple]):
        for row in rows if strict else []:
            if row[-3] is not None:
                raise ValueError(f"{row[-2]}, byte {row[-1]}: {row[-3]}")
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches):
        reader = None
        for b in batches:
            rows: list[tuple] = []
            for file, piece, split in zip(*(b.column(i).to_pylist() for i in range(3))):
                if split:
                    raise ValueError(f"{file} is not packed and larger than an input split")
                if reader is None or file != reader.file:
                    if reader is not None:
                        rows += reader.add(b"", True)
                    reader = _Reader(file, keep_payload)
                    rows += reader.add(piece, False)
                else:
                    rows += reader.add(between + piece, False)
            if rows:
                yield batch(rows)
        if reader is not None and (rows := list(reader.add(b"", True))):
            yield batch(rows)
    return run


def read_records(spark, path: str, keep_payload: bool = True, strict: bool = False) -> DataFrame:
    """All records of the archives below ``path``, and an error row (``error``
    set, no type) for each damaged one, or with ``strict`` an exception. A file
    is one stream (gzip is not split); files are bounded by the writer's rows
    per file. Payloads are shown as UTF-8 text; digests are those of the bytes."""
    pieces = (spark.read.option("lineSep", BREAK + START).text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"),
                      F.col("_metadata.file_block_start").alias("split")))
    return pieces.mapInArrow(_parse(keep_payload, strict), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, with the requests
    and the metadata that name it in WARC-Concurrent-To, as arrays (``request``,
    ``metadata``) ordered by record id.

    The three sides meet in one grouping by the response's record id, so the
    records are read and moved once; a record that names several responses
    belongs to each of their captures. Requests or metadata without a response
    are dropped: they belong to no capture. So are error rows.
    """
    main = F.col("type").isin("response", "revisit")
    fields = F.struct("record_id", "type", "head", "refers_to", "payload_bytes", "payload_digest", "payload")
    capture = F.explode(F.when(main, F.array("record_id")).otherwise(F.col("concurrent_to")))
    first = lambda c: F.first(F.when(main, c), ignorenulls=True)
    every = lambda kind: F.sort_array(F.collect_list(F.when(F.col("type") == kind, fields)))
    return (records.withColumn("capture_id", capture).groupBy("capture_id")
            .agg(first(F.col("page_id")).alias("page_id"), first(F.col("url")).alias("url"),
                 first(fields).alias("response"), every("request").alias("request"),
                 every("metadata").alias("metadata"))
            .where("response is not null"))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Write all ``pages`` as archives, read them back and assemble the
    captures: one row per row of ``pages``."""
    path = staging_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = assemble(read_records(spark, path, keep_payload=False, strict=True))
    return captures.select("page_id", "response.payload_bytes", "response.payload_digest",
                           F.col("response.type").alias("record_type"),
                           F.col("response.refers_to").cast("long").alias("refers_to"),
                           (F.size("request") > 0).alias("has_request"),
                           (F.size("metadata") > 0).alias("has_metadata"))
