"""Damaged archives: nothing is lost without an error row, later records come back."""

import base64
import gzip
import hashlib
import random
import time

import pytest

from gapscan.llm import warc

END = "\r\n\r\n"


def record(i, body, length=None, kind="response", extra=""):
    length = len(body.encode()) if length is None else length
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{i}>\r\n{extra}Content-Length: {length}"
            f"{END}{body}{END}")


def page(text):
    return "HTTP/1.1 200 OK" + END + text


def read(text, cuts=None):
    """(good payloads, [(error, offset, bytes)]) of a file that comes in pieces."""
    raw = text if isinstance(text, bytes) else text.encode()
    reader, rows, places = warc._Reader("f", True), [], [0, *sorted(cuts or []), len(raw)]
    for a, b in zip(places, places[1:]):
        rows += reader.add(raw[a:b], False)
    rows += reader.add(b"", True)
    good = [r[9] for r in rows if r[-3] is None]
    bad = [(r[-3], r[-1], r[9]) for r in rows if r[-3] is not None]
    return good, bad


def test_every_kind_of_damage_is_one_error_row():
    a, z = record("a", page("first")), record("z", page("last"))
    sha = base64.b32encode(hashlib.sha1(b"x").digest()).decode()
    damage = {
        "long": record("b", page("body"), 4000),
        "into the next": record("b", page("body"), len(page("body")) + 40),
        "short": record("b", page("body"), 3),
        "no number": record("b", page("body"), "many"),
        "no length": record("b", page("body")).replace("Content-Length", "Length"),
        "no type": record("b", page("body")).replace("WARC-Type", "Type"),
        "no id": record("b", page("body")).replace("WARC-Record-ID", "ID"),
        "digest": record("b", page("body"), extra=f"WARC-Payload-Digest: sha1:{sha}\r\n"),
    }
    for name, bad in damage.items():
        good, errors = read(a + bad + z)
        assert good == ["first", "last"], name
        assert [e[1] for e in errors] == [len(a)] and "body" in errors[0][2], name
    # cut files keep all records before the cut
    whole = a + record("b", page("body")) + z
    for cut in range(len(a) + 1, len(whole)):
        good, errors = read(whole[:cut])
        assert good[0] == "first" and len(good) + len(errors) in (1, 2, 3)
        if whole[:cut].rstrip("\r\n") not in (a.rstrip("\r\n"), whole[:len(a) + len(record("b", page("body")))].rstrip("\r\n")) \
                and cut < len(whole) - 4:
            assert errors, cut
    good, errors = read("junk\r\n" + a + z)
    assert good == ["last"] and errors[0][1] == 0 and "first" in errors[0][2]
    good, errors = read(b"\xff\xfe junk" + END.encode() + (a + z).encode())
    assert good == ["first", "last"] and len(errors) == 1


def test_pieces_do_not_matter():
    rnd = random.Random(1)
    bodies = ["a", "", END, "x" + END + "WARC/1.1\r\ny", "é" * 50, "WARC/1."]
    text = "".join(record(i, page(b), None if i % 3 else len(page(b)) + rnd.choice([0, 0, 5]))
                   for i, b in enumerate(bodies * 5))
    whole = read(text)
    for _ in range(40):
        cuts = [rnd.randrange(len(text.encode())) for _ in range(rnd.choice([1, 5, 200]))]
        assert read(text, cuts) == whole
    assert read(record("v", page("p")).replace("WARC/1.1", "WARC/1.0"))[0] == ["p"]
    assert read(record("v", page("p")).replace("WARC-Type:", "warc-type:"))[0] == ["p"]


def test_time_is_linear_in_separators_and_in_damage():
    def seconds(text, pieces):
        cuts = range(0, len(text), max(1, len(text) // pieces))
        t = time.perf_counter()
        read(text, cuts)
        return time.perf_counter() - t
    inner = END + "WARC/1.1\r\n"
    for make in (lambda n: record("a", page(inner * n)),
                 lambda n: "".join(record(i, page("body"), 10 ** 9) for i in range(n // 10))):
        small, large = seconds(make(4000), 2000), seconds(make(40_000), 20_000)
        assert large < 40 * max(small, 0.01)


def test_errors_through_spark(spark, tmp_path):
    good = [record(i, page(f"page {i}")) for i in range(6)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress("".join(
        [good[0], record("bad", page("lost"), 77_777), good[1], good[2]]).encode()))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress("".join(good[3:]).encode()[:-30]))
    (tmp_path / "c.warc").write_bytes(b"HTTP/1.1 200 OK\r\n\r\nno archive")
    rows = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted(r.payload for r in rows if r.error is None) == [f"page {i}" for i in range(5)]
    bad = {r.file.rsplit("/", 1)[1]: r for r in rows if r.error is not None}
    assert set(bad) == {"a.warc.gz", "b.warc.gz", "c.warc"} and all(r.type is None for r in bad.values())
    assert bad["a.warc.gz"].offset == len(good[0]) and "lost" in bad["a.warc.gz"].payload
    assert warc.assemble(warc.read_records(spark, str(tmp_path))).count() == 5
    with pytest.raises(Exception, match="byte [0-9]+: "):
        warc.read_records(spark, str(tmp_path), strict=True).count()


def test_plain_archives_over_several_splits_are_refused(spark, tmp_path):
    (tmp_path / "a.warc").write_text("".join(record(i, page("x" * 500)) for i in range(300)), newline="")
    key = "spark.sql.files.maxPartitionBytes"
    assert warc.read_records(spark, str(tmp_path)).count() == 300
    spark.conf.set(key, "20000")
    try:
        with pytest.raises(Exception, match="larger than an input split"):
            warc.read_records(spark, str(tmp_path)).count()
    finally:
        spark.conf.unset(key)


def test_clashing_columns_and_many_equal_rows(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(1, "http://a", "same")] * 40 + [(2, "http://a", "same"), (3, "http://b", "other"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("k", "rows", "row", "refers_to", "payload_digest", "largest", "n")})
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op9_warc(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.page_id != 1) == [
        (0, "response", None), (2, "response", None), (3, "response", None)]
    assert all(r.record_type == "revisit" and r.refers_to == 2 for r in got if r.page_id == 1)
