"""WARC: exact round trip, revisits, verification."""

import gzip
import hashlib
import io

import pyarrow.fs
import pytest

from ledgerline.llm import warc
from ledgerline.session import scratch_path

BIG = "<html>" + "x" * 200 + "</html>"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "extra", "clash") for i, u, h in rows],
                                 "page_id long, url string, html string, archive string, digest string")


ROWS = [(3, "http://a/\r\nX: y", BIG), (1, "http://b/é ü", BIG), (2, None, BIG), (4, "http://c", "small"),
        (5, "http://d", "small"), (6, "", None), (7, "http://e", ""), (None, "http://f", BIG),
        (8, "http://g", "é\n\x00" * 50_000), (9, "http://h", "\r\n\r\n" * 60), (9, "http://h", "\r\n\r\n" * 60)]


def test_round_trip(spark):
    got = warc.archive_round_trip(pages(spark, ROWS)).collect()
    expected = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        first = 1 if html == BIG else None
        revisit = first is not None and i != first
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                         first if revisit else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_many_archives_and_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, ROWS).coalesce(1), folder)
    made = manifest.collect()
    assert sum(r.records for r in made) == len(ROWS)
    fs, _ = warc._file_system(warc._uri(folder))
    payloads = []
    for r in made:
        raw = fs.open_input_stream(r.archive, compression=None).read()
        assert raw.count(b"\x1f\x8b\x08") >= r.records          # a gzip member per record
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\n")
        payloads += [(x["page_id"], x["payload"]) for x in warc.read_records(io.BytesIO(raw), True)
                     if x["record_type"] == "response"]
    assert ("4", b"small") in payloads and ("1", BIG.encode()) in payloads


def one(payload=b"p" * 300):
    import zlib
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = warc.record(1, "http://x", payload, hashlib.sha256(payload).hexdigest(), None)
    return data, lambda d: deflate.compress(d) + deflate.flush()


def test_damage_is_an_error():
    data, pack = one()
    whole = pack(data)
    assert next(warc.read_records(io.BytesIO(whole)))["payload_bytes"] == 300
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(whole[:-20])))
    for change in (lambda d: d.replace(b"ppp", b"ppq", 1), lambda d: d[:-6], lambda d: d + b"more",
                   lambda d: d.replace(b"WARC/1.1", b"HTTP/1.1", 1)):
        data, pack = one()
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(pack(change(data)))))


def test_large_payload_is_read_in_portions():
    data, pack = one(b"\x00" * 5_000_000)
    row = next(warc.read_records(io.BytesIO(pack(data))))
    assert row["payload_bytes"] == 5_000_000


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0
