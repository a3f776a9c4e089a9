"""Archives: exact round trips, the index, and the decision who refers to whom."""

import gzip
import hashlib
import io
import zlib

import pytest

from reviewlab.llm import warc
from reviewlab.llm.storage import file_system, scratch_dir


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


LONG = "<p>é" + "x" * 200
ROWS = [(1, "http://a/", LONG, "q"), (2, "http://b/ c\n", LONG, None), (3, None, LONG, None), (4, "u", "short", None), (5, "u", "short", None),
        (6, "u", None, None), (7, "u", "", None), (8, "u", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n" * 9, None), (9, "u", "y" * 3_000_000, None),
        (1, "http://a/", LONG, "q"), (None, "u", LONG, None), (None, "u", "z" * 150, None), (10, "u", "\r\n\r\n" * 30, None)]


def want(rows):
    out = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        refers = min(same) if len(body) >= 100 and same and page != min(same) else None
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip_and_revisits(spark):
    got = warc.archived(pages(spark, ROWS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want(ROWS)
    assert warc.archived(pages(spark, [])).collect() == []


def test_members_stand_alone_and_the_index_finds_them(spark):
    folder = scratch_dir(spark, "warc-test")
    rows = warc.page_records(pages(spark, ROWS).coalesce(1))
    whole = warc.write_monolithic(rows, folder + "/m", archive_bytes=2000)
    files = warc.normalise(whole, folder + "/n")
    assert whole.count() > 1
    for r in whole.collect():
        fs, path = file_system(r.path)
        data = fs.open_input_stream(path, compression=None).read()
        inflate = zlib.decompressobj(31)
        inflate.decompress(data)
        assert inflate.eof and not inflate.unused_data  # one stream over all records
    index = warc.read_index(files).collect()
    assert len(index) == len(ROWS) == sum(r.n_records for r in files.collect())
    for r in index:
        fs, path = file_system(r.archive)
        data = gzip.decompress(fs.open_input_file(path).read_at(r.length, r.offset))
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n") and f"<{r.ident}>".encode() in data
    payloads = {(r.ident, r.payload) for r in warc.read_records(warc.read_index(files)).collect() if r.kind == "response"}
    assert ("urn:page:9", b"y" * 3_000_000) in {(i, bytes(p)) for i, p in payloads}


def test_streams_of_several_members_and_cut_streams():
    data = b"".join(warc.record("response", f"urn:page:{i}", "u", "d", 3, b"abc", None) for i in range(50))
    for packed in (gzip.compress(data), gzip.compress(data[:700]) + gzip.compress(data[700:])):
        assert b"".join(warc.records(warc.inflated(io.BytesIO(packed), 64))) == data
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(gzip.compress(data)[:-30]), 64)))
    with pytest.raises(ValueError):
        list(warc.records(iter([data[:-5]])))
