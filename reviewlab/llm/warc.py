"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

A monolithic archive is one gzip stream over all its records, which nobody can
enter in the middle.  The normaliser inflates such a stream once, piece by piece,
rewrites every record as a gzip member of its own and leaves a sidecar index of
(offset, length, type, record id, target) beside the new archive.  Readers take
members by the index.

Files have a name of the attempt that wrote them, and what counts is the table of
names that Spark committed, so a lost executor or a repeated task leaves no half
file in a result.  Memory per task: one record, and some buffers.

Defined results: a null payload is empty; equal payloads of at least ``MIN_REVISIT``
bytes are stored once, with the smallest id, and the others refer to it; rows that
repeat that id are responses too, and a null id is a response only where its group
has null ids only; a null url has no target field, white space and control
characters in a url are percent-encoded; an empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import file_system, in_batches, scratch_dir, stash

MIN_REVISIT = 100
#: Bytes of records after which a task starts the next archive.
ARCHIVE_BYTES = 64 << 20
_CHUNK = 1 << 20
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, ident: str, target: str | None, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the HTTP header of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ident}>"), ("WARC-Date", _DATE)]
    if target is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", target)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflated(stream, chunk: int = _CHUNK) -> Iterator[bytes]:
    """Pieces of a gzip file of one or more members, each at most ``chunk`` bytes."""
    inflater, begun = zlib.decompressobj(31), False
    while data := stream.read(chunk):
        while data:
            begun = True
            if piece := inflater.decompress(data, chunk):
                yield piece
            data = inflater.unconsumed_tail
            if inflater.eof:
                data, inflater, begun = inflater.unused_data, zlib.decompressobj(31), False
    if begun:
        raise ValueError("the gzip stream is cut off")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream."""
    held = bytearray()

    def until(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while until(1):
        at, seen = -1, 0
        while (at := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not until(seen + 1):
                raise ValueError("the last record's header is cut off")
        size = at + 4 + int(fields_of(bytes(held[:at]))["content-length"]) + 4
        if not until(size):
            raise ValueError("the last record is cut off")
        yield bytes(held[:size])
        del held[:size]


def _member(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _path(folder: str, ending: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{ending}"


def write_monolithic(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """(path, n_records) of archives of one gzip stream each.

    ``rows``: ident, target, payload (binary), digest, size, refers_to (null for a response).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        path = sink = squeeze = None
        n = size = 0

        def close() -> pa.RecordBatch:
            sink.write(squeeze.flush())
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

        for batch in batches:
            for i in range(len(batch)):
                ident, target, payload, digest, full, refers = (batch.column(c)[i].as_py() for c in range(6))
                if sink is None:
                    path, n, size = _path(folder, ".warc.gz"), 0, 0
                    sink, squeeze = fs.open_output_stream(file_system(path)[1], compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record("response" if refers is None else "revisit", ident, target, digest, full, payload or b"", refers)
                sink.write(squeeze.compress(data))
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()

    return stash(in_batches(rows).select("ident", "target", "payload", "digest", "size", "refers_to")
                 .mapInArrow(run, "path string, n_records long"), "warc-monolithic")


def normalise(archives: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """(archive, index, n_records): archives of one member a record, each with its sidecar index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                archive, at, index = _path(folder, ".warc.gz"), 0, []
                with fs.open_output_stream(file_system(archive)[1], compression=None) as sink, \
                        fs.open_input_stream(file_system(source)[1], compression=None) as stream:
                    for data in records(inflated(stream)):
                        head, member = fields_of(data[:data.index(b"\r\n\r\n")]), _member(data, level)
                        sink.write(member)
                        index.append(f"{at}\t{len(member)}\t{head['warc-type']}\t{head['warc-record-id']}\t{head.get('warc-target-uri', '')}\n")
                        at += len(member)
                with fs.open_output_stream(file_system(archive)[1] + ".idx", compression=None) as sink:
                    sink.write("".join(index).encode())
                yield pa.RecordBatch.from_pydict({"archive": [archive], "index": [archive + ".idx"], "n_records": [len(index)]})

    n = archives.count()
    spread = archives.select("path").repartition(max(1, n))
    return stash(spread.mapInArrow(run, "archive string, index string, n_records long"), "warc-normalised")


def read_index(files: DataFrame) -> DataFrame:
    """(archive, offset, length, kind, ident, target) of all sidecar indexes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = file_system(index)
                with fs.open_input_stream(path, compression=None) as stream:
                    lines = [x.split("\t") for x in stream.read().decode().split("\n")[:-1]]
                at, length, kind, ident, target = zip(*lines) if lines else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([archive] * len(lines), pa.string()), pa.array(map(int, at), pa.int64()), pa.array(map(int, length), pa.int64()),
                     pa.array(kind, pa.string()), pa.array([x[1:-1] for x in ident], pa.string()), pa.array([x or None for x in target], pa.string())],
                    names=["archive", "offset", "length", "kind", "ident", "target"])

    return files.select("archive", "index").mapInArrow(
        run, "archive string, offset long, length long, kind string, ident string, target string")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """(ident, kind, target, refers_to, size, digest, payload) of the members that ``index`` names.

    Without ``payloads`` they are read and checked all the same, but not handed on.

    A response's size and digest are those of the payload just read, and a wrong
    declared digest is an error; a revisit's are what its header says of the full payload.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            for lo in range(0, len(batch), 256):
                out = []
                for archive, at, length in zip(*(batch.column(c).slice(lo, 256).to_pylist() for c in range(3))):
                    if archive != opened:
                        fs, path = file_system(archive)
                        opened, file = archive, fs.open_input_file(path)
                    data = zlib.decompress(file.read_at(length, at), 31)
                    head, _, rest = data.partition(b"\r\n\r\n")
                    fields = fields_of(head)
                    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
                    size, digest = int(re.search(rb"Content-Length: (\d+)", http)[1]), fields["warc-payload-digest"].removeprefix("sha256:")
                    if fields["warc-type"] == "response":
                        size, declared, digest = len(payload), digest, hashlib.sha256(payload).hexdigest()
                        if declared != digest:
                            raise ValueError(f"{archive} at {at}: payload digest {digest}, declared {declared}")
                    refers = fields.get("warc-refers-to")
                    out.append((fields["warc-record-id"][1:-1], fields["warc-type"], fields.get("warc-target-uri"), refers and refers[1:-1],
                                size, digest, payload if payloads and fields["warc-type"] == "response" else None))
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                names = ["ident", "kind", "target", "refers_to", "size", "digest", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=names)

    return index.select("archive", "offset", "length").mapInArrow(
        run, "ident string, kind string, target string, refers_to string, size long, digest string, payload binary")


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows for ``write_monolithic``: which page holds a payload, and which refer to it."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    often = (rows.where(F.col("size") >= min_revisit).groupBy(F.col("digest").alias("of"))
             .agg(F.min("id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1 AND holder IS NOT NULL"))
    ident = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.join(often, F.col("digest") == F.col("of"), "left").select(
        ident("id").alias("ident"), "target", "payload", "digest", "size",
        F.when(F.col("holder").isNotNull() & ~F.col("id").eqNullSafe(F.col("holder")), ident("holder")).alias("refers_to"))


def archive_pages(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write pages as monolithic archives, normalise them, and return the normalised files' table."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return normalise(write_monolithic(page_records(pages, id_col, **options), f"{folder}/monolithic"), f"{folder}/normalised")


def archived(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """One row per page from its archive: payload_bytes, payload_digest, record_type, refers_to."""
    id_type = pages.schema[id_col].dataType
    back = read_records(read_index(archive_pages(pages, id_col, **options)), payloads=False)
    number = lambda c: F.nullif(F.substring(c, len("urn:page:") + 1, 1 << 30), F.lit("")).cast(id_type)
    return back.select(number("ident").alias(id_col), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                       F.col("kind").alias("record_type"), number("refers_to").alias("refers_to"))
