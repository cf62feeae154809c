"""WARC archives: writing, reading, and revisit resolution by payload digest.

Archives are gzip files with one member per record, so a record can be read alone by
its offset.  A task writes files of its own under fresh names and returns their names;
only names that reached the stored manifest are read.  A file left by a lost attempt is
never seen.  Folders may be on any file system that Arrow opens by URI.

Defined results: a null payload is empty; a null address or page number leaves out its
header and reads back as null; among repeated rows with one payload a single record is
the response; an empty table gives archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, shuffle_width
from keelson.session import materialize, scratch_path

#: A new archive begins after so many compressed bytes.
ARCHIVE_BYTES = 256 << 20
#: Smaller payloads are stored again rather than referred to.
LEAST_SHARED_BYTES = 1000
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "path string, records long"
_HEADER = ("record_id string, record_type string, page_id long, uri string, payload_bytes long, "
           "payload_digest string, refers_to_record string, path string, offset long, length long")


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; names are compared in lower case."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record ends at the wrong place")
    return headers, rest[:size]


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of each gzip member, one at a time."""
    buffer, at = b"", 0
    while True:
        unpack, start, parts = zlib.decompressobj(31), at, []
        while not unpack.eof:
            buffer = buffer or stream.read(1 << 16)
            if not buffer:
                if at == start:
                    return
                raise ValueError("an archive ends inside a record")
            parts.append(unpack.decompress(buffer))
            at += len(buffer) - len(unpack.unused_data)
            buffer = unpack.unused_data
        yield start, at - start, b"".join(parts)


class Archives:
    """The archives that one task writes."""

    def __init__(self, folder: str, level: int = 6):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.prefix = folder.rstrip("/")
        self.level, self.sink, self.done = level, None, []

    def add(self, raw: bytes) -> None:
        if self.sink is None:
            self.fs.create_dir(self.folder, recursive=True)
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.sink, self.records = self.fs.open_output_stream(
                f"{self.folder}/{name}", compression=None), 0
            self.path = f"{self.prefix}/{name}"
        pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self.sink.write(pack.compress(raw) + pack.flush())
        self.records += 1
        if self.sink.tell() >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.done.append((self.path, self.records))
            self.sink = None

    def batch(self) -> pa.RecordBatch:
        self.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in self.done], pa.string()), pa.array([x[1] for x in self.done], pa.int64())],
            names=["path", "records"])


def _line(value: str) -> str:
    """A header value stays on its line."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in value)


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _response(record_id: str, page: str | None, uri: str | None, date: str, block: bytes, digest: str) -> bytes:
    own = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    own += [("WARC-Target-URI", uri)] if uri is not None else []
    own += [("Page-Number", page)] if page is not None else []
    return record([*own, ("WARC-Payload-Digest", digest),
                   ("Content-Type", "application/http; msgtype=response")], block)


def write_pages(pages: DataFrame, page: str = "page_id", uri: str = "url", payload: str = "html",
                date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One response record per row; returns the stored manifest ``path, records``."""
    folder = scratch_path(pages.sparkSession, "warc")

    def write(batches):
        out = Archives(folder)
        for batch in batches:
            for number, address, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = (body or "").encode()
                http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(body)}\r\n\r\n").encode()
                out.add(_response(f"<urn:uuid:{uuid.uuid4()}>", None if number is None else str(number),
                                  None if address is None else _line(address), date, http + body, _digest(body)))
        yield out.batch()

    columns = named(page=page, uri=uri, payload=payload)
    return materialize(pages.select(*columns).mapInArrow(write, _MANIFEST), "manifest")


def read_headers(manifest: DataFrame, check: bool = True) -> DataFrame:
    """A row per record: its headers and where it lies.  ``check`` recomputes digests of payloads."""
    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = pafs.FileSystem.from_uri(path)
                rows = []
                with fs.open_input_stream(place, compression=None) as stream:
                    for offset, length, raw in members(stream):
                        rows.append(_header_row(*parse(raw), path, offset, length, check))
                        if len(rows) == 1000:
                            yield _header_batch(rows)
                            rows = []
                yield _header_batch(rows)

    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(read, _HEADER)


def _header_row(h, block, path, offset, length, check):
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = h["warc-payload-digest"]
    if h["warc-type"] == "response":
        size = len(payload)
        if check and _digest(payload) != digest:
            raise ValueError(f"the payload of {h['warc-record-id']} is damaged")
    else:
        size = next((int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")), None)
    page = h.get("page-number")
    return (h["warc-record-id"], h["warc-type"], None if page is None else int(page), h.get("warc-target-uri"), size,
            base64.b32decode(digest.removeprefix("sha1:")).hex(), h.get("warc-refers-to"), path, offset, length)


def _header_batch(rows) -> pa.RecordBatch:
    s, i = pa.string(), pa.int64()
    types = [s, s, i, s, i, s, s, s, i, i]
    names = [part.split()[0] for part in _HEADER.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def plan_revisits(headers: DataFrame, least_bytes: int = LEAST_SHARED_BYTES) -> DataFrame:
    """Adds the original of each record that is to be a revisit: ``original_record, original_uri``.

    Only responses hold a payload, so only a response becomes an original.  Other
    responses of its payload become revisits if it is large enough; records that are
    revisits already, from archives deduplicated before, refer to the original of
    their digest, whatever its size, and stay unresolved if no archive holds one.

    Headers only are shuffled by digest.  Each task first reduces a digest to one
    candidate; the join of records to originals can be split where one digest is hot.
    """
    headers = materialize(headers, "headers")
    # Stored, so that both sides of the join are plain shuffles and a hot digest can be split.
    answer = F.when(F.col("record_type") == "response", F.struct("page_id", "record_id", "uri"))
    originals = (headers.groupBy("payload_digest").agg(F.max(answer).alias("o"), F.count("*").alias("n"))
                 .filter("n > 1 and o is not null").select("payload_digest", F.col("o.record_id").alias("original_record"),
                                                           F.col("o.uri").alias("original_uri")))
    originals = materialize(originals, "originals")
    joined = headers.join(originals.hint("merge"), "payload_digest", "left")
    own = F.col("original_record") == F.col("record_id")
    refers = (F.col("record_type") == "revisit") | ((F.col("payload_bytes") >= least_bytes) & ~own)
    return joined.select("record_id", "path", "offset", "length", *(
        F.when(refers, F.col(c)).alias(c) for c in ("original_record", "original_uri")))


def fresh_id(record_id: str) -> str:
    """The id of a record's successor in the rewritten archives; the same on every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record_id)}>"


def write_deduplicated(planned: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes responses and revisits with fresh headers; returns the stored manifest.

    Rows are brought to the archive they come from, so each file is read in order.
    """
    spark = planned.sparkSession
    folder = scratch_path(spark, "warc-deduplicated")

    def write(batches):
        out, path, source = Archives(folder), None, None
        for batch in batches:
            for old, where, offset, length, original, address in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if where != path:
                    if source is not None:
                        source.close()
                    fs, place = pafs.FileSystem.from_uri(where)
                    path, source = where, fs.open_input_file(place)
                headers, block = parse(zlib.decompress(source.read_at(length, offset), 31))
                page, uri, digest = headers.get("page-number"), headers.get("warc-target-uri"), headers["warc-payload-digest"]
                if original is None and headers["warc-type"] == "response":
                    out.add(_response(fresh_id(old), page, uri, date, block, digest))
                    continue
                # The response of an unresolved revisit is in none of these archives and keeps its name.
                target = headers.get("warc-refers-to") if original is None else fresh_id(original)
                address = headers.get("warc-refers-to-target-uri") if original is None else address
                own = [("WARC-Type", "revisit"), ("WARC-Record-ID", fresh_id(old)), ("WARC-Date", date)]
                own += [("WARC-Target-URI", uri)] if uri is not None else []
                own += [("Page-Number", page)] if page is not None else []
                own += [("WARC-Profile", REVISIT_PROFILE)]
                own += [("WARC-Refers-To", target), ("WARC-Refers-To-Date", date)] if target is not None else []
                own += [("WARC-Refers-To-Target-URI", address)] if address is not None else []
                own += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
                out.add(record(own, block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"))
        if source is not None:
            source.close()
        yield out.batch()

    rows = planned.select("record_id", "path", "offset", "length", "original_record", "original_uri")
    rows = rows.repartition(shuffle_width(spark), "path").sortWithinPartitions("path", "offset")
    return materialize(rows.mapInArrow(write, _MANIFEST), "manifest")


def resolve(headers: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the page number of the response that a revisit stands for.

    Null where the archives hold no such response.
    """
    answers = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    return headers.join(answers.hint("merge"), "refers_to_record", "left")


def deduplicate(pages: DataFrame, **names: str) -> DataFrame:
    """Pages to archives, archives to deduplicated archives; the headers of the latter."""
    planned = plan_revisits(read_headers(write_pages(pages, **names)))
    return resolve(materialize(read_headers(write_deduplicated(planned)), "headers"))
