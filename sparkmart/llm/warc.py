"""WARC archives: writing, normalising monolithic gzip files, random access.

Some tools gzip a whole WARC file as one stream, so that no record can be
read without inflating everything before it.  :func:`normalise` inflates such
a file once, rewrites every record as a gzip member of its own and writes a
sidecar index with each member's offset and length; :func:`read_records`
then reads single records by seeking.  A file is one task's work (a single
gzip stream cannot be split); Spark spreads the files.  Records are copied in
chunks, so memory does not follow the size of a record.

Tasks write under names of their own attempt.  Only what a task returns names
its files, and that is written as a table, so a task that is lost and run
again leaves an unnamed file behind and no duplicate.  Folders are on the
shared storage (``file:``, or any scheme that pyarrow's file systems know).

Defined cases: a null page is an empty payload; a null url has no target
header; line breaks in a url are percent-encoded, and it may be of any length;
null page ids are written as ``none`` and read back as null, and such a page
revisits the smallest id with its payload, if any page with an id has it; empty tables give empty archives or none.
A truncated or malformed archive is an error that names the file.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import bound_batches, col, materialize
from sparkmart.session import scratch_path

CHUNK = 1 << 20
BITMAP = 1 << 23  # bits of the filter on repeated payloads
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "archive string, offset long, length long, record_id string, "
    "record_type string, target_uri string"
)
MANIFEST = "archive string, records long, bytes long"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file given as URI or path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


# -- records -----------------------------------------------------------------


def payload_bytes(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def mark_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = 100,
) -> DataFrame:
    """``(id, url, payload, digest, refers_to)``: of pages with equal payloads
    of at least ``least`` bytes, the smallest id is the original (null
    ``refers_to``) and the others refer to it.  Rows that repeat the original's
    id too are originals themselves.

    The smallest id per digest is combined map-side, so a payload that a third
    of the pages share costs a row per task.  A bitmap of ``BITMAP`` bits over
    the repeated digests, broadcast as at most ``BITMAP / 64`` rows, tells most
    pages that their payload is the only one; the others' payloads are shuffled
    to meet their original's id.
    """
    rows = pages.select(
        col(id_col).cast("long").alias("id"),
        col(url_col).alias("url"),
        payload_bytes(col(html_col)).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    first = materialize(first, "repeated-digests")
    place = F.pmod(F.xxhash64("digest"), F.lit(BITMAP))
    bits = (
        first.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits"))
    )
    rows = rows.withColumn("p", place).withColumn("word", F.shiftright("p", 6))
    rows = rows.join(F.broadcast(bits), "word", "left")
    several = F.expr("coalesce(bits & shiftleft(1L, int(p & 63)), 0L) <> 0")
    alone = rows.filter(~several).withColumn("first", F.lit(None).cast("long"))
    others = rows.filter(several).join(first, "digest", "left")
    names = ["id", "url", "payload", "digest", "first"]
    return alone.select(names).unionByName(others.select(names)).select(
        "id", "url", "payload", "digest",
        F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"),
    )


def record_parts(page, url, payload, digest, refers_to, date: str) -> list[bytes]:
    """One WARC record: head, block (an HTTP message), end."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {uri}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ["\r\n".join(head).encode() + b"\r\n\r\n", body, b"\r\n\r\n"]


def write_archives(
    records: DataFrame, folder: str, monolithic: bool = True,
    date: str = "1970-01-01T00:00:00Z", roll_bytes: int = 256 << 20,
) -> DataFrame:
    """Write ``records`` (as of :func:`mark_revisits`) as ``.warc.gz`` files of
    up to about ``roll_bytes`` of plain bytes, and return the written list of
    files ``(archive, records, bytes)``.  ``monolithic`` gzips a whole file as
    one stream; otherwise every record is a member of its own.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    gz, n, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                for part in record_parts(**row, date=date):
                    out.write(gz.compress(part))
                    size += len(part)
                n += 1
                if not monolithic:
                    out.write(gz.flush())
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                if size >= roll_bytes:
                    yield closed(out, gz, name, n, size)
                    out = None
        if out is not None:
            yield closed(out, gz, name, n, size)

    def closed(out, gz, name: str, n: int, size: int) -> pa.RecordBatch:
        if monolithic:
            out.write(gz.flush())
        out.close()
        return pa.RecordBatch.from_pydict(
            {"archive": [f"{folder}/{name}"], "records": [n], "bytes": [size]}
        )

    bound_batches(records)
    rows = records.select(
        F.col("id").alias("page"), "url", "payload", "digest", "refers_to"
    )
    return materialize(rows.mapInArrow(write, MANIFEST), "warc-files")


# -- reading streams -----------------------------------------------------------


class Stream:
    """The plain bytes of a gzip file (one member or many), read once, in
    bounded pieces."""

    def __init__(self, source, name: str):
        self.source, self.name = source, name
        self.gz = zlib.decompressobj(31)
        self.raw, self.buffer = b"", b""
        self.started = False

    def more(self) -> bool:
        """Inflate up to a chunk more; False at the end of the file."""
        while True:
            if self.gz.eof:
                self.raw = self.gz.unused_data or self.source.read(CHUNK)
                if not self.raw:
                    return False
                self.gz, self.started = zlib.decompressobj(31), False
            elif not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    if self.started:
                        raise ValueError(f"{self.name}: the gzip stream is truncated")
                    return False
            try:
                got = self.gz.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise ValueError(f"{self.name}: {e}") from e
            self.started = True
            self.raw = self.gz.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def head(self) -> bytes | None:
        """The next record's head with its blank line; None at the end."""
        seen = 0
        while True:
            cut = self.buffer.find(b"\r\n\r\n", seen)
            if cut >= 0:
                head, self.buffer = self.buffer[: cut + 4], self.buffer[cut + 4 :]
                return head
            seen = max(0, len(self.buffer) - 3)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError(f"{self.name}: the last record is cut off")
                return None

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError(f"{self.name}: the last record is cut off")
            piece, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(piece)
            yield piece


def fields_of(head: bytes, name: str) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"{name}: a record begins with {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def normalise(archives: DataFrame, folder: str, archive_col: str = "archive") -> DataFrame:
    """Rewrite every gzip WARC named in ``archives`` with one member a record
    into ``folder``, each with a sidecar ``.idx`` of JSON lines, and return the
    written index ``(archive, offset, length, record_id, record_type,
    target_uri)`` of all of them.
    """
    schema_names = [x.split()[0] for x in INDEX.split(", ")]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if name is not None:
                    yield from rewrite_file(name)

    def rewrite_file(name: str) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(name)
        target, root = open_folder(folder)
        target.create_dir(root, recursive=True)
        stem = f"{path.rpartition('/')[2].removesuffix('.gz').removesuffix('.warc')}-{uuid.uuid4().hex}"
        new, rows, offset = f"{folder}/{stem}.warc.gz", [], 0
        with (
            files.open_input_stream(path, compression=None) as source,
            target.open_output_stream(f"{root}/{stem}.warc.gz", compression=None) as out,
            target.open_output_stream(f"{root}/{stem}.idx", compression=None) as side,
        ):
            stream = Stream(source, name)
            while (head := stream.head()) is not None:
                f = fields_of(head.lstrip(b"\r\n"), name)
                gz, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
                body = stream.take(int(f["content-length"]))
                for piece in chain([head.lstrip(b"\r\n")], body):
                    data = gz.compress(piece)
                    out.write(data)
                    length += len(data)
                end = b"".join(stream.take(4))
                if end != b"\r\n\r\n":
                    raise ValueError(f"{name}: a record does not end in a blank line")
                data = gz.compress(end) + gz.flush()
                out.write(data)
                length += len(data)
                row = (new, offset, length, f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"))
                side.write(json.dumps(dict(zip(schema_names[1:], row[1:], strict=True))).encode() + b"\n")
                rows.append(row)
                offset += length
                if len(rows) == 4096:
                    yield as_batch(rows)
                    rows = []
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(schema_names, zip(*rows, strict=True), strict=True)))

    names = archives.select(col(archive_col).alias("archive"))
    n = max(1, names.count())
    return materialize(names.repartition(n).mapInArrow(rewrite, INDEX), "warc-index")


RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` lists, each by one seek and one inflated
    member.  Digest and length are computed from a response's payload (a
    digest that differs from the header is an error); a revisit's come from
    its headers, which describe the full payload it refers to."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = name = None
        for batch in batches:
            rows, size = [], 0
            for r in batch.to_pylist():
                if r["archive"] != name:
                    if source is not None:
                        source.close()
                    name = r["archive"]
                    files, path = open_folder(name)
                    source = files.open_input_file(path)
                source.seek(r["offset"])
                raw = zlib.decompress(source.read(r["length"]), 31)
                rows.append(parsed(raw, name))
                size += len(raw) if with_payload else 0
                if size > 8 << 20:
                    yield as_batch(rows)
                    rows, size = [], 0
            if rows:
                yield as_batch(rows)
        if source is not None:
            source.close()

    def parsed(raw: bytes, name: str) -> tuple:
        head, _, rest = raw.partition(b"\r\n\r\n")
        f = fields_of(head + b"\r\n", name)
        block = rest[: int(f["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = f.get("warc-payload-digest", "").removeprefix("sha256:") or None
        if f.get("warc-type") == "revisit":
            m = re.search(rb"(?im)^content-length:\s*(\d+)", http)
            n, payload = int(m[1]) if m else None, None
        else:
            found, n = hashlib.sha256(payload).hexdigest(), len(payload)
            if digest not in (None, found):
                raise ValueError(f"{name}: the payload of {f.get('warc-record-id')} has changed")
            digest = found
        return (
            f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"),
            f.get("warc-refers-to"), digest, n, payload if with_payload else None,
        )

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        cols = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(cols, names)

    return index.select("archive", "offset", "length").mapInArrow(read, RECORD)


def page_of(record_id: Column) -> Column:
    """The page id in a record id of :func:`write_archives` (null for none)."""
    digits = F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(digits != "", digits).cast("long")


def archive_pages(pages: DataFrame, with_payload: bool = True, **columns) -> DataFrame:
    """Round trip of a table of pages: monolithic archives, normalised and
    indexed, read back by offset.  Returns :data:`RECORD` rows."""
    spark = pages.sparkSession
    written = write_archives(mark_revisits(pages, **columns), scratch_path(spark, "warc-in"))
    index = normalise(written, scratch_path(spark, "warc-out"))
    return read_records(index, with_payload)
