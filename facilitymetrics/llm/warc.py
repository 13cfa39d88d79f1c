"""WARC archives of pages, and a reader that salvages what damage leaves.

Writing: payloads are addressed by SHA-1.  Of the records with equal payloads one is a
``response``, the others are ``revisit`` records that refer to it.  Each task joins its records to
pieces of about ``FILE_BYTES`` and Spark's writer commits every piece as one gzip file,
so files are bounded and a repeated task attempt leaves none behind.

Reading: a record counts when its version line, header, length, end mark and digests are right.
After a failed check the reader searches for the next gzip member or version line that begins a
valid record, goes on there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_BYTES = 8 << 20
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Records carry no wall-clock time, so that equal pages give equal archives.
_DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record without its end mark."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        # Line ends cannot be part of a header.
        "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url or ""),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines[4:4] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join(lines).encode() + END + block


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """A record for every row of ``pages``, in gzip files below ``path``.

    A null payload is empty, a null address an empty one.  Among equal payloads the one with
    the largest id is the response.  Rows that repeat both id and payload are responses all,
    as are rows without id whose payload no row with an id has.
    """
    content = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), content.alias("html"), F.sha1(content).alias("key")
    )
    several = rows.groupBy("key").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(several.select("key", "response"), "key", "left")
    first = F.col("response").isNull() | F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.select("page_id", "url", "html", "response", (~first).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(5))):
                at, where, text, response, revisit = (x.as_py() for x in row)
                held.append(record(at, where, text.encode(), response, revisit))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield _piece(held)
                    held, size = [], 0
        if held:
            yield _piece(held)

    # The text writer ends each piece with the line separator, which is a record's end mark.
    rows.mapInArrow(run, "value string").write.option("lineSep", END.decode()).option(
        "maxRecordsPerFile", 1
    ).option("compression", "gzip").text(path)


def _piece(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([END.join(records).decode()], pa.string())], names=["value"])


@dataclass
class Found:
    """A record, or a gap when ``kind`` is ``gap``; ``start:end`` are bytes of the decoded stream."""

    kind: str
    start: int
    end: int
    header: dict[str, str]
    payload: bytes = b""
    reason: str = ""


def _record_at(data: bytes, at: int) -> Found | str:
    """The valid record that begins here, or what is wrong with it."""
    if not _VERSION.match(data, at):
        return "no version line"
    stop = data.find(END, at)
    if stop < 0:
        return "header without end"
    header = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "malformed header"
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not length.isdigit():
        return "no length"
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != END:
        return "wrong length or truncated"
    block = data[begin:end]
    if header.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        return "wrong block digest"
    kind = header.get("warc-type", "")
    payload = block.partition(END)[2] if header.get("content-type", "").startswith("application/http") else block
    wanted = header.get("warc-payload-digest")
    if kind != "revisit" and wanted is not None and wanted != f"sha1:{digest(payload)}":
        return "wrong payload digest"
    return Found(kind, at, end + 4, header, payload)


def plain_records(data: bytes) -> Iterator[Found]:
    """Records and gaps of an uncompressed archive."""
    at = 0
    while at < len(data):
        here = _record_at(data, at)
        if isinstance(here, Found):
            yield here
            at = here.end
            continue
        after = at + 1
        while True:
            found = _VERSION.search(data, after)
            if not found:
                after = len(data)
                break
            after = found.start()
            if isinstance(_record_at(data, after), Found):
                break
            after += 1
        yield Found("gap", at, after, {}, reason=here)
        at = after


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Decoded bytes of the gzip member at ``at``, where it ends, and what went wrong."""
    unpack = zlib.decompressobj(31)
    out, step = [], 1 << 16
    for start in range(at, len(data), step):
        before = unpack.copy()
        try:
            out.append(unpack.decompress(data[start : start + step]))
        except zlib.error as error:
            # What the damaged member still gives, byte by byte of the last step.
            end = start
            with contextlib.suppress(zlib.error):
                while end < len(data):
                    out.append(before.decompress(data[end : end + 1]))
                    end += 1
            return b"".join(out), end, str(error)
        if unpack.eof:
            return b"".join(out), min(start + step, len(data)) - len(unpack.unused_data), ""
    return b"".join(out), len(data), "truncated member"


def _key(x: Found) -> tuple:
    return x.kind, tuple(x.header.items()), digest(x.payload)


def _next_member(data: bytes, at: int) -> int:
    """The next gzip member from ``at`` on that gives a valid record."""
    while (at := data.find(MEMBER, at)) >= 0:
        if any(x.kind != "gap" for x in plain_records(_member(data, at)[0])):
            return at
        at += 1
    return len(data)


def _next_plain(data: bytes, at: int, to: int, given: set, end: int) -> int:
    """The next valid version line of ``at:to``, without records before ``end`` that are ``given``."""
    while (found := _VERSION.search(data, at)) and found.start() < to:
        here = _record_at(data, found.start())
        if isinstance(here, Found):
            if here.start >= end or _key(here) not in given:
                return here.start
            at = here.end
        else:
            at = found.start() + 1
    return to


def records(data: bytes) -> Iterator[Found]:
    """Records and gaps of an archive of gzip members (of one or more records), plain records, or both."""
    at, member = 0, -1
    while at < len(data):
        # Records of a damaged member; one that stores its bytes shows them plainly as well.
        given, end = set(), at
        if data.startswith(MEMBER, at):
            decoded, end, wrong = _member(data, at)
            for x in plain_records(decoded):
                if wrong and x.kind != "gap":
                    given.add(_key(x))
                yield x
            if not wrong:
                at = end
                continue
        else:
            here = _record_at(data, at)
            if isinstance(here, Found):
                yield here
                at = here.end
                continue
            wrong = here
        if member <= at:
            member = _next_member(data, at + 1)
        after = _next_plain(data, at + 1, member, given, end)
        yield Found("gap", at, after, {}, reason=wrong)
        at = after


_ROWS = (
    "file string, kind string, start long, length long, reason string, record_id string, url string, "
    "refers_to string, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps below ``path``; ``kind`` is the record type, or ``gap`` with a ``reason``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    names = [x.split(" ")[0] for x in _ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, held, size = batch.column(0)[k].as_py(), [], 0
                for x in records(batch.column(1)[k].as_py()):
                    h = x.header
                    held.append((
                        file, x.kind, x.start, x.end - x.start, x.reason or None, h.get("warc-record-id"),
                        h.get("warc-target-uri"), h.get("warc-refers-to"),
                        h.get("warc-payload-digest", "").removeprefix("sha1:") or None, x.payload,
                    ))
                    size += len(x.payload)
                    if size >= FILE_BYTES:
                        yield _rows(held, names)
                        held, size = [], 0
                if held:
                    yield _rows(held, names)

    return files.mapInArrow(run, _ROWS)


def _rows(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)
