"""WARC archives: one compressed member per record, and a reader that salvages what damage leaves.

The reader checks every record: the member's checksum, the header block, the
content length and the digests. Where a check fails it searches on for the next
member, or version line in a plain archive, at which a valid record begins, goes
on there, and logs the bytes between as a gap with the reason.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import file_system, publish
from gleaner.session import materialised, scratch_dir

#: A file is closed once it holds this many compressed bytes.
FILE_BYTES = 32 << 20
#: Archives are read in ranges of this size; a record belongs to the range it begins in.
RANGE_BYTES = 64 << 20
CHUNK = 1 << 18
#: A header block of a plain archive is read in steps of this size until its end is found.
HEADER_BYTES = 1 << 16
MAGIC, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    """A record: its place (compressed bytes in a compressed archive), headers and block."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        """(HTTP headers, payload) of the block."""
        head, _, payload = self.block.partition(END)
        return _fields(head.split(b"\r\n")[1:]), payload


@dataclass
class Gap:
    """Quarantined bytes from ``start`` to ``end``."""

    start: int
    end: int
    reason: str


class _Damage(Exception):
    pass


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in a plain archive."""
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + END


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own; equal records give equal bytes."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """The response of a page, or a revisit of an equal one, which carries the HTTP header but not the payload."""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "about:blank")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record_bytes(headers, http + payload if refers_to is None else http)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"



def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def salvage(read_at: Callable[[int, int], bytes], size: int, start: int = 0, stop: int | None = None) -> Iterator[Record | Gap]:
    """Valid records that begin in [start, stop) and the gaps after them, in order of place.

    ``read_at(n, offset)`` gives up to n bytes. From a ``start`` above 0 the first
    valid record at or after it is searched without logging a gap, as those bytes
    belong to the range before.
    """
    stop = size if stop is None else min(stop, size)
    at = start
    if start:
        at = _next_valid(read_at, size, start)
    while at < stop:
        try:
            record = _record(read_at, size, at)
        except _Damage as damage:
            end = _next_valid(read_at, size, at + 1)
            yield Gap(at, end, str(damage))
            at = end
        else:
            yield record
            at = record.end


def _next_valid(read_at: Callable[[int, int], bytes], size: int, at: int) -> int:
    """The first place from ``at`` on where a valid record begins; the end where there is none."""
    while at < size:
        chunk = read_at(CHUNK, at)
        found = min((k for k in (chunk.find(MAGIC), chunk.find(VERSION)) if k >= 0), default=-1)
        if found < 0:
            at += max(1, len(chunk) - len(VERSION) + 1)
            continue
        at += found
        try:
            _record(read_at, size, at)
            return at
        except _Damage:
            at += 1
    return size


def _record(read_at: Callable[[int, int], bytes], size: int, at: int) -> Record:
    """The valid record at ``at``; raises _Damage."""
    head = read_at(len(VERSION), at)
    if head.startswith(MAGIC):
        data, end = _member_at(read_at, size, at)
        headers, body = _header(data)
        length = _content_length(headers)
        if len(data) != body + length + len(END):
            raise _Damage("content length does not match the member")
        block, tail = data[body : body + length], data[body + length :]
    elif head == VERSION:
        headers, body = _header(_header_bytes(read_at, at))
        length = _content_length(headers)
        end = at + body + length + len(END)
        if end > size:
            raise _Damage("the file ends inside the record")
        rest = read_at(length + len(END), at + body)
        block, tail = rest[:length], rest[length:]
    else:
        raise _Damage("no member or version line")
    if tail != END:
        raise _Damage("no record end where the content length puts it")
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != base32_sha1(block):
        raise _Damage("the block digest does not match")
    return Record(at, end, headers, block)


def _member_at(read_at: Callable[[int, int], bytes], size: int, at: int) -> tuple[bytes, int]:
    unpack = zlib.decompressobj(31)
    parts, place = [], at
    try:
        while not unpack.eof:
            raw = read_at(CHUNK, place)
            if not raw:
                raise _Damage("the file ends inside the member")
            out = unpack.decompress(raw)
            if not parts and out and not out.startswith(VERSION[: len(out)]):
                raise _Damage("the member holds no record")
            parts.append(out)
            place += len(raw)
    except zlib.error as error:
        raise _Damage(f"the member is damaged: {error}") from None
    return b"".join(parts), place - len(unpack.unused_data)


def _header_bytes(read_at: Callable[[int, int], bytes], at: int) -> bytes:
    """What stands from ``at`` on, at least up to the end of the header block where there is one."""
    held = bytearray()
    while raw := read_at(HEADER_BYTES, at + len(held)):
        searched = max(0, len(held) - len(END) + 1)
        held += raw
        if held.find(END, searched) >= 0:
            break
    return bytes(held)


def _header(data: bytes) -> tuple[dict[str, str], int]:
    end = data.find(END)
    if not data.startswith(VERSION) or end < 0:
        raise _Damage("no complete header block")
    headers = _fields(data[:end].split(b"\r\n")[1:])
    if not {"warc-type", "warc-record-id", "content-length"} <= headers.keys():
        raise _Damage("a required header is missing")
    return headers, end + len(END)


def _content_length(headers: dict[str, str]) -> int:
    if not headers["content-length"].isdecimal():
        raise _Damage("the content length is not a number")
    return int(headers["content-length"])


FILE_COLUMNS = "path string, bytes long, n_records long"
RECORD_COLUMNS = (
    "path string, start long, end long, problem string, record_id string, record_type string, url string, "
    "payload_bytes long, payload_digest string, refers_to string"
)


def write_pages(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2025-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) into compressed archives; one row per file (FILE_COLUMNS).

    Of rows whose payloads are equal and have at least ``min_bytes`` bytes, the
    one with the largest page_id is a response, and the others are revisits of it; so are null page_ids.
    Repeated rows with that page_id are responses all. A group of null page_ids only are responses. A null html is an empty
    payload, a null url is about:blank. Materialise the rows, so as to write once.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    coded = pages.select("page_id", "url", payload.alias("payload")).withColumn("code", F.sha1("payload"))
    # Digests first: only groups of equal payloads are joined, and the html need not be shuffled where those are few.
    groups = (
        coded.where(F.octet_length("payload") >= min_bytes)
        .groupBy("code")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("code", "first")
    )
    joined = coded.join(materialised(groups, "equal"), "code", "left").select(
        "page_id", "url", "payload", "code", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        members, size, number = [], 0, 0

        def close() -> pa.RecordBatch:
            path = f"{name}-{number:04d}.warc.gz"
            total = publish(path, lambda stream: [stream.write(m) for m in members])
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([total]), pa.array([len(members)])], names=["path", "bytes", "n_records"])

        for batch in batches:
            for k in range(batch.num_rows):
                page, url, body, code, refers = (batch.column(c)[k].as_py() for c in range(5))
                digest = base64.b32encode(bytes.fromhex(code)).decode()
                members.append(member(page_record(page, url, body, digest, refers, date)))
                size += len(members[-1])
                if size >= FILE_BYTES:
                    yield close()
                    members, size, number = [], 0, number + 1
        if members:
            yield close()

    return joined.mapInArrow(written, FILE_COLUMNS)


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records and gaps of archives (path, bytes), as RECORD_COLUMNS; a gap has a ``problem`` and no record fields.

    Large archives are read by several tasks. ``payload_digest`` is computed from
    the payload where there is one and is the stated one for revisits;
    ``payload_bytes`` of a revisit is what its HTTP header says.
    """
    parts = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = files.select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes))).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, place = file_system(row["path"])
                with store.open_input_file(place) as f:
                    found = []
                    for item in salvage(lambda n, at: f.read_at(n, at), row["bytes"], row["start"], row["start"] + range_bytes):  # noqa: B023
                        found.append(_row(row["path"], item))
                        if len(found) == 1024:
                            yield _rows(found)
                            found = []
                    if found:
                        yield _rows(found)

    return ranges.repartition(parts, "path", "start").mapInArrow(read, RECORD_COLUMNS)


def _row(path: str, item: Record | Gap) -> tuple:
    if isinstance(item, Gap):
        return (path, item.start, item.end, item.reason, None, None, None, None, None, None)
    headers = item.headers
    http, payload = item.http()
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    problem = None
    if headers["warc-type"] == "revisit":
        size, digest = int(http.get("content-length", "0")), stated
    else:
        size, digest = len(payload), base32_sha1(payload)
        if stated and stated != digest:
            problem = "the payload digest does not match"
    return (
        path, item.start, item.end, problem, headers["warc-record-id"], headers["warc-type"], headers.get("warc-target-uri"),
        size, digest, headers.get("warc-refers-to"),
    )


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)


def page_table(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes archives of ``pages`` below ``folder`` and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Fresh archives have no gaps and no records with a problem; fewer valid records than were written are an error.
    """
    folder = folder or scratch_dir(spark, "warc")
    write_pages(pages, f"{folder}/data").write.parquet(f"{folder}/files")
    files = spark.read.parquet(f"{folder}/files")
    records = materialised(read_archives(files).where("problem IS NULL"), "records")
    n_written, n_read = files.agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0], records.count()
    if n_read != n_written:
        raise RuntimeError(f"{n_written} records were written to {folder} and {n_read} read back")
    number = r"^<urn:page:(-?\d+)>$"

    def page(urn: str):
        return F.when(F.col(urn).rlike(number), F.regexp_extract(urn, number, 1).cast("long"))

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
