"""WARC archives: a writer, and a reader that salvages what damage leaves.

Each record is a gzip member of its own (or plain), with digests of its block and of its payload. Of records with
equal payloads one is the response and the others revisit it. The reader checks lengths, digests and the members' own
checksums; where a check fails it looks for the next valid member or version line, goes on from there and lists
the bytes in between as quarantined.

Archives are written by Spark's own text writer, a record a row: the line separator is an empty gzip member (or the
two line ends that close a record), so the files are plain concatenations on any file system Spark knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import in_slices, run_folder, saved, ship_package

# Fixed values of the formats.
VERSION = b"WARC/1.1"
_MEMBER = b"\x1f\x8b\x08"
_EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
_CLOSE = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The largest record that a column can hold; beyond it a length is taken for damage.
MOST_BYTES = (1 << 31) - 1

_BEGIN = re.compile(rb"WARC/1\.[01]\r\n")
_LINE = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*([^\r\n]*)")
_HEAD = re.compile(_BEGIN.pattern + rb"(?:" + _LINE.pattern + rb"\r\n)*+")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_safe(text: str) -> str:
    """A value for a header line: anything but printable ASCII is percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record without the two line ends that close it. A revisit has the reply's header alone, which names the length."""
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    )
    if not is_revisit:
        block += payload
    lines = [
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_header_safe(url or '')}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def member(data: bytes) -> bytes:
    """``data`` as a gzip member."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


@dataclass
class Record:
    """A record; ``offset`` and ``length`` are those of its bytes in the file, for one in a member those of the member."""

    offset: int
    headers: dict[str, str]
    payload: bytes
    http: dict[str, str] = field(default_factory=dict)
    length: int = 0


@dataclass
class Gap:
    """Bytes of the file that no record was read from, and the check that failed first.

    In a member ``inside`` is the span of its inflated bytes that was lost. A member that gave a record as well is
    counted by the record, so the gap has no length of its own: records and gaps cover the file.
    """

    offset: int
    length: int
    reason: str
    inside: tuple[int, int] | None = None


class Damage(Exception):
    pass


def _fields(data: bytes) -> dict[str, str]:
    found = {}
    for line in data.split(b"\r\n")[1:]:
        m = _LINE.fullmatch(line)
        if not m:
            raise Damage("header line")
        found[m[1].decode().lower()] = m[2].decode("utf-8", "replace").strip()
    return found


def parse(data: bytes | memoryview, at: int = 0) -> tuple[Record, int]:
    """The record that begins at ``at``, and where the next one would begin; ``Damage`` if a check fails."""
    view = memoryview(data)
    # As far as there are header lines, however long: no more than the header itself is looked at.
    head = _HEAD.match(view, at)
    if not head:
        raise Damage("version line")
    if bytes(view[head.end() : head.end() + 2]) != b"\r\n":
        raise Damage("header end")
    stop = head.end() - 2 - at
    headers = _fields(bytes(view[at : at + stop]))
    length = headers.get("content-length", "")
    if not length.isdecimal() or int(length) > MOST_BYTES:
        raise Damage("length")
    begin, end = at + stop + 4, at + stop + 4 + int(length)
    block = bytes(view[begin:end])
    if len(block) < int(length) or bytes(view[end : end + 4]) != _CLOSE:
        raise Damage("length")
    if (want := headers.get("warc-block-digest")) and want != f"sha1:{base32_sha1(block)}":
        raise Damage("block digest")
    http, payload = {}, block
    if headers.get("content-type", "").startswith("application/http"):
        stop = block.find(_CLOSE)
        if stop < 0:
            raise Damage("reply header")
        http, payload = _fields(block[:stop]), block[stop + 4 :]
    if headers.get("warc-type") == "response" and (want := headers.get("warc-payload-digest")):
        if want != f"sha1:{base32_sha1(payload)}":
            raise Damage("payload digest")
    return Record(at, headers, payload, http, end + 4 - at), end + 4


def _inflated(data: memoryview, at: int) -> tuple[bytes, int]:
    """The member that begins at ``at``, its checksum checked, and where it ends."""
    unpress = zlib.decompressobj(31)
    out = []
    size, place = 0, at
    try:
        while not unpress.eof and place < len(data):
            out.append(unpress.decompress(data[place : place + (1 << 18)], MOST_BYTES - size))
            size += len(out[-1])
            place += 1 << 18
            while unpress.unconsumed_tail and not unpress.eof:
                if size >= MOST_BYTES:
                    raise Damage("length")
                out.append(unpress.decompress(unpress.unconsumed_tail, MOST_BYTES - size))
                size += len(out[-1])
    except zlib.error as e:
        raise Damage("member") from e
    if not unpress.eof:
        raise Damage("member cut short")
    return b"".join(out), min(place, len(data)) - len(unpress.unused_data)


def read(data: bytes) -> Iterator[Record | Gap]:
    """All records of an archive, plain, in members or mixed, and a gap for every run of bytes that gave none.

    A member that gave no record is a gap as a whole; one that gave some and lost others has gaps inside it, which stand
    at the member's place (see :class:`Gap`). An empty member is neither. Nothing is read twice: the search goes on after
    each failed begin.
    """
    view = memoryview(data)
    starts = re.compile(re.escape(_MEMBER) + b"|" + _BEGIN.pattern)
    at, lost, reason = 0, 0, ""
    while at < len(data):
        try:
            if data[at : at + 3] == _MEMBER:
                inner, after = _inflated(view, at)
                records = list(_plain(inner)) if inner else []
                if lost < at:
                    yield Gap(lost, at - lost, reason)
                whole = any(isinstance(r, Record) for r in records)
                for r in records:
                    if isinstance(r, Record):
                        yield Record(at, r.headers, r.payload, r.http, after - at)
                    else:
                        yield Gap(at, 0 if whole else after - at, r.reason, (r.offset, r.offset + r.length))
            else:
                found, after = parse(view, at)
                if lost < at:
                    yield Gap(lost, at - lost, reason)
                yield found
            at = lost = after
        except Damage as e:
            reason = reason if lost < at else str(e)
            m = starts.search(data, at + 1)
            at = m.start() if m else len(data)
    if lost < len(data):
        yield Gap(lost, len(data) - lost, reason)


def _plain(data: bytes) -> Iterator[Record | Gap]:
    at, lost, reason = 0, 0, ""
    while at < len(data):
        try:
            found, after = parse(data, at)
        except Damage as e:
            reason = reason if lost < at else str(e)
            m = _BEGIN.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if lost < at:
            yield Gap(lost, at - lost, reason)
        yield found
        at = lost = after
    if lost < len(data):
        yield Gap(lost, len(data) - lost, reason)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, members: bool = True) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to archives in ``folder``.

    Of rows with equal payloads of at least ``least_bytes`` the ones with the smallest page_id are responses, the rest
    revisits of it; a null page_id comes last, and rows that repeat the smallest id are all responses. Null html is an
    empty payload, a null url an empty one. Other columns are not looked at; no rows give no records.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    key = F.struct(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("id"))
    # Payloads that occur once need no partner: only the others' first ids are joined, as a written table whose
    # size the planner knows. If they are few, the pages are not shuffled.
    shared = saved(
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(key).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select("digest", "first"),
        f"{folder}-shared",
    )
    revisit = F.col("first").isNotNull() & (F.octet_length("html") >= least_bytes) & (key != F.col("first"))
    decided = rows.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "html",
        F.coalesce(revisit, F.lit(False)).alias("revisit"),
        F.when(~F.col("first.none"), F.col("first.id")).alias("refers_to"),
    )

    def step(batches):
        for batch in in_slices(batches, 2):
            ids, urls, revisits, refers = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
            payloads = batch.column(2).cast(pa.binary())
            for begin in range(0, batch.num_rows, 200):
                out = []
                for i in range(begin, min(begin + 200, batch.num_rows)):
                    one = record(ids[i], urls[i], payloads[i].as_py(), refers[i], revisits[i])
                    out.append(member(one + _CLOSE) if members else one)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    separator = _EMPTY_MEMBER if members else _CLOSE
    (
        decided.mapInArrow(step, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator.decode("latin-1"))
        .text(folder)
    )


def read_archives(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per record or gap of the archives below ``path``: file, offset, length (in the file, of the whole member
    for a record in one), gap_bytes (in the file, 0 for a gap inside a member that gave records, null for a record),
    gap_from and gap_to (of a gap inside a member: its span of the inflated bytes), reason, record_id, record_type, url, payload_digest (as stored), refers_to, payload_bytes (of the full payload, for a revisit
    from the reply header it kept) and payload (null for a revisit).

    An archive is read by one task; Spark's ``binaryFile`` source limits it to 2 GB. An empty file has no rows.
    """
    ship_package(spark)
    names = "file offset length gap_bytes gap_from gap_to reason record_id record_type url payload_digest refers_to payload_bytes payload".split()
    kinds = [pa.string(), *[pa.int64()] * 5, *[pa.string()] * 6, pa.int64(), pa.binary()]
    schema = (
        "file string, offset long, length long, gap_bytes long, gap_from long, gap_to long, reason string, record_id string, record_type string, url string, "
        "payload_digest string, refers_to string, payload_bytes long, payload binary"
    )

    def row(file: str, found: Record | Gap) -> tuple:
        if isinstance(found, Gap):
            return (file, found.offset, found.length, found.length, *(found.inside or (None, None)), found.reason, *[None] * 7)
        h = found.headers
        kind = h.get("warc-type")
        size = len(found.payload)
        if kind == "revisit":
            kept = found.http.get("content-length", "")
            size = int(kept) if kept.isdecimal() else None
        return (
            *(file, found.offset, found.length, *[None] * 4, h.get("warc-record-id"), kind, h.get("warc-target-uri")),
            *(h.get("warc-payload-digest"), h.get("warc-refers-to"), size),
            None if kind == "revisit" else found.payload,
        )

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    def step(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for found in read(content.as_py()):
                    rows.append(row(file, found))
                    size += 200 + len(rows[-1][-1] or b"")
                    if size > 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInArrow(step, schema)


def report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, from the archives read back.

    Digest and length of a response are those of the payload that was read; bytes that gave no record raise an error."""
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    write_archives(pages, f"{folder}/archives")
    found = read_archives(spark, f"{folder}/archives", "part-*")
    page = lambda urn: F.expr(f"try_cast(regexp_extract({urn}, '^<urn:page:([0-9-]+)>$', 1) as bigint)")
    kept = F.regexp_extract("payload_digest", "^sha1:([A-Z2-7]+)$", 1)
    sound = F.when(F.col("gap_bytes").isNotNull(), F.raise_error(F.concat(F.lit("damaged archive: "), "file", F.lit(" "), "reason")))
    return found.where(sound.isNull()).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        kept.alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", page("refers_to")).alias("refers_to"),
    )
