"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import stash

#: Fixed values of the format: marks of a dictionary's skippable frame, of a frame, and of a compressed dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Uncompressed bytes after which an archive is closed; a longer record has one of its own.
ARCHIVE = 4 << 20
#: Records and bytes an archive's dictionary is made from, and the dictionary's size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY = 64, 1 << 19, 16 << 10
#: Bytes a record may decode to.
MOST = 1 << 31


class BadArchive(ValueError):
    """An archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value; line ends and other controls are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m.group()):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A record: a response with its HTTP head and payload, or a revisit with the head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    own = "null" if page_id is None else page_id
    head = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{own}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_line(url)}"] if url else []), f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack(records: list[bytes], level: int = 3) -> bytes:
    """An archive of records, with a dictionary if the first of them make one."""
    taken, size = [], 0
    for r in records[:SAMPLE_RECORDS]:
        if size < SAMPLE_BYTES:
            taken.append(r[:SAMPLE_BYTES - size])
            size += len(taken[-1])
    made = None
    if len(taken) >= 8:
        try:
            made = zstandard.train_dictionary(DICTIONARY, taken)
        except zstandard.ZstdError:
            pass  # too few or too even samples make no dictionary; the format doesn't ask for one
    writer = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True) if made else zstandard.ZstdCompressor(level=level, write_checksum=True)
    out = []
    if made:
        stored = zstandard.ZstdCompressor(level=level).compress(made.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(stored)) + stored)
    return b"".join([*out, *map(writer.compress, records)])


def frame_size(data: memoryview, at: int) -> int:
    """The bytes of the frame at a place, by the sizes in its block headers."""
    if len(data) - at < 6 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise BadArchive(f"no frame at byte {at}")
    size = zstandard.frame_header_size(bytes(data[at:at + 18]))
    checksum = data[at + 4] & 4
    end = at + size
    while True:
        if end + 3 > len(data):
            raise BadArchive(f"the frame at byte {at} is cut off")
        head = int.from_bytes(data[end:end + 3], "little")
        kind = head >> 1 & 3
        if kind == 3:
            raise BadArchive(f"the frame at byte {at} has a block of no known kind")
        end += 3 + (1 if kind == 1 else head >> 3)
        if head & 1:
            break
    end += 4 if checksum else 0
    if end > len(data):
        raise BadArchive(f"the frame at byte {at} is cut off")
    return end - at


def frames(data: bytes, most: int = MOST) -> Iterator[bytes]:
    """The records of an archive, each decoded from its own frame with the archive's dictionary."""
    view, at = memoryview(data), 0
    reader = zstandard.ZstdDecompressor()
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", view, 4)[0]
        stored = bytes(view[8:8 + size])
        if len(stored) < size:
            raise BadArchive("the dictionary is cut off")
        if stored[:4] == struct.pack("<I", FRAME_MAGIC):
            stored = reader.decompress(stored, max_output_size=most)
        reader, at = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stored)), 8 + size
    while at < len(view):
        if len(view) - at >= 8 and 0x184D2A50 <= struct.unpack_from("<I", view, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        size = frame_size(view, at)
        frame = bytes(view[at:at + size])
        if zstandard.get_frame_parameters(frame).content_size > most and zstandard.get_frame_parameters(frame).content_size != zstandard.CONTENTSIZE_UNKNOWN:
            raise BadArchive(f"the record at byte {at} is too long")
        try:
            yield reader.decompressobj().decompress(frame)
        except zstandard.ZstdError as error:
            raise BadArchive(f"the frame at byte {at}: {error}") from error
        at += size


@dataclass
class Parsed:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse(data: bytes) -> Parsed:
    """A record's headers and payload, after its lengths, digests and required headers are checked."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", first):
        raise BadArchive("no record begins here")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadArchive(f"no header: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadArchive(f"no {name}")
    if not re.fullmatch(r"\d+", headers["content-length"]) or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the record isn't as long as it says")
    block = rest[:-4]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise BadArchive("the block's digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:]))
    if headers["warc-type"] == "response":
        if "content-length" in fields and int(fields["content-length"]) != len(payload):
            raise BadArchive("the payload isn't as long as it says")
        if "warc-payload-digest" in headers and headers["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise BadArchive("the payload's digest differs")
    return Parsed(headers, fields, payload)


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", min_bytes: int = 0, archive: int = ARCHIVE) -> DataFrame:
    """Archives (``name, content``) with a record for every row; each task packs its own rows.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest id is the
    response and the others revisit it; shorter ones are all responses. A null html is an empty
    payload; a null url has no target header. A null id never is the one others revisit unless all
    are null; of rows that share the largest id, the first in a task's order of arrival can't be
    told apart, so all of them are responses. Extra columns are not written.
    """
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("key", F.sha1(F.col("html").cast("binary")))
    # Payloads that occur once are left out: what is joined is as small as the repeats are few.
    repeats = keyed.where(F.octet_length("html") >= min_bytes).groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    decided = keyed.join(repeats, "key", "left").select("page_id", "url", "html", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal number, held, size
            name = f"part-{task:05d}-{number:05d}.warc.zst"
            number += 1
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([pack(held)], pa.binary())], ["name", "content"])
            held, size = [], 0
            return out

        for batch in batches:
            for page_id, url, text, first in zip(*(batch.column(i) for i in range(4))):
                page_id, first = page_id.as_py(), first.as_py()
                made = record(page_id, url.as_py(), text.as_py().encode("utf-8", "replace"), first, first is not None and page_id != first)
                if held and size + len(made) > archive:
                    yield flush()
                held.append(made)
                size += len(made)
        if held:
            yield flush()

    return decided.mapInArrow(run, "name string, content binary")


SCHEMA = "archive string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_archives(archives: DataFrame, name: str = "name", content: str = "content", strict: bool = True) -> DataFrame:
    """The records of archives, given as rows of a name and the bytes (a table of them, or Spark's ``binaryFile`` with ``path, content``).

    ``payload`` is null for a revisit; its length and digest are those of the full payload. An
    archive that breaks the format raises, or, if not strict, ends at the last good record. A null
    or empty content has no records.
    """

    def page(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found.group(1)) if found else None

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for label, data in zip(batch.column(0), batch.column(1)):
            try:
                for raw in frames(data.as_py() or b""):
                    r = parse(raw)
                    revisit = r.headers["warc-type"] == "revisit"
                    if revisit and ("warc-refers-to" not in r.headers or "warc-payload-digest" not in r.headers):
                        raise BadArchive("a revisit without what it revisits")
                    length = int(r.http.get("content-length", len(r.payload)))
                    named = r.headers.get("warc-payload-digest", "").removeprefix("sha1:") or digest(r.payload)
                    url = r.headers.get("warc-target-uri")
                    yield (label.as_py(), page(r.headers["warc-record-id"]), re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m.group(1), 16)), url) if url else None,
                           length, named, r.headers["warc-type"], page(r.headers.get("warc-refers-to")), None if revisit else r.payload)
            except BadArchive as error:
                if strict:
                    raise BadArchive(f"{label.as_py()}: {error}") from error

    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for row in rows(batch):
                held.append(row)
                if len(held) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    return archives.select(F.col(name).alias("archive"), F.col(content).alias("content")).mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """The records of ``pages`` after they were written as archives below the shared folder and read back."""
    return read_archives(stash(write_archives(pages, **options), "warc"))
