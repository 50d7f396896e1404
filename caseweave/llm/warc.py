"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Each record is a gzip member of its own. Of the rows with one payload of at least ``MIN_REVISIT`` bytes, the one with
the smallest id becomes a response, the others become revisits without a payload that name it. The writer rolls a file
over at ``FILE_BYTES``; a manifest in the shared folder names the files of committed tasks only.

The reader goes through a file as a stream and keeps no more than one record and one block of it. A record counts
when its gzip member passes zlib's checks (or, uncompressed, when it starts with a version line), its head can be
parsed, its length fits, its two ending line breaks are there and its block digest agrees. When a check fails, the
reader looks for the next gzip magic or version line behind the start of the failed record from which a valid record
can be read, and reports the bytes between as a quarantined gap with the reason of the first failure.

Defined results: a null payload is empty; a null url is left out; rows that repeat an id are all written, and when
the id is the smallest of its payload they are all responses; a null id is written as ``null``, never chosen as the
target of a revisit and is itself a response; an empty table gives no file and no row; a line break inside a url is
percent-encoded; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caseweave.llm.files import AttemptFile, apart, open_file
from caseweave.session import scratch_path, stored

VERSION, GZIP, CRLF = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n"
FILE_BYTES, BLOCK, MIN_REVISIT, HEAD_LIMIT = 32 << 20, 1 << 18, 100, 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BROADCAST_GROUPS = 200_000

RECORDS = (
    "path string, offset long, page_id long, url string, record_type string, refers_to long, payload binary, "
    "payload_bytes long, payload_digest string, gap_end long, reason string"
)


def head(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record, uncompressed."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    revisit = refers_to is not None
    if not revisit:
        block += payload
    name = "null" if page_id is None else str(page_id)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"),
              ("WARC-Date", "2000-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
               ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return head(fields, "WARC/1.1") + block + CRLF + CRLF


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to``, null for a response."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    keys = rows.where(F.length("payload") >= MIN_REVISIT).groupBy("digest")
    # Only payloads that occur again need a look-up, by their first page.
    groups = stored(
        keys.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"),
        "payload-groups",
    )
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to")
    )


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", level: int = 6) -> DataFrame:
    """Write the archives; the manifest has a row per file: ``path``, ``n_records``, ``n_bytes``."""
    folder = scratch_path(pages.sparkSession, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, file, n = TaskContext.get().partitionId(), [], None, 0
        for batch in batches:
            for at in range(batch.num_rows):
                values = [column[at].as_py() for column in batch.columns]
                if file is None:
                    file, n = AttemptFile(folder, f"part-{part:05d}-{len(rows):04d}", ".warc.gz"), 0
                member = zlib.compressobj(level, wbits=31)
                file.write(member.compress(record(*values)) + member.flush())
                n += 1
                if file.size >= FILE_BYTES:
                    file.close()
                    rows.append((file.path, n, file.size))
                    file = None
        if file:
            file.close()
            rows.append((file.path, n, file.size))
        if rows:
            paths, counts, sizes = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "n_records", "n_bytes"]
            )

    rows = with_revisits(pages, id_col, url_col, payload_col)
    return stored(rows.mapInArrow(archive, "path string, n_records long, n_bytes long"), "warc-manifest")


class Damaged(Exception):
    """A check of a record failed."""


@dataclass
class Found:
    """A valid record, or with ``reason`` a quarantined gap, from ``start`` to ``end`` in the file."""

    start: int
    end: int
    fields: dict[str, str] | None = None
    block: bytes = b""
    reason: str | None = None


class Salvage:
    """Reads the records of one file in turn."""

    def __init__(self, source):
        self.source, self.buffer, self.base, self.ended = source, bytearray(), 0, False

    def _more(self) -> bool:
        data = b"" if self.ended else self.source.read(BLOCK)
        self.ended = not data
        self.buffer += data
        return bool(data)

    def _has(self, end: int) -> bool:
        """Whether the file reaches the offset ``end``, reading on as needed."""
        while self.base + len(self.buffer) < end:
            if not self._more():
                return False
        return True

    def _forget(self, start: int) -> None:
        del self.buffer[: start - self.base]
        self.base = start

    def __iter__(self) -> Iterator[Found]:
        at, gap, reason = 0, None, None
        while self._has(at + 1):
            try:
                found = self._record(at)
            except Damaged as problem:
                if gap is None:
                    gap, reason = at, str(problem)
                at = self._candidate(at + 1)
                self._forget(at)
                continue
            if gap is not None:
                yield Found(gap, at, reason=reason)
                gap = None
            yield found
            at = found.end
            self._forget(at)
        if gap is not None:
            yield Found(gap, at, reason=reason)

    def _candidate(self, at: int) -> int:
        """The next gzip magic or version line from ``at`` on, else the end of the file."""
        longest = max(len(VERSION), len(GZIP))
        while True:
            self._has(at + BLOCK)
            places = [p for mark in (VERSION, GZIP) if (p := self.buffer.find(mark, at - self.base)) >= 0]
            if places:
                return self.base + min(places)
            if self.ended:
                return self.base + len(self.buffer)
            at = max(at, self.base + len(self.buffer) - longest + 1)
            self._forget(at)

    def _record(self, at: int) -> Found:
        self._has(at + len(VERSION))
        mark = bytes(self.buffer[at - self.base : at - self.base + len(VERSION)])
        if mark.startswith(GZIP):
            data, end = self._member(at)
            fields, start, length = self._head(data)
            if len(data) != start + length + 4 or data[start + length :] != CRLF + CRLF:
                raise Damaged("the member does not end with its record")
            return Found(at, end, fields, self._block(fields, data[start : start + length]))
        if mark != VERSION:
            raise Damaged("neither a gzip member nor a version line")
        reach = 4096
        while True:
            self._has(at + reach)
            data = bytes(self.buffer[at - self.base : at - self.base + reach])
            if b"\r\n\r\n" in data or reach >= HEAD_LIMIT or self.ended:
                break
            reach *= 2
        fields, start, length = self._head(data)
        if not self._has(at + start + length + 4):
            raise Damaged("the record is cut off")
        place = at - self.base + start
        if self.buffer[place + length : place + length + 4] != CRLF + CRLF:
            raise Damaged("the record does not end where its length says")
        return Found(at, at + start + length + 4, fields, self._block(fields, bytes(self.buffer[place : place + length])))

    def _member(self, at: int) -> tuple[bytes, int]:
        unpacker, parts, place = zlib.decompressobj(wbits=31), [], at
        try:
            while not unpacker.eof:
                if not self._has(place + 1):
                    raise Damaged("the gzip member is cut off")
                chunk = bytes(self.buffer[place - self.base : place - self.base + BLOCK])
                parts.append(unpacker.decompress(chunk))
                if not parts[0].startswith(VERSION[: len(parts[0])]):
                    raise Damaged("the gzip member holds no record")
                place += len(chunk) - len(unpacker.unused_data)
        except zlib.error as problem:
            raise Damaged("the gzip member fails its checks") from problem
        return b"".join(parts), place

    @staticmethod
    def _head(data: bytes) -> tuple[dict[str, str], int, int]:
        """Fields, start of the block, length of the block."""
        end = data.find(b"\r\n\r\n")
        lines = data[: max(end, 0)].split(CRLF)
        if end < 0 or not re.fullmatch(rb"WARC/1\.\d", lines[0]):
            raise Damaged("the head of the record is damaged")
        try:
            fields = dict(line.decode().split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
        except (ValueError, KeyError) as problem:
            raise Damaged("the head of the record is damaged") from problem
        if length < 0 or not {"WARC-Type", "WARC-Record-ID"} <= fields.keys():
            raise Damaged("the head of the record is damaged")
        return fields, end + 4, length

    @staticmethod
    def _block(fields: dict[str, str], block: bytes) -> bytes:
        kind, _, value = fields.get("WARC-Block-Digest", "").partition(":")
        if kind == "sha256" and hashlib.sha256(block).hexdigest() != value:
            raise Damaged("the block fails its digest")
        return block


def _number(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def row_of(path: str, found: Found) -> dict:
    if found.reason:
        return {"path": path, "offset": found.start, "gap_end": found.end, "reason": found.reason, "record_type": "gap"}
    fields, block = found.fields, found.block
    payload = block[block.find(b"\r\n\r\n") + 4 :] if fields["WARC-Type"] == "response" else None
    stated = fields.get("X-Payload-Length", "")
    return {
        "path": path, "offset": found.start, "gap_end": None, "reason": None, "record_type": fields["WARC-Type"],
        "page_id": _number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
        "refers_to": _number(fields.get("WARC-Refers-To")), "payload": payload,
        "payload_bytes": len(payload) if payload is not None else int(stated) if stated.isdigit() else None,
        "payload_digest": hashlib.sha256(payload).hexdigest() if payload is not None
        else fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None,
    }


def read(paths: DataFrame) -> DataFrame:
    """The records and gaps of the files in column ``path``; a gap has ``record_type`` gap, its end and the reason.

    Length and digest of a response are those of the payload read; a revisit has those that its head states.
    """
    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("gap_end", pa.int64()), ("reason", pa.string()),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_file(path) as source:
                    for found in Salvage(source):
                        rows.append(row_of(path, found))
                        held += len(found.block)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return apart(paths.select("path")).mapInArrow(scan, RECORDS)


def log_gaps(records: DataFrame) -> DataFrame:
    """The quarantined stretches of the files."""
    return records.where("record_type = 'gap'").select("path", "offset", "gap_end", "reason")
