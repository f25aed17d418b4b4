"""WARC archives: writing, normalising whole-file gzip streams, and reading records by offset.

``normalised`` takes archives that are one gzip stream each. A task inflates a stream once, cuts it into records as it
goes, writes every record again as a gzip member of its own, and notes offset, length, type and record id in a
sidecar index. After that any record can be read alone. A stream cannot be entered in the middle, so an archive is one
task's work; the writer closes an archive at ``ROLL_BYTES`` of payload.

Files are written through the file system that the folder's address names, under a name of the task attempt; an
archive counts only if its row is in the manifest that Spark commits, so repeated tasks leave no second copy in use.

Edge cases: a null payload is empty; a null page id is written as ``none`` and read as null; line ends in an address
are escaped; equal pages of one id are all responses; an empty table gives no archive and an empty result; a
truncated or foreign stream is an error that names the file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

ROLL_BYTES = 64 << 20
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
BLANK = b"\r\n\r\n"
READ_BYTES = 1 << 20


def assigned(pages: DataFrame) -> DataFrame:
    """``pages`` with payload size and digest, ``record_type`` and ``refers_to``.

    Only digests that occur more than once are joined back; they are written first, so that Spark knows their size
    and broadcasts them if they are few.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    twice = large.groupBy("payload_digest").agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = C.stage(twice, C.scratch(pages.sparkSession, "repeats"))
    joined = rows.join(twice, "payload_digest", "left")
    again = (F.col("payload_bytes") >= REVISIT_BYTES) & F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("origin")).alias("refers_to"),
    )


def _urn(page: int | None) -> str:
    return f"<urn:x-page:{'none' if page is None else page}>"


def _page(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def record(page: int | None, url: str | None, payload: bytes, size: int, digest: str, kind: str, refers: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    uri = (url or "").replace("%0D", "%250D").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head[1:1] = [f"WARC-Refers-To: {_urn(refers)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return b"\r\n".join([VERSION, *(h.encode() for h in head)]) + BLANK + block + BLANK


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def written(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``assigned`` rows to archives of one gzip stream each; a row per archive: ``path``, ``records``."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out: BinaryIO | None = None
        done: list[tuple[str, int]] = []
        for batch in source:
            for r in range(batch.num_rows):
                page, url, html, size, digest, kind, refers = (batch.column(k)[r].as_py() for k in range(7))
                if out is None:
                    name, packer, held, n = f"{uuid.uuid4().hex}.warc.gz", zlib.compressobj(3, zlib.DEFLATED, 31), 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                item = record(page, url, (html or "").encode() if kind == "response" else b"", size, digest, kind, refers)
                out.write(packer.compress(item))
                held, n = held + len(item), n + 1
                if held >= ROLL_BYTES:
                    out.write(packer.flush())
                    out.close()
                    out = None
                    done.append((f"{folder}/{name}", n))
        if out is not None:
            out.write(packer.flush())
            out.close()
            done.append((f"{folder}/{name}", n))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    columns = rows.select("page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return columns.mapInArrow(batches, "path string, records bigint")


def inflated(read: Callable[[int], bytes], path: str) -> Iterator[bytes]:
    """The bytes of a gzip file, of one stream or of many in a row."""
    unpack = zlib.decompressobj(31)
    fresh = True
    while data := read(READ_BYTES):
        while data:
            try:
                part = unpack.decompress(data, READ_BYTES)
            except zlib.error as error:
                raise ValueError(f"not a gzip stream: {path}: {error}") from error
            fresh = False
            if part:
                yield part
            data = unpack.unconsumed_tail
            if unpack.eof:
                data, unpack, fresh = unpack.unused_data, zlib.decompressobj(31), True
    if not fresh:
        raise ValueError(f"truncated gzip stream: {path}")


def records(parts: Iterator[bytes], path: str) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, block and all bytes of each record of an inflated stream; one record is held at a time."""
    buffer, parts = bytearray(), iter(parts)

    def until(size: int) -> bool:
        while len(buffer) < size:
            part = next(parts, None)
            if part is None:
                return False
            buffer.extend(part)
        return True

    while until(1):
        at = -1
        while (at := buffer.find(BLANK, max(0, at))) < 0:
            at = len(buffer) - 3
            if not until(len(buffer) + 1):
                raise ValueError(f"record without end of headers: {path}")
        if not buffer.startswith(b"WARC/"):
            raise ValueError(f"not a record: {path}")
        head = headers(bytes(buffer[:at]))
        start, size = at + 4, int(head["content-length"])
        if not until(start + size + 4):
            raise ValueError(f"record cut short: {path}")
        yield head, bytes(buffer[start : start + size]), bytes(buffer[: start + size + 4])
        del buffer[: start + size + 4]


def normalised(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a gzip member per record; a row per archive: ``path``, ``sidecar`` (its index), ``records``."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in source:
            for path in batch.column("path").to_pylist():
                origin, place = fs.FileSystem.from_uri(path)
                name, offset, n = uuid.uuid4().hex, 0, 0
                with (
                    origin.open_input_stream(place, compression=None) as stream,
                    system.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out,
                    system.open_output_stream(f"{base}/{name}.idx", compression=None) as index,
                ):
                    for head, _, whole in records(inflated(stream.read, path), path):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(whole) + packer.flush()
                        out.write(member)
                        index.write(f"{offset} {len(member)} {head['warc-type']} {head['warc-record-id']}\n".encode())
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}.warc.gz"]), pa.array([f"{folder}/{name}.idx"]), pa.array([n], pa.int64())], ["path", "sidecar", "records"]
                )

    return manifest.select("path").mapInArrow(batches, "path string, sidecar string, records bigint")


def read_back(manifest: DataFrame) -> DataFrame:
    """Every record of normalised archives, each read alone by its place in the sidecar index.

    Size and digest of a response are those of the payload read, and must be those its headers name; of a revisit
    they are those of the payload it stands for.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("sidecar").to_pylist()):
                system, place = fs.FileSystem.from_uri(path)
                other, side = fs.FileSystem.from_uri(index)
                rows: list[tuple] = []
                with system.open_input_file(place) as archive, other.open_input_stream(side, compression=None) as lines:
                    for line in lines.read().decode().splitlines():
                        offset, length = map(int, line.split(" ", 2)[:2])
                        member = zlib.decompress(archive.read_at(length, offset), 31)
                        head, block, _ = next(records(iter([member]), path))
                        http, _, payload = block.partition(BLANK)
                        size, digest = int(headers(http)["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"payload differs from its digest: {path} at {offset}")
                        refers = head.get("warc-refers-to")
                        rows.append((_page(head["warc-record-id"]), size, digest, head["warc-type"], refers and _page(refers), head["warc-target-uri"]))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return manifest.select("path", "sidecar").mapInArrow(
        batches, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    )


def spread(manifest: DataFrame) -> DataFrame:
    """One archive per task as far as the hash of its name allows."""
    return manifest.repartition(max(1, manifest.count()), "path")
