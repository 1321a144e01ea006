"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed each for itself. A bundle ends with a seek table, a
frame that decoders skip, which lists the compressed and the plain size of every frame. The index maps
a record to its bundle, its frame, and its offset in the plain bytes of the frame: one frame is read and
unpacked to get it.

Of pages with equal payloads of at least ``revisit_bytes`` bytes, that with the largest id is a
response and the others are revisits that refer to it; they keep the headers and not the payload. All smaller
ones are responses. A null payload is empty. A page without an id is a revisit if a page with an id has
its payload, otherwise a response. Rows that repeat an id and its payload have the same type. A null
address leaves its header out. An empty table makes no bundle.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import files, store

REVISIT_BYTES = 1000
#: Plain bytes from which a frame is closed, and compressed bytes from which a bundle is.
FRAME_BYTES = 512 << 10
BUNDLE_BYTES = 1 << 30
LEVEL = 3
#: Parts into which the pages of one payload are dealt.
SALTS = 64

# fixed values of the formats
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def id_of(name: str) -> int | None:
    own = name[len("<urn:page:") : -1]
    return None if own == "null" else int(own)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name_of(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if revisit:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {name_of(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(plain: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and body of the record at an offset, and the offset of the next one."""
    end = plain.index(b"\r\n\r\n", at)
    lines = plain[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, plain[start:stop], stop + 4


class BundleWriter:
    """Frames of records, and the seek table at the end."""

    def __init__(self, out, level: int = LEVEL, frame_bytes: int = FRAME_BYTES) -> None:
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.plain = io.BytesIO()
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.plain.tell() >= self.frame_bytes:
            self.flush()
        place = len(self.frames), self.plain.tell()
        self.plain.write(raw)
        return place

    def flush(self) -> None:
        if self.plain.tell():
            packed = self.compressor.compress(self.plain.getvalue())
            self.out.write(packed)
            self.frames.append((len(packed), self.plain.tell()))
            self.written += len(packed)
            self.plain = io.BytesIO()

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        table = entries + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class Bundle:
    """A bundle opened for reading."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        entries = source.read_at(8 * count, size - 9 - 8 * count)
        self.frames = [struct.unpack_from("<II", entries, 8 * i) for i in range(count)]
        self.starts = [0]
        for packed, _ in self.frames:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, number: int) -> bytes:
        packed, plain = self.frames[number]
        raw = self.source.read_at(packed, self.starts[number])
        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=plain)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        headers, body, _ = parse(self.frame(frame), offset)
        return headers, body

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for number in range(len(self.frames)):
            plain, at = self.frame(number), 0
            while at < len(plain):
                headers, body, at = parse(plain, at)
                yield headers, body


def with_types(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, _payload, _digest, _largest): the largest id of each payload that counts.

    The pages of one payload are dealt into ``SALTS`` parts. Each part finds its largest id in the map
    tasks, the parts of a payload exchange it, and the pages meet it part by part.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("_payload"))
    rows = rows.withColumns(
        {
            "_digest": F.sha1("_payload"),
            "_size": F.octet_length("_payload"),
            "_salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"),
        }
    )
    key = ["_digest", "_size"]
    parts = (
        rows.filter(F.col("_size") >= revisit_bytes)
        .groupBy(*key, "_salt")
        .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    )
    over = Window.partitionBy(*key)
    largest = (
        parts.select(*key, "_salt", F.max("_top").over(over).alias("_largest"), F.sum("_rows").over(over).alias("_all"))
        .filter("_all > 1")
        .drop("_all")
    )
    largest = store.written(largest, "payloads")
    return rows.join(largest, [*key, "_salt"], "left").select("page_id", "url", "_payload", "_digest", "_largest")


def write_bundles(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write all ``pages`` (page_id, url, html); the index (page_id, bundle, frame, offset, length)."""
    rows = with_types(pages, revisit_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        first = next((b for b in batches if b.num_rows), None)

        def rest() -> Iterator[pa.RecordBatch]:
            if first is not None:
                yield first
                yield from batches

        source = rest()
        batch, row = next(source, None), 0
        while batch is not None:
            path = f"{folder}/part-{part:06d}-{number:04d}.warc.zst"
            number += 1
            with files.new_file(path) as out:
                bundle = BundleWriter(out)
                while batch is not None and bundle.written < BUNDLE_BYTES:
                    found = []
                    for r in batch.slice(row, 256).to_pylist():
                        largest = r["_largest"]
                        revisit = largest is not None and r["page_id"] != largest
                        raw = record(r["page_id"], r["url"], r["_payload"], r["_digest"], largest, revisit)
                        found.append((r["page_id"], path, *bundle.add(raw), len(raw)))
                    columns = list(zip(*found))
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                    names = ["page_id", "bundle", "frame", "offset", "length"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
                    row += len(found)
                    if row >= batch.num_rows:
                        batch, row = next(source, None), 0
                bundle.close()

    return store.written(rows.mapInArrow(write, "page_id long, bundle string, frame long, offset long, length long"), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, from the files.

    The digest of a response is made from the payload that was read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        for batch in batches:
            for address in batch.column("bundle").to_pylist():
                system, path = files.opened(address)
                found = []
                with system.open_input_file(path) as source:
                    for headers, body in Bundle(source).records():
                        http, payload = body.split(b"\r\n\r\n", 1)
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = headers["WARC-Type"]
                        if kind == "response":
                            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"damaged record {headers['WARC-Record-ID']} in {path}")
                        refers = headers.get("WARC-Refers-To")
                        found.append((id_of(headers["WARC-Record-ID"]), size, digest, kind, None if refers is None else id_of(refers)))
                        if len(found) == 2000:
                            yield batch_of(found)
                            found = []
                if found:
                    yield batch_of(found)

    bundles = store.written(index.select("bundle").distinct(), "bundles")
    return store.spread(bundles, "bundle").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
