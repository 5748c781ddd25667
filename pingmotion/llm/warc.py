"""WARC archives in seekable Zstandard bundles, written and read back.

A bundle is the byte string of one ``.warc.zst`` file: independent Zstandard frames of several
records each, then a skippable frame with the seek table (compressed and decompressed size of each
frame, and the footer of the seekable format). An index row per record names its bundle, frame
and offset within the decompressed frame, so one record costs one frame to read.

Bundles are rows of a Parquet table in the shared folder, which every store that Spark writes to
can hold; ``bundle_bytes`` of a row saved as a file opens in any Zstandard tool.

The first record of a payload (the smallest page_id) is a response, later ones are revisits that
name it and carry no payload. Firsts come from a pre-aggregated minimum per digest and length, and
meet the pages in a join that can split a hot payload over tasks.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: decompressed bytes at which a frame, and compressed bytes at which a bundle, is closed
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 22
LEVEL = 3
#: fixed values of the seekable format
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: the data carry no time of capture
WARC_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: str) -> str:
    """A header value on one line: line ends would end the header."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in text or "\r" in text else text


def record_bytes(record: int, page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One WARC/1.1 record; ``first`` is the page whose payload this one repeats, else None."""
    digest = base32_sha1(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}:{record}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    body = payload
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        head += [f"WARC-Refers-To: <urn:page:{first}>"]
        body = b""
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class Bundle:
    """Collects records into frames and closes with the seek table."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.packed = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, offset in the decompressed frame, length."""
        if self.open and self.filled + len(record) > FRAME_BYTES:
            self._close_frame()
        place = len(self.frames), self.filled, len(record)
        self.open.append(record)
        self.filled += len(record)
        return place

    def _close_frame(self) -> None:
        frame = self.packer.compress(b"".join(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), self.filled))
        self.packed += len(frame)
        self.open, self.filled = [], 0

    def close(self) -> bytes:
        if self.open:
            self._close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        head = struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer))
        return b"".join(self.frames) + head + table + footer


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """``(offset, compressed size, decompressed size)`` of every frame, read from the end."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table")
    sizes = struct.iter_unpack("<II", bundle[-9 - 8 * count : -9])
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_record(bundle: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record, decompressing its frame only."""
    at, packed, _ = seek_table(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed])[offset : offset + length]


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, body[: int(fields["Content-Length"])]


BUNDLES = "bundle string, bundle_bytes binary, index array<struct<page_id: long, record: long, frame: int, offset: long, length: long>>"


def write_bundles(pages: DataFrame) -> DataFrame:
    """Bundles of ``pages(page_id, url, html, ...)``, stored: bytes and the index of each.

    Null html is an empty payload. Pages without page_id are written; they can be revisits, and
    are the response if no page with an id has the payload. Repeated rows of the smallest page_id
    of a payload are all responses. Null urls leave the header out.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    firsts = pages.groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first_id"))
    told = pages.join(firsts, F.col("digest") == F.col("d")).select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("first_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index, number = Bundle(), [], 0

        def closed() -> pa.RecordBatch:
            whole = bundle.close()
            name = f"{hashlib.sha1(whole).hexdigest()}.warc.zst"
            return pa.RecordBatch.from_pylist(
                [{"bundle": name, "bundle_bytes": whole, "index": index}],
                schema=pa.schema(
                    [
                        ("bundle", pa.string()),
                        ("bundle_bytes", pa.binary()),
                        (
                            "index",
                            pa.list_(
                                pa.struct(
                                    [
                                        ("page_id", pa.int64()),
                                        ("record", pa.int64()),
                                        ("frame", pa.int32()),
                                        ("offset", pa.int64()),
                                        ("length", pa.int64()),
                                    ]
                                )
                            ),
                        ),
                    ]
                ),
            )

        for batch in batches:
            for page_id, url, html, first in zip(*(batch.columns)):
                page_id, first = page_id.as_py(), first.as_py()
                record = record_bytes(number, page_id, url.as_py(), html.as_py().encode(), first)
                frame, offset, length = bundle.add(record)
                index.append(
                    {"page_id": page_id, "record": number, "frame": frame, "offset": offset, "length": length}
                )
                number += 1
                if bundle.packed >= BUNDLE_BYTES:
                    yield closed()
                    bundle, index = Bundle(), []
        if index:
            yield closed()

    return stored(told.mapInArrow(run, BUNDLES), "bundles")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, by seek table and index. Payloads of responses are digested
    again and must agree with their header; a revisit has what its header says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, index in zip(batch["bundle_bytes"], batch["index"]):
                whole, plain, at = whole.as_py(), b"", -1
                frames, unpack, rows = seek_table(whole), zstandard.ZstdDecompressor(), []
                for entry in index.as_py():
                    if entry["frame"] != at:
                        at = entry["frame"]
                        begin, packed, _ = frames[at]
                        plain = unpack.decompress(whole[begin : begin + packed])
                    fields, body = parse_record(plain[entry["offset"] : entry["offset"] + entry["length"]])
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and base32_sha1(body) != digest:
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    name = fields["WARC-Record-ID"].split(":")[2]
                    rows.append(
                        (
                            None if name == "none" else int(name),
                            fields.get("WARC-Target-URI"),
                            int(fields["X-Payload-Length"]) if revisit else len(body),
                            digest,
                            fields["WARC-Type"],
                            int(fields["WARC-Refers-To"].strip("<>").split(":")[2]) if revisit else None,
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, kind)
                        for column, kind in zip(
                            zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                        )
                    ],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return bundles.select("bundle_bytes", "index").mapInArrow(run, READ)
