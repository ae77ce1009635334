"""WARC archives as seekable Zstandard bundles.

``write_bundles`` turns rows into WARC/1.1 records. Records are grouped into frames: each frame is
an independent Zstandard frame holding whole records, and the bundle ends with the footer of the
seekable format (a skippable frame listing the compressed and plain size of every frame), so a
reader can decode any frame alone. Every record is mapped to its bundle, frame and offset inside
the plain frame; that map is an ordinary table.

Of records with equal payloads (SHA-1) of at least ``dedup_min_bytes`` bytes, the one with the
largest id is written as ``response``; the others become ``revisit`` records that name it and
carry its length and digest but no payload.

One task writes the bundles of its partition, frame by frame, through the file system of the
shared folder, to a file name no other attempt uses. The map names only files of committed
attempts, so files left behind by lost executors are never read. Choosing the response record is
one aggregate by digest and one equi-join (splittable under skew); payloads never meet by key.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import materialise, shared_folder

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = ("record_id string, page_id long, record_type string, bundle string, frame int, frame_offset long, "
                "frame_size long, record_offset long, record_size long")


def open_output(path: str):
    """A writable binary stream at ``path`` (a URI of any store pyarrow knows, or a local path)."""
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def open_input(path: str):
    """A seekable binary stream at ``path``."""
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system.open_input_file(inner)


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, url: str, payload: bytes, digest: str, n_bytes: int, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head (with the full length), not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n").encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response"]
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of one plain frame."""
    at = 0
    while at < len(frame):
        stop = frame.index(b"\r\n\r\n", at)
        lines = frame[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at offset {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(headers["content-length"])
        yield at, headers, frame[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4


class BundleWriter:
    """Appends records to frames and frames to a stream; ``close`` writes the seek table."""

    def __init__(self, stream, frame_bytes: int, level: int = 3):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.plain = io.BytesIO()
        self.entries: list[tuple[int, int]] = []
        self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Returns (frame number, offset in the plain frame)."""
        if self.plain.tell() and self.plain.tell() + len(record) > self.frame_bytes:
            self.flush()
        at = self.plain.tell()
        self.plain.write(record)
        return len(self.entries), at

    def flush(self) -> None:
        plain = self.plain.getvalue()
        if plain:
            packed = self.packer.compress(plain)
            self.stream.write(packed)
            self.entries.append((len(packed), len(plain)))
            self.size += len(packed)
            self.plain = io.BytesIO()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(stream) -> list[tuple[int, int, int]]:
    """(offset, packed size, plain size) of every frame, from the bundle's footer."""
    stream.seek(0, 2)
    end = stream.tell()
    stream.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    stream.seek(end - 9 - count * width)
    raw = stream.read(count * width)
    out, at = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", raw, k * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_record(bundle: str, frame: int, record_offset: int) -> tuple[dict[str, str], bytes]:
    """Random access: decode one frame of a bundle and return the record at the offset."""
    with open_input(bundle) as stream:
        at, packed, plain = seek_table(stream)[frame]
        stream.seek(at)
        data = zstandard.ZstdDecompressor().decompress(stream.read(packed), max_output_size=plain)
    for offset, headers, block in parse_records(data[record_offset:]):
        return headers, block
    raise KeyError(record_offset)




def _mark(pages: DataFrame, id_col: str, html: str, dedup_min_bytes: int) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("__id"), F.coalesce(F.col("url"), F.lit("")).alias("__url"),
                        payload.alias("__payload")).withColumn("__sha", F.unhex(F.sha1("__payload")))
    large = F.length("__payload") >= dedup_min_bytes
    # only digests met more than once can cause a revisit; the table is cut so both join sides are exchanges
    # whose skewed partitions Spark can split
    groups = materialise(rows.filter(large).groupBy("__sha").agg(F.max("__id").alias("__of"), F.count("*").alias("n"))
                         .filter("n > 1").select(F.col("__sha").alias("__key"), "__of"), "warc-digests")
    same = (F.col("__sha") == F.col("__key")) & large
    return rows.join(groups, same, "left").select(
        "__id", "__url", "__payload", F.when(F.col("__of") != F.col("__id"), F.col("__of")).alias("__of"))


def write_bundles(pages: DataFrame, folder: str, *, id_col: str = "page_id", html: str = "html",
                  frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, dedup_min_bytes: int = 0,
                  level: int = 3) -> DataFrame:
    """Write every row as a record; returns the materialised record map (``INDEX_SCHEMA``).

    A null payload is written empty. A row with a null id is written too, with a null page_id in the
    map. Rows repeated with one id and payload are all written; each is a response of its own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, bundle = None, ""
        rows: list[list] = []

        def sizes() -> pd.DataFrame:
            writer.close()
            offsets, at = [], 0
            for packed, plain in writer.entries:
                offsets.append((at, packed))
                at += packed
            out = pd.DataFrame(rows, columns=["record_id", "page_id", "record_type", "bundle", "frame",
                                              "record_offset", "record_size"])
            out["frame_offset"] = [offsets[f][0] for f in out["frame"]]
            out["frame_size"] = [offsets[f][1] for f in out["frame"]]
            out["page_id"] = out["page_id"].astype("Int64")
            rows.clear()
            return out[["record_id", "page_id", "record_type", "bundle", "frame", "frame_offset", "frame_size",
                        "record_offset", "record_size"]]

        for pdf in batches:
            for pid, url, payload, of in zip(pdf["__id"], pdf["__url"], pdf["__payload"], pdf["__of"], strict=True):
                if writer is None:
                    bundle = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(open_output(bundle), frame_bytes, level)
                pid = None if pd.isna(pid) else int(pid)
                of = None if pd.isna(of) else int(of)
                payload = bytes(payload)
                rid = f"urn:page:{'none' if pid is None else pid}"
                record = record_bytes(rid, " ".join(url.split()), payload, bare_digest(payload), len(payload),
                                      None if of is None else f"urn:page:{of}")
                frame, at = writer.add(record)
                rows.append([rid, pid, "response" if of is None else "revisit", bundle, frame, at, len(record)])
                if writer.size >= bundle_bytes:
                    yield sizes()
                    writer = None
        if writer is not None:
            yield sizes()

    marked = _mark(pages, id_col, html, dedup_min_bytes)
    return materialise(marked.mapInPandas(run, INDEX_SCHEMA), "warc-index")


READ_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
               "refers_to long, payload binary, bundle string, frame int, record_offset long")


def read_bundles(index: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Read every record of the bundles the map names, frame by frame.

    Work is dealt by frame, so a large bundle is read by many tasks. A response's digest and length
    are computed from the payload read; a revisit's come from its headers. With ``with_payload``
    false the payload column is null (nothing large leaves the task).
    """
    frames = index.groupBy("bundle", "frame").agg(F.first("frame_offset").alias("frame_offset"),
                                                  F.first("frame_size").alias("frame_size"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for pdf in batches:
            for bundle, part in pdf.groupby("bundle", sort=False):
                with open_input(bundle) as stream:
                    table = seek_table(stream)
                    for k in sorted(part["frame"]):
                        at, packed, plain = table[k]
                        stream.seek(at)
                        data = unpack.decompress(stream.read(packed), max_output_size=plain)
                        out = []
                        for offset, head, block in parse_records(data):
                            http, _, body = block.partition(b"\r\n\r\n")
                            pid = head["warc-record-id"].strip("<>").removeprefix("urn:page:")
                            if head["warc-type"] == "revisit":
                                n = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                                digest = head["warc-payload-digest"].removeprefix("sha1:")
                                of = int(head["warc-refers-to"].strip("<>").removeprefix("urn:page:"))
                            else:
                                n, digest, of = len(body), bare_digest(body), None
                            out.append((None if pid == "none" else int(pid), head["warc-target-uri"],
                                        head["warc-type"], n, digest, of, body if with_payload else None, bundle,
                                        int(k), offset))
                        frame = pd.DataFrame(out, columns=["page_id", "url", "record_type", "payload_bytes",
                                                           "payload_digest", "refers_to", "payload", "bundle",
                                                           "frame", "record_offset"])
                        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return frames.mapInPandas(run, READ_SCHEMA)


def archive_folder(spark) -> str:
    return shared_folder(spark, "warc")
