"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about a megabyte. A bundle is a file of such frames and ends with a seek
table (a skippable frame of the public seekable format), so a reader gets at any frame by the file's end alone. An index
table maps each record to bundle, frame and its place in the frame. Tools that know nothing of all this read a bundle as
an ordinary .warc.zst file.

Writers and readers are Spark tasks. A bundle gets a new name for each attempt and counts only if the index names it,
and the index is committed by Spark's own writer: attempts that are lost leave files that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, maybe_in, new_path, slices, stored

#: Numbers of the seekable format. Fixed values.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
#: Frames that a task reads, about.
TASK_FRAMES = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def line_safe(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(name: str, url: str | None, payload: bytes, digest: str, kind: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record: an HTTP response with the payload, or a revisit with its head alone. digest: the payload's SHA-1 in base32."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    fields += [("WARC-Target-URI", line_safe(url))] if url is not None else []
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")] if kind == "revisit" else []
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + CRLF + block + CRLF + CRLF


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """Fields, HTTP fields and payload of the record at `at`, and where the next one starts."""
    if not data.startswith(b"WARC/1.", at):
        raise ValueError(f"no record at {at}")
    end = data.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    start, n = end + 4, int(fields["Content-Length"])
    block = data[start : start + n]
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, http, payload, start + n + 4


class Bundle:
    """Writes records to one file: frames, then the seek table."""

    def __init__(self, sink, level: int = 3):
        self.sink, self.packer = sink, zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
        self.held: list[bytes] = []
        self.size = self.written = 0
        self.frames: list[tuple[int, int]] = []

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame number, the frame's place in the file, the record's place in the frame."""
        if self.held and self.size + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), self.written, self.size
        self.held.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.sink.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.sink.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(place, packed bytes, bytes) of each frame of an open bundle, read from its end."""
    size = source.size()
    source.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & 128 else 8
    source.seek(size - 9 - n * width)
    table = source.read(n * width)
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row to bundles in `folder` and returns their index: record_id, bundle, frame, frame_at, record_at, record_bytes.

    Payload: the text in UTF-8, null as none. Of rows with equal payloads of `least_bytes` or more, those with the largest
    id (several only if rows repeat) are responses and the rest revisits of it; rows without an id revisit it too, and are
    responses if no such row has an id. Payloads count as equal if their SHA-1 and length are. No rows: no bundle.

    Which payloads occur twice is found over their digests. A bitmap of those, bounded in size, goes to every task: rows that it
    doesn't have are written where they were read, the others meet their payload's largest id in a join that adaptive
    execution splits, so that one payload may have any share of the rows.
    """
    data = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url}`").alias("url"), data.alias("payload"), F.sha1(F.encode(data, "UTF-8")).alias("digest"), F.octet_length(data).cast("bigint").alias("size"))
    repeated = rows.select("id", "digest", "size").groupBy("digest", "size").agg(F.max("id").alias("largest"), F.count("*").alias("n"))
    repeated = stored(repeated.where((F.col("n") > 1) & F.col("largest").isNotNull() & (F.col("size") >= least_bytes)).select("digest", "size", "largest"), "warc-repeated")
    marked = maybe_in(rows, "digest", repeated)
    met = marked.where("maybe").drop("maybe").join(repeated, ["digest", "size"], "left")
    kinds = met.select("id", "url", "payload", "digest", F.when(F.col("id") == F.col("largest"), None).otherwise(F.col("largest")).alias("refers_to"))
    kinds = kinds.unionByName(marked.where("not maybe").select("id", "url", "payload", "digest", F.lit(None).cast("bigint").alias("refers_to")))

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        bundle, name, index = None, "", []

        def closed() -> pa.RecordBatch:
            nonlocal bundle, index
            bundle.close()
            found, bundle, index = index, None, []
            return pa.RecordBatch.from_pylist(found, schema=INDEX)

        for batch in batches:
            for part in slices(batch, "payload"):
                for row in part.to_pylist():
                    if bundle is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        bundle = Bundle(files.open_output_stream(f"{base}/{name}", compression=None))
                    to = row["refers_to"]
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    made = record(f"urn:page:{row['id']}", row["url"], row["payload"].encode("utf-8", "surrogatepass"), digest, "response" if to is None else "revisit", None if to is None else f"urn:page:{to}", date)
                    frame, frame_at, at = bundle.add(made)
                    index.append({"record_id": row["id"], "bundle": name, "frame": frame, "frame_at": frame_at, "record_at": at, "record_bytes": len(made)})
                    if bundle.written >= BUNDLE_BYTES:
                        yield closed()
        if bundle is not None:
            yield closed()

    INDEX = pa.schema([("record_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()), ("frame_at", pa.int64()), ("record_at", pa.int64()), ("record_bytes", pa.int64())])
    return stored(kinds.mapInArrow(lean(run), "record_id bigint, bundle string, frame bigint, frame_at bigint, record_at bigint, record_bytes bigint"), "warc-index")


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """The records that index names, from the bundles: page_id, url, payload (null for a revisit), payload_bytes, payload_digest, record_type, refers_to.

    A frame is read once, however many of its records are asked for. The payload of a response is held against its digest.
    The index is small beside what it names, so the number of tasks follows from the number of frames.
    """
    n = index.select("bundle", "frame").distinct().count()
    tasks = max(1, -(-n // TASK_FRAMES), min(n, 2 * index.sparkSession.sparkContext.defaultParallelism))
    frames = index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame", "frame_at").agg(F.sort_array(F.collect_list("record_at")).alias("places"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{base}/{row['bundle']}") as source:
                    at, packed, plain = seek_table(source)[row["frame"]]
                    if at != row["frame_at"]:
                        raise ValueError("index and seek table disagree")
                    source.seek(at)
                    data = unpacker.decompress(source.read(packed), max_output_size=plain)
                out = []
                for place in row["places"]:
                    fields, http, payload, _ = parse(data, place)
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                    number = lambda x: None if x in (None, "<urn:page:None>") else int(x[len("<urn:page:") : -1])
                    out.append({"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload if kind == "response" else None, "payload_bytes": int(http["Content-Length"]), "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("WARC-Refers-To"))})
                yield pa.RecordBatch.from_pylist(out, schema=ROW)

    ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    return frames.mapInArrow(lean(run), "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def round_trip(pages: DataFrame, **settings) -> DataFrame:
    """The records of pages, written to a new folder beside the checkpoints and read back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archive(write_archive(pages, folder, **settings), folder)
