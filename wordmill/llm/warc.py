"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a seek
table in a skippable frame (the public seekable format), so any Zstandard reader
unpacks the whole archive and a seeking one reads a single frame.  A manifest maps
each record to its bundle, frame and offset within the frame.

Of records whose payloads are equal and of ``MIN_DUPLICATE`` bytes or more, the one
with the least ``page_id`` is a response; the others are revisits that carry its
record id and the payload's digest.

Bundle names hold the task attempt's id and the manifest, written through Spark's
commit, names only bundles of attempts that count, so lost executors and repeated
attempts leave at most unnamed files.  Bundles go to a shared folder through Arrow's
file systems.  Memory in a task follows one frame and one record.

Defined results: null html is an empty payload; null urls get no target header; rows
that repeat a ``page_id`` each get a record, those of the least id all responses; a
null ``page_id`` is written as ``null`` and read back as null, and refers to the least
id with its payload if there is one.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import Stages, stage_path

MIN_DUPLICATE = 100
#: Raw bytes after which a frame, and a bundle, is closed.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"

#: Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; ``file:/x`` and plain paths are local."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit has no payload."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block += b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
        block += b"\r\n"
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, payload) of each record of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        stop = end + 4 + int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", end + 4) + 4
        yield at, stop + 4 - at, head, data[body:stop]
        at = stop + 4


def page_of(identifier: str) -> int | None:
    name = identifier[len("<urn:page:") : -1]
    return None if name == "null" else int(name)


class Bundle:
    """Writes one bundle frame by frame."""

    def __init__(self, folder: str, name: str, level: int):
        import zstandard

        self.fs, base = opened(folder)
        self.path = f"{folder.rstrip('/')}/{name}"
        self.out = self.fs.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.raw: list[bytes] = []
        self.size = self.total = 0

    def add(self, data: bytes, frame_bytes: int) -> tuple[int, int]:
        """Frame and offset of the record; a full frame is written."""
        at = len(self.frames), self.size
        self.raw.append(data)
        self.size += len(data)
        if self.size >= frame_bytes:
            self.flush()
        return at

    def flush(self) -> None:
        import xxhash

        if self.raw:
            data = b"".join(self.raw)
            packed = self.pack.compress(data)
            self.out.write(packed)
            self.frames.append((len(packed), len(data), xxhash.xxh64(data, seed=0).intdigest() & 0xFFFFFFFF))
            self.total += len(data)
            self.raw, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, path: str):
        import zstandard

        files, at = opened(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        entry = 12 if flags & 0x80 else 8
        table = self.file.read_at(count * entry, size - 9 - count * entry)
        self.frames, place = [], 0
        for k in range(count):
            packed, raw = struct.unpack_from("<II", table, k * entry)
            check = struct.unpack_from("<I", table, k * entry + 8)[0] if entry == 12 else None
            self.frames.append((place, packed, raw, check))
            place += packed
        self.unpack = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        import xxhash

        at, packed, raw, check = self.frames[k]
        data = self.unpack.decompress(self.file.read_at(packed, at), max_output_size=raw)
        if check is not None and xxhash.xxh64(data, seed=0).intdigest() & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        return data


MANIFEST = "page_id long, bundle string, frame int, offset long, length long, record_type string"


def _written(folder: str, frame_bytes: int, bundle_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        made, bundle, rows = 0, None, []
        for batch in batches:
            # column by column, a row at a time: no second copy of the batch
            for r in range(batch.num_rows):
                page, url, html, digest, refers = (batch.column(c)[r].as_py() for c in range(5))
                if bundle is None:
                    bundle = Bundle(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:05d}.warc.zst", level)
                    made += 1
                data = record(page, url, (html or "").encode(), digest, refers, date)
                frame, offset = bundle.add(data, frame_bytes)
                rows.append((page, bundle.path, frame, offset, len(data), "response" if refers is None else "revisit"))
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if rows:
                yield _manifest(rows)
                rows = []
        if bundle is not None:
            bundle.close()

    return run


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = ["page_id", "bundle", "frame", "offset", "length", "record_type"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def write_archive(
    pages: DataFrame,
    stages: Stages,
    folder: str | None = None,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = LEVEL,
    date: str = DATE,
) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)``; returns the manifest, a written table."""
    folder = folder or stage_path(pages.sparkSession, "warc")
    files, base = opened(folder)
    files.create_dir(base, recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).alias("size"),
    )
    same = (
        rows.where(F.col("size") >= MIN_DUPLICATE)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("d"), "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    told = rows.join(same, F.col("digest") == F.col("d"), "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return stages.cut(told.mapInArrow(_written(folder, frame_bytes, bundle_bytes, level, date), MANIFEST), "warc-manifest")


RECORD = "page_id long, record_type string, refers_to long, digest string, payload_digest string, payload_bytes long, url string, bundle string, frame int, offset long"


def _row(path: str, k: int, at: int, head: dict[str, str], payload: bytes) -> tuple:
    kind = head["WARC-Type"]
    refers = head.get("WARC-Refers-To")
    response = kind == "response"
    return (
        page_of(head["WARC-Record-ID"]),
        kind,
        page_of(refers) if refers else None,
        head["WARC-Payload-Digest"].split(":", 1)[1],
        hashlib.sha256(payload).hexdigest() if response else None,
        len(payload) if response else None,
        head.get("WARC-Target-URI"),
        path,
        k,
        at,
    )


def _records(rows: list[tuple], more: list[bytes] | None = None) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    if more is not None:
        arrays, names = [*arrays, pa.array(more, pa.binary())], [*names, "payload"]
    return pa.RecordBatch.from_arrays(arrays, names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("bundle").to_pylist():
            reader = Reader(path)
            for k in range(len(reader.frames)):
                rows = [_row(path, k, at, head, payload) for at, _, head, payload in parsed(reader.frame(k))]
                if rows:
                    yield _records(rows)


def read_archive(manifest: DataFrame) -> DataFrame:
    """Every record of the bundles that ``manifest`` names, frame by frame, a bundle a task."""
    paths = manifest.select("bundle").distinct()
    # dealt out by number: a few names would otherwise stay, or be merged, in one task
    return paths.repartition(max(1, paths.count())).mapInArrow(_read, RECORD)


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, path, frame, data = None, None, None, b""
    for batch in batches:
        for row in batch.to_pylist():
            if row["bundle"] != path:
                reader, path, frame = Reader(row["bundle"]), row["bundle"], None
            if row["frame"] != frame:
                frame, data = row["frame"], reader.frame(row["frame"])
            at = row["offset"]
            _, _, head, payload = next(parsed(data[at : at + row["length"]]))
            yield _records([_row(path, frame, at, head, payload)], [payload])


def fetch(manifest: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of ``ids(page_id)`` with their payloads, reading only the frames that hold them."""
    wanted = manifest.join(ids.select("page_id").distinct(), "page_id", "left_semi")
    wanted = wanted.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
    return wanted.mapInArrow(_fetched, RECORD + ", payload binary")


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``; a revisit's size is its response's."""
    full = records.where("record_type = 'response'").select(
        F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"), F.col("payload_bytes").alias("r_bytes")
    ).distinct()
    met = (F.col("refers_to") == F.col("r_id")) & (F.col("digest") == F.col("r_digest"))
    return records.join(full, met, "left").select(
        "page_id",
        F.coalesce("payload_bytes", "r_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "r_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE octet_length(encode(html)) >= 100 GROUP BY html)
SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (html)
"""
