"""Operator 6: WARC archives as seekable Zstandard bundles.

Pages become WARC records.  Records are grouped into frames that are compressed
independently; a bundle is a file of such frames and ends with the seek table of
the public seekable Zstandard format (a skippable frame), so any frame can be
read without the ones before it.  An index maps record identifiers to bundle,
frame and offset inside the decompressed frame.

Equal payloads (same SHA-1 and length) are stored once: the record with the
smallest page_id is the response, the others are revisits of it.  The smallest
id of each payload comes from an aggregation over digests, and only ids travel
to the pages again: page bodies are shuffled once, by page id.

Tasks write bundles under names that hold the attempt, and the index names only
bundles of tasks that succeeded, so a lost executor leaves no half archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import importable, shared_path, table, write_shared

#: Fixed values of the public seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")

#: Tasks that read bundles at most; each reads one bundle after another.
MAX_READERS = 20_000

#: Names are derived from page ids in this name space.
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "martforge/warc")
_DATE = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "record_id string, page_id long, record_type string, bundle string, "
    "frame int, frame_start long, frame_bytes long, offset long, length long"
)
RECORD_SCHEMA = (
    "page_id long, record_id string, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def record_id(page_id: int | None, copy: int = 0) -> str:
    """The identifier of the ``copy``-th row with this page id."""
    return f"urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{copy}')}"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(
    rid: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool
) -> bytes:
    """One record; a revisit has the HTTP head but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if is_revisit else payload)
    head = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": f"<{rid}>",
        "WARC-Date": _DATE,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        head["WARC-Target-URI"] = re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if is_revisit:
        head["WARC-Profile"] = _REVISIT
        head["WARC-Refers-To"] = f"<{record_id(refers_to)}>"
        head["X-Refers-To-Page-ID"] = str(refers_to)
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: memoryview, at: int) -> tuple[dict[str, str], bytes, bytes, int]:
    """Headers, HTTP head, body and end of the record that starts at ``at``."""
    raw = bytes(data[at : at + 65536])
    while (stop := raw.find(b"\r\n\r\n")) < 0:  # a head longer than that
        if at + len(raw) >= len(data):
            raise ValueError("record head without an end")
        raw = bytes(data[at : at + 2 * len(raw)])
    lines = raw[:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    begin = at + stop + 4
    end = begin + int(head["Content-Length"])
    block = bytes(data[begin:end])
    http, _, body = block.partition(b"\r\n\r\n") if head["WARC-Type"] != "warcinfo" else (b"", b"", block)
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        raise ValueError("record without its end")
    return head, http, body, end + 4


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if re.match("file:/(?!//)", uri):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


class Bundle:
    """Writes one bundle; ``place`` of a record is known before its frame ends."""

    def __init__(self, folder: str, name: str, frame_bytes: int, level: int) -> None:
        self.fs, path = _fs(folder)
        self.fs.create_dir(path, recursive=True)
        self.uri, self.path, self.part = f"{folder}/{name}", f"{path}/{name}", f"{path}/.{name}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.size, self.buffer, self.held, self.pending, self.index = 0, [], 0, [], []
        self.add(
            b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\n"
            b"Content-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n"
            % (str(uuid.uuid5(_NAMES, name)).encode(), _DATE.encode())
        )

    def add(self, record: bytes, key: tuple | None = None) -> None:
        if key:
            self.pending.append((*key, self.held, len(record)))
        self.buffer.append(record)
        self.held += len(record)
        if self.held >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        frame = self.compressor.compress(b"".join(self.buffer))
        self.out.write(frame)
        for rid, page_id, kind, offset, length in self.pending:
            self.index.append((rid, page_id, kind, self.uri, len(self.frames), self.size, len(frame), offset, length))
        self.frames.append((len(frame), self.held))
        self.size += len(frame)
        self.buffer, self.held, self.pending = [], 0, []

    def close(self) -> list[tuple]:
        self.flush()
        table = b"".join(ENTRY.pack(*f) for f in self.frames) + FOOTER.pack(len(self.frames), 0, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.index


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, compressed bytes, decompressed bytes) of each frame."""
    size = file.size()
    n, _, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
    if magic != SEEK_TABLE_MAGIC:
        raise ValueError("no seek table")
    raw = file.read_at(n * ENTRY.size, size - FOOTER.size - n * ENTRY.size)
    frames, at = [], 0
    for packed, full in ENTRY.iter_unpack(raw):
        frames.append((at, packed, full))
        at += packed
    return frames


def read_bundle(uri: str) -> Iterator[tuple]:
    """The records of a bundle, one frame in memory at a time."""
    fs, path = _fs(uri)
    with fs.open_input_file(path) as file:
        unpack = zstandard.ZstdDecompressor()
        for start, packed, full in seek_table(file):
            data = memoryview(unpack.decompress(file.read_at(packed, start), max_output_size=full))
            at = 0
            while at < len(data):
                head, http, body, at = parse_record(data, at)
                if head["WARC-Type"] != "warcinfo":
                    yield _row(head, http, body)


def _row(head: dict[str, str], http: bytes, body: bytes) -> tuple:
    kind, told = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest(body) != told:
        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
    refers = head.get("X-Refers-To-Page-ID")
    page = head.get("X-Page-ID")
    return (
        int(page) if page is not None else None,
        head["WARC-Record-ID"][1:-1],
        head.get("WARC-Target-URI"),
        kind,
        int(refers) if refers is not None else None,
        n,
        told,
        body if kind == "response" else None,
    )


def smaller_twins(pages: DataFrame) -> DataFrame:
    """(page_id, digest, first): pages for whose payload a smaller id exists.

    ``first`` is the smallest id of the payload.  Digests are aggregated with a
    map-side combine; only digests of several ids meet the pages again.
    """
    first = pages.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("_last"))
    shared = first.where("first < _last").select("digest", "first")
    return pages.join(shared, "digest").where("first < page_id").select("page_id", "digest", "first").distinct()


def write_archives(
    pages: DataFrame,
    folder: str,
    frame_bytes: int = 256 << 10,
    bundle_bytes: int = 32 << 20,
    level: int = 3,
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles below ``folder`` (a URI
    that driver and executors share) and return the index, written beside them.

    A null html is an empty payload; a null url gives a record without target.
    Of rows that repeat a page id with the same payload the first is the
    response and the others revisit it.  Rows without an id stand outside this
    order and are responses.  Payloads of fewer than ``min_revisit_bytes`` bytes are always responses.  Further
    columns are not read; an empty table gives an empty index and no bundle.
    """
    spark = pages.sparkSession
    importable(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    slim = rows.where(F.length("payload") >= min_revisit_bytes).select(
        "page_id", F.unhex(F.sha1("payload")).alias("digest")
    )
    twins = smaller_twins(write_shared(slim, "digests"))
    both = rows.select("page_id", "url", "payload", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("first"))
    both = both.unionByName(twins, allowMissingColumns=True)
    # Null ids are spread by their payload; all rows of an id meet in one task,
    # what is known about them first.
    spread = F.coalesce("page_id", F.xxhash64("payload"))
    laid = both.repartition(spread).sortWithinPartitions(
        F.col("page_id").asc_nulls_last(), F.col("first").isNull(), "url", "digest"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        stem = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        bundle, number, index = None, 0, []
        current, firsts, written, copies = object(), {}, set(), 0
        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            for page_id, url, payload, dig, first in zip(
                ids, urls, batch.column("payload"), batch.column("digest"), batch.column("first")
            ):
                if page_id != current:
                    current, firsts, written, copies = page_id, {}, set(), 0
                if first.is_valid:
                    firsts[dig.as_py()] = first.as_py()
                    continue
                payload = payload.as_py()
                sha = hashlib.sha1(payload).digest()
                refers = firsts.get(sha)
                if refers is None and page_id is not None and len(payload) >= min_revisit_bytes:
                    refers = page_id if sha in written else None
                    written.add(sha)
                if page_id is None:
                    rid = record_id(f"{stem}/{number}/{copies}", 0)
                else:
                    rid = record_id(page_id, copies)
                copies += 1
                if bundle is None:
                    bundle = Bundle(folder, f"{stem}-{number:04d}.warc.zst", frame_bytes, level)
                kind = "response" if refers is None else "revisit"
                bundle.add(warc_record(rid, page_id, url, payload, refers, refers is not None), (rid, page_id, kind))
                if bundle.size >= bundle_bytes:
                    yield _index_batch(bundle.close())
                    bundle, number = None, number + 1
        if bundle is not None:
            yield _index_batch(bundle.close())

    return write_shared(laid.mapInArrow(write, INDEX_SCHEMA), "index")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 4
    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
_NAMES_OUT = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES_OUT)


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that ``index`` names, each bundle read frame by
    frame through its own seek table."""
    importable(index.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in read_bundle(uri):
                    rows.append(row if with_payload else (*row[:-1], None))
                    held += len(row[-1] or b"") if with_payload else 100
                    if held >= 4 << 20:
                        yield _record_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _record_batch(rows)

    bundles = index.select("bundle").distinct()
    # A bundle a task (a few from MAX_READERS on): the list is short, its files are not.
    # By range, as an exchange by hash is left out where the distinct list has as many
    # partitions, and then joined to one task for its few bytes.
    readers = min(max(bundles.count(), 1), MAX_READERS)
    return bundles.repartitionByRange(readers, "bundle").mapInArrow(read, RECORD_SCHEMA)


def fetch_records(wanted: DataFrame) -> DataFrame:
    """The records of the given index rows, each by one ranged read of its frame."""
    importable(wanted.sparkSession)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                fs, path = _fs(r["bundle"])
                with fs.open_input_file(path) as file:
                    data = unpack.decompress(file.read_at(r["frame_bytes"], r["frame_start"]))
                head, http, body, _ = parse_record(memoryview(data), r["offset"])
                yield _record_batch([_row(head, http, body)])

    return wanted.select("bundle", "frame_start", "frame_bytes", "offset").mapInArrow(fetch, RECORD_SCHEMA)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record per ``pages`` row, then read the archives back."""
    pages = table(spark, sf_dir, "pages")
    index = write_archives(pages, shared_path(spark, "archives"))
    records = read_archives(index, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), w AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
         row_number() OVER (PARTITION BY h ORDER BY page_id) AS r
  FROM p
)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r > 1 THEN first END AS refers_to
FROM w
"""
