"""WARC archives: a writer with revisit records and a splittable reader.

Archives are files of one gzip member per record in the cluster's shared
folder. The reader cuts files into byte ranges. A task scans its range for the
gzip magic, takes a place as a member only if its decoded start is a WARC
header block, and owns every record that starts in its range; the last one may
be read on past the range's end. So no index is needed and a lost task is
simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
SPLIT_BYTES = 16 << 20
_RECORD = "file string, offset long, length long, record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to string, page_id long, refers_to_page long, payload binary"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (also file:/path, as Spark writes it) and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)/*", "file:///", folder))


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The same id on every run: a name-based UUID."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id} {digest}')}>"


def _clean(value: str | None) -> str:
    """Header values are one line."""
    return re.sub(r"[\x00-\x20\x7f]+", "%20", value or "")


def member(page_id: int | None, url: str | None, payload: bytes, response: int | None, revisit: bool, level: int = 6) -> bytes:
    """One record as a gzip member; a revisit has no payload but its digest and length."""
    digest = payload_digest(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Target-URI: {_clean(url)}",
        "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(response, digest)}", f"X-Refers-To-Page-ID: {response}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, path = _store(folder)
        name = f"{path}/part-{part:05d}.warc.gz"
        hidden = f"{path}/.part-{part:05d}-{attempt}"
        n = size = 0
        with store.open_output_stream(hidden, compression=None) as out:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    for r in batch.slice(at, 256).to_pylist():
                        out.write(done := member(r["page_id"], r["url"], (r["html"] or "").encode(), r["response"], r["revisit"]))
                        n, size = n + 1, size + len(done)
        if store.get_file_info(name).type != fs.FileType.NotFound:
            store.delete_file(name)  # of an attempt before this one
        store.move(hidden, name)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([f"part-{part:05d}.warc.gz"]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["file", "n", "bytes"])

    return run


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> int:
    """Write a record for every row; returns the number of records.

    Of the rows with equal payloads of at least ``min_bytes`` bytes, those with
    the largest page id are responses, the others revisit it. A null page id is
    smaller than any; rows repeated with the largest id are all responses. A
    null html is an empty payload. Only payload digests are grouped, and the
    groups of one row are left out of the join.
    """
    spark = pages.sparkSession
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    whole = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    keyed = rows.select("*", F.sha1(whole).alias("sha"), F.octet_length(F.coalesce(F.col(html), F.lit(""))).alias("size"))
    groups = keyed.filter(F.col("size") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("sha").alias("_sha"), "response")
    joined = keyed.join(groups, F.col("sha") == F.col("_sha"), "left")
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    done = joined.select("page_id", "url", "html", "response", revisit.alias("revisit")).mapInArrow(_write(folder), "file string, n long, bytes long")
    return done.agg(F.sum("n")).first()[0] or 0


class _Range:
    """Bytes of a file from ``start`` on, read in chunks."""

    def __init__(self, handle, start: int):
        self.handle, self.base, self.data = handle, start, b""
        handle.seek(start)

    def more(self) -> bool:
        got = self.handle.read(_CHUNK)
        self.data += got
        return bool(got)

    def forget(self, upto: int) -> None:
        """Let go of the bytes before the file offset ``upto``."""
        self.data, self.base = self.data[upto - self.base :], upto


def _headers(block: bytes) -> dict[str, str] | None:
    """The WARC header fields if the bytes begin with a whole header block."""
    end = block.find(b"\r\n\r\n")
    if end < 0 or not re.match(rb"WARC/\d\.\d\r\n", block):
        return None
    fields = {}
    for line in block[:end].decode(errors="replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def _member_at(view: _Range, offset: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields, block and end offset of the record whose member starts at ``offset``; None if there is none."""
    unzip, out, at, fields = zlib.decompressobj(31), [], offset - view.base, None
    seen = b""
    while not unzip.eof:
        if at >= len(view.data) and not view.more():
            return None
        try:
            got = unzip.decompress(view.data[at : at + _CHUNK])
        except zlib.error:
            return None
        at = min(at + _CHUNK, len(view.data))
        out.append(got)
        if fields is None:
            seen += got
            fields = _headers(seen)
            if seen[:5] != b"WARC/"[: len(seen)] or fields is None and len(seen) > 1 << 20:
                return None
    whole = b"".join(out)
    fields = fields or _headers(whole)
    if fields is None:
        return None
    head = whole.find(b"\r\n\r\n") + 4
    size = int(fields["content-length"])
    if whole[head + size :] != b"\r\n\r\n":
        return None
    return fields, whole[head : head + size], view.base + at - len(unzip.unused_data)


def _read(folder: str, with_payload: bool):
    def record(file: str, offset: int, fields: dict[str, str], block: bytes, end: int) -> dict:
        number = lambda name: int(fields[name]) if name in fields else None
        payload = block.partition(b"\r\n\r\n")[2]
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if fields["warc-type"] == "response" and payload_digest(payload) != digest:
            raise ValueError(f"{file}, record at {offset}: the payload doesn't have its digest")
        return {
            "file": file, "offset": offset, "length": end - offset, "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "payload_digest": digest,
            "payload_bytes": len(payload) if fields["warc-type"] == "response" else number("x-payload-length"), "refers_to": fields.get("warc-refers-to"), "page_id": number("x-page-id"), "refers_to_page": number("x-refers-to-page-id"),
            "payload": payload if with_payload else None,
        }

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("page_id", pa.int64()), ("refers_to_page", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            for s in batch.to_pylist():
                with store.open_input_file(f"{path}/{s['file']}") as handle:
                    view, rows = _Range(handle, s["start"]), []
                    offset = s["start"]
                    while offset < s["stop"]:
                        at = view.data.find(_MAGIC, offset - view.base)
                        if at < 0:  # keep two bytes: the magic may lie across chunks
                            offset = max(offset, view.base + len(view.data) - 2)
                            view.forget(offset)
                            if not view.more():
                                break
                            continue
                        offset = view.base + at
                        if offset >= s["stop"]:
                            break
                        got = _member_at(view, offset)
                        if got is None:  # three bytes of something else
                            offset += 1
                            continue
                        rows.append(record(s["file"], offset, *got))
                        offset = got[2]
                        view.forget(offset)
                        if len(rows) >= 256:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def splits(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, start, stop of byte ranges that cover the folder's archives."""
    store, path = _store(folder)
    files = [(f.base_name, f.size) for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".warc.gz") and f.size]
    named = spark.createDataFrame(files, "file string, size long")
    starts = named.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = starts.select("file", "start", F.least(F.col("start") + split_bytes, "size").alias("stop"))
    return ranges.repartition(max(1, sum(-(-size // split_bytes) for _, size in files)))


def read_archive(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``, wherever the ranges cut the files. No archives give no rows."""
    return splits(spark, folder, split_bytes).mapInArrow(_read(folder, with_payload), _RECORD)
