"""Lines that many documents share, found by a range-partitioned sort of line hashes.

Every line gives one row (128-bit hash of its key, document, position). The
rows are range-partitioned and sorted by hash, document and position, so a
line that a third of the documents hold spans several partitions instead of
filling one. Each partition is streamed once: a run of equal hashes is decided
as soon as it has reached ``min_docs`` documents, so at most the lines of
``min_docs - 1`` documents are held. Only the first and last run of a
partition can continue elsewhere; their counts (two rows a partition) are
added up and their few undecided rows settled with a small join. The result is
a compressed keep bitmap per document; texts are not shuffled for it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstrata.session import scratch_path

_LINES = "h1 long, h2 long, doc_key long, text_key long, pos int"
_FOUND = _LINES + ", kind string, part int, n long, first_doc long, last_doc long, is_first boolean"
_COLUMNS = ["h1", "h2", "doc_key", "text_key", "pos"]


def line_key(line: bytes) -> bytes:
    """The line without space, 09 to 0D at its ends, A-Z lower-cased."""
    return line.strip().lower()


def _line_rows(min_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                digests, sizes, positions = [], [], []
                for text in batch.column("text").to_pylist():
                    n = len(positions)
                    for pos, line in enumerate((text or "").encode().split(b"\n")):
                        key = line_key(line)
                        if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                            digests.append(xxhash.xxh3_128_digest(key))
                            positions.append(pos)
                    sizes.append(len(positions) - n)
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                take = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("doc_key").take(take), batch.column("text_key").take(take), pa.array(positions, pa.int32())],
                    names=_COLUMNS,
                )

    return rows


class _OpenRun:
    """The run of equal hashes that the stream is in: documents so far and the rows not yet decided."""

    def __init__(self, key, opening: bool):
        self.key, self.opening = key, opening
        self.n, self.first_doc, self.last_doc, self.rows, self.began = 0, None, None, [], True

    def add(self, rows: list[np.ndarray]) -> None:
        doc = rows[2]
        self.n += 1 + int(np.count_nonzero(doc[1:] != doc[:-1])) - int(self.last_doc == doc[0])
        self.first_doc = doc[0] if self.first_doc is None else self.first_doc
        self.last_doc = doc[-1]
        first = np.zeros(len(doc), bool)
        first[0], self.began = self.began, False
        self.rows.append((rows, first))

    def decided(self, keep_first: bool) -> list[list[np.ndarray]]:
        """Rows to drop once the run has enough documents; only a first row to keep is held on."""
        gone, kept = [], []
        for rows, first in self.rows:
            go = ~first if keep_first else np.ones(len(first), bool)
            if go.any():
                gone.append([c[go] for c in rows])
            if not go.all():
                kept.append(([c[~go] for c in rows], first[~go]))
        self.rows = kept
        return gone


def _stream(min_docs: int, keep_first: bool):
    """Of sorted lines: rows to drop (kind drop), undecided rows of a partition's end runs (open), counts of its end runs (end)."""

    def found(rows: list[np.ndarray], kind: str, part: int, first: np.ndarray | None = None) -> pa.RecordBatch:
        m = len(rows[0])
        null = pa.nulls(m, pa.int64())
        first = pa.array(np.zeros(m, bool) if first is None else first)
        return pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array([kind] * m), pa.array([part] * m, pa.int32()), null, null, null, first], names=[*_COLUMNS, "kind", "part", "n", "first_doc", "last_doc", "is_first"])

    def end(r: _OpenRun, part: int) -> pa.RecordBatch:
        one = lambda v, t=pa.int64(): pa.array([v], t)
        return pa.RecordBatch.from_arrays(
            [one(int(r.key[0])), one(int(r.key[1])), one(None), one(None), one(None, pa.int32()), pa.array(["end"]), one(part, pa.int32()), one(r.n), one(int(r.first_doc)), one(int(r.last_doc)), one(False, pa.bool_())],
            names=[*_COLUMNS, "kind", "part", "n", "first_doc", "last_doc", "is_first"],
        )

    def closed(r: _OpenRun, part: int, last: bool) -> Iterator[pa.RecordBatch]:
        if r.opening or last:  # it may go on in another partition
            yield end(r, part)
            for rows, first in r.rows:
                yield found(rows, "open", part, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        opened: _OpenRun | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in _COLUMNS]
            h1, h2, doc = rows[:3]
            start = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            stop = np.r_[start[1:], len(h1)]
            for a, b in dict.fromkeys([(start[0], stop[0]), (start[-1], stop[-1])]):
                key = (h1[a], h2[a])
                if opened is None or opened.key != key:
                    if opened is not None:
                        yield from closed(opened, part, last=False)
                    opened = _OpenRun(key, opening=opened is None)
                opened.add([c[a:b] for c in rows])
                if opened.n >= min_docs:
                    for gone in opened.decided(keep_first):
                        yield found(gone, "drop", part)
            if len(start) > 2:  # runs that begin and end in this batch
                fresh = np.r_[True, doc[1:] != doc[:-1]]
                fresh[start] = True
                before = np.r_[0, np.cumsum(fresh)]
                drop = np.zeros(len(h1), bool)
                inner = slice(1, -1)
                drop[start[1] : stop[-2]] = np.repeat((before[stop] - before[start])[inner] >= min_docs, (stop - start)[inner])
                if keep_first:
                    drop[start] = False
                if drop.any():
                    yield found([c[drop] for c in rows], "drop", part)
        if opened is not None:
            yield from closed(opened, part, last=True)

    return run


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_key and text_key name a row; a row without an id goes by its text."""
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumns({"_text_key": key, "_doc_key": F.coalesce(F.col(doc_id).cast("long"), key)})


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_key, text_key, pos) of every line to drop.

    A line's key must have ``min_chars`` code points and be in ``min_docs``
    documents (distinct ids); then all its lines go, or all but the first in
    order of (id, text key, position) with ``keep_first``.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, doc_id, text).select(F.col("_doc_key").alias("doc_key"), F.col("_text_key").alias("text_key"), F.col(text).alias("text"))
    lines = keyed.mapInArrow(_line_rows(min_chars), _LINES)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(parts, *_COLUMNS).sortWithinPartitions(*_COLUMNS)
    path = scratch_path(spark, "line-dedup")
    ordered.mapInArrow(_stream(min_docs, keep_first), _FOUND).write.parquet(path)
    found = spark.read.parquet(path)
    # a document whose lines lie on both sides of a border was counted twice
    along = Window.partitionBy("h1", "h2").orderBy("part")
    ends = found.filter("kind = 'end'").withColumn("n", F.col("n") - F.coalesce((F.lag("last_doc").over(along) == F.col("first_doc")).cast("long"), F.lit(0)))
    totals = ends.groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min("part").alias("first_part"))
    opened = found.filter("kind = 'open'").join(totals, ["h1", "h2"])
    go = F.col("total") >= min_docs
    if keep_first:
        go &= ~(F.col("is_first") & (F.col("part") == F.col("first_part")))
    key = ["doc_key", "text_key", "pos"]
    return found.filter("kind = 'drop'").select(*key).unionByName(opened.filter(go).select(*key))


def _bitmap(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups:
        maps = []
        for gone in batch.column("gone").to_pylist():
            keep = np.ones((max(gone) // 8 + 1) * 8, bool)
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_key"), batch.column("text_key"), pa.array(maps, pa.binary())], names=["doc_key", "text_key", "keep"])


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """doc_key, text_key, keep of every row that loses a line.

    ``keep`` is a zlib-compressed bitmap with one bit a line (1: keep); lines
    past its end are kept. Repeated rows (same id and text) share one bitmap.
    """
    gone = dropped_lines(docs, doc_id, text, min_docs, min_chars, keep_first)
    listed = gone.groupBy("doc_key", "text_key").agg(F.collect_set("pos").alias("gone"))
    return listed.mapInArrow(_bitmap, "doc_key long, text_key long, keep binary")


def kept_lines(text: str | None, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the kept text as UTF-8."""
    lines = (text or "").encode().split(b"\n")
    if keep is None:
        return len(lines), 0, b"\n".join(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    stay = [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]
    return len(lines), len(lines) - len(stay), b"\n".join(stay)


def _apply(names: list[str], digest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                done = [kept_lines(t, k) for t, k in zip(batch.column("_text").to_pylist(), batch.column("_keep").to_pylist())]
                n, gone = pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64())
                out = pa.array([hashlib.sha256(d[2]).hexdigest() for d in done]) if digest else pa.array([d[2].decode() for d in done])
                yield pa.RecordBatch.from_arrays([batch.column("_row"), n, gone, out], names=names)

    return rows


def drop_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: bool = False, **rule) -> DataFrame:
    """row (struct of all columns of ``docs``), n_lines, n_dropped and kept_text, or its SHA-256 as kept_sha256.

    Null and empty texts have one empty line; a null text is given back as an
    empty one. An empty table gives no rows. A text whose lines all go is empty.
    """
    maps = keep_bitmaps(docs, doc_id, text, **rule)
    row = F.struct(*([doc_id] if digest else docs.columns))
    keyed = _keyed(docs.select(row.alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    maps = maps.select(F.col("doc_key").alias("_dk"), F.col("text_key").alias("_tk"), F.col("keep").alias("_keep"))
    joined = keyed.join(maps, (F.col("_doc_key") == F.col("_dk")) & (F.col("_text_key") == F.col("_tk")), "left")
    last = "kept_sha256" if digest else "kept_text"
    kind = keyed.schema["_row"].dataType.simpleString()
    return joined.select("_row", "_text", "_keep").mapInArrow(_apply(["row", "n_lines", "n_dropped", last], digest), f"row {kind}, n_lines long, n_dropped long, {last} string")


def dedup_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", drop_emptied: bool = False, **rule) -> DataFrame:
    """``docs`` with the shared lines out of their texts (and ``n_chars`` set anew if there is such a column).

    A text that loses nothing stays as it is, a null too. With ``drop_emptied``
    the rows go whose lost lines were all their text.
    """
    done = drop_shared_lines(docs, doc_id, text, **rule)
    changed = F.col("n_dropped") > 0
    if drop_emptied:
        done = done.filter(~changed | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    cols = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = F.when(changed, F.col("kept_text")).otherwise(value)
        elif c == n_chars:
            value = F.when(changed, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(value)
        cols.append(value.alias(c))
    return done.select(*cols)
