"""Token counts by merging every distinct pre-token of the corpus once.

Each task turns its texts into pre-tokens and writes blocks to the shared
folder: the per-document pre-token frequencies as one row, and the distinct
pre-tokens of the block as one row for each range of hashes. The ranges are
grouped; a range's task merges each of its distinct pre-tokens once with the
tokenizers library and answers every block with the token numbers of its
pre-tokens. Joined to the frequencies by block, they are summed per document.
No ids are made and no text is shuffled; a frequent pre-token is one entry a
block, so it loads no task more than others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabstrata.llm import pretokens, textarrays
from tabstrata.session import scratch_path

#: Bytes of text that a task gathers into one set of blocks, and those for which there is a range of hashes at least.
BLOCK_BYTES, RANGE_BYTES = 8 << 20, 16 << 20
_BLOCK = "block string, bucket int, pieces binary, sizes binary, counts binary, docs binary, freqs binary, ids binary, nulls binary, n_bytes binary, own binary"
_PACKED = [c.split()[0] for c in _BLOCK.split(", ")[2:]]


@lru_cache(4)
def library(path: str) -> Tokenizer:
    """The tokenizer at ``path``; it must be byte-level BPE with the published split pattern and no normalizer."""
    with open(path) as f:
        told = json.load(f)
    pre = told["pre_tokenizer"] or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if not plain or told["normalizer"] or told["model"]["type"] != "BPE" or told["truncation"] or told["padding"]:
        raise ValueError(f"{path}: not plain byte-level BPE")
    return Tokenizer.from_str(json.dumps(told))


def _specials(tokenizer: Tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def _ranges(buckets: int) -> np.ndarray:
    """First hash of every range."""
    return np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)


def _row(block: str, bucket: int | None, **packed: bytes) -> pa.RecordBatch:
    cols = [pa.array([block]), pa.array([bucket], pa.int32()), *(pa.array([packed.get(c)], pa.binary()) for c in _PACKED)]
    return pa.RecordBatch.from_arrays(cols, names=["block", "bucket", *_PACKED])


class _Block:
    """Pre-token frequencies of some documents of a task, until they are sent."""

    def __init__(self):
        self.bytes, self.base, self.parts, self.rows = 0, 0, [], []

    def add(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, tokenizer: Tokenizer, specials: list[str]) -> None:
        raw = data.tobytes()
        tokens = np.zeros(part.num_rows, np.int64)
        own = np.zeros(part.num_rows, bool)
        for special in specials:
            mark = special.encode()
            if mark in raw:  # texts with special strings are rare: the library takes them whole
                for i in range(part.num_rows):
                    own[i] |= mark in raw[offsets[i] : offsets[i + 1]]
        for i in np.flatnonzero(own):
            tokens[i] = len(tokenizer.encode(raw[offsets[i] : offsets[i + 1]].decode(), add_special_tokens=False).ids)
        start, end, at = pretokens.pretokens(data, offsets)
        doc = np.repeat(np.arange(part.num_rows), np.diff(at))
        if own.any():
            stay = ~own[doc]
            start, end, doc = start[stay], end[stay], doc[stay]
        hashes, one, which = np.unique(textarrays.hash_spans(data, start, end), return_index=True, return_inverse=True)
        pair, freq = np.unique(which.astype(np.uint64) << np.uint64(32) | doc.astype(np.uint64), return_counts=True)
        size = (end - start)[one]
        spelled = data[pretokens.ragged(start[one], size)]
        self.parts.append((hashes, size, spelled, (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64) + self.base, freq))
        self.rows.append((part.column("doc_id"), np.diff(offsets), tokens))
        self.base += part.num_rows
        self.bytes += data.size

    def send(self, block: str, buckets: int) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        ids = pa.concat_arrays([r[0] for r in self.rows])
        # one list of distinct pieces, in order of their hashes, for all parts
        every, size, spelled = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        begin = np.cumsum(size) - size
        hashes, one, which = np.unique(every, return_index=True, return_inverse=True)
        base = np.cumsum([0, *(len(p[0]) for p in self.parts)])
        piece = np.concatenate([which[b + p[3]] for b, p in zip(base, self.parts)])
        order = np.argsort(piece, kind="stable")
        doc, freq = (np.concatenate([p[k] for p in self.parts])[order] for k in (4, 5))
        edge = np.r_[np.searchsorted(hashes, _ranges(buckets)), len(hashes)]
        pack = textarrays.pack
        yield _row(
            block, None, counts=pack(np.bincount(piece, minlength=len(hashes))), docs=pack(doc), freqs=pack(freq), ids=pack(ids.fill_null(0).to_numpy()),
            nulls=np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), n_bytes=pack(np.concatenate([r[1] for r in self.rows])), own=pack(np.concatenate([r[2] for r in self.rows])),
        )
        for k in np.flatnonzero(np.diff(edge)):
            these = one[edge[k] : edge[k + 1]]
            yield _row(block, int(k), pieces=spelled[pretokens.ragged(begin[these], size[these])].tobytes(), sizes=pack(size[these]))


def _blocks(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library(path)
        specials = _specials(tokenizer)
        part, n, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            for rows, data, offsets in textarrays.slices(batch, "_text"):
                block.add(rows, data, offsets, tokenizer, specials)
                if block.bytes >= BLOCK_BYTES:
                    yield from block.send(f"{part}-{n}", buckets)
                    n, block = n + 1, _Block()
        yield from block.send(f"{part}-{n}", buckets)

    return run


def _merge(path: str):
    """Of one range's pre-tokens in all blocks: for each block the number of tokens of each."""

    def run(table: pa.Table) -> pa.Table:
        model = library(path).model
        known: dict[bytes, int] = {}
        counts = []
        for pieces, sizes in zip(table.column("pieces").to_pylist(), table.column("sizes").to_pylist()):
            end = np.cumsum(textarrays.unpack(sizes).astype(np.int64)).tolist()
            numbers = []
            for a, b in zip([0, *end], end):
                piece = pieces[a:b]
                n = known.get(piece)
                if n is None:
                    n = known[piece] = len(model.tokenize(pretokens.as_characters(piece)))
                numbers.append(n)
            counts.append(textarrays.pack(np.array(numbers, np.int64)))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "own": pa.array(counts, pa.binary())})

    return run


def _sum(table: pa.Table) -> pa.Table:
    """Of one block's frequencies and the answers of all ranges: a row per document."""
    rows = sorted(table.to_pylist(), key=lambda r: -1 if r["bucket"] is None else r["bucket"])
    have, answers = rows[0], rows[1:]
    whole = lambda c: textarrays.unpack(have[c]).astype(np.int64)
    tokens = np.concatenate([np.zeros(0, np.uint64), *(textarrays.unpack(r["own"]) for r in answers)]).astype(np.int64)
    total = whole("own")
    each = np.repeat(tokens, whole("counts")) * whole("freqs")
    total += np.bincount(whole("docs"), each, len(total)).astype(np.int64)
    null = np.unpackbits(np.frombuffer(have["nulls"], np.uint8))[: len(total)].astype(bool)
    return pa.table({"doc_id": pa.array(whole("ids"), mask=null), "n_bytes": whole("n_bytes"), "n_tokens": total})


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs``, as the library's ``encode`` counts without added begin and end tokens.

    Null and empty texts have no tokens, repeated rows and ids stay apart, an
    empty table gives no rows. Other columns are left out.
    """
    library(path)  # fails here, not in a task, if the file is of another kind
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    n_bytes = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // RANGE_BYTES))
    folder = scratch_path(spark, "token-blocks")
    rows.mapInArrow(_blocks(path, buckets), _BLOCK).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.parquet(folder)
    answers = blocks.filter("bucket IS NOT NULL").select("block", "bucket", "pieces", "sizes").groupBy("bucket").applyInArrow(_merge(path), "block string, bucket int, own binary")
    have = blocks.filter("bucket IS NULL").drop("pieces", "sizes")
    return have.unionByName(answers, allowMissingColumns=True).groupBy("block").applyInArrow(_sum, "doc_id long, n_bytes long, n_tokens long")


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
