"""Cross-entropy difference of a target and a background bigram model.

Both models are fitted alike on one vocabulary: all words that the documents hold
``min_count`` times or more (it grows with the corpus), one id for all other words
and one for the start and end of a text. The background model counts all
documents, the target model those marked as target. A document is scored with its
own counts taken out of both, so that a target document isn't favoured by its own
text. The score is the mean over its predictions of (target loss - background
loss): lower is closer to the target.

    p1(w)   = (c(w) + ALPHA) / (N + ALPHA V)
    p(w|v)  = (c(v w) + PRIOR p1(w)) / (c(v) + PRIOR)

Texts are written once, in blocks, to the shared folder: as numbers into the
block's own list of words. The distinct words of each block go to ranges of word
hashes, where corpus counts are added up and sent back to the blocks that have the
word; then the same is done with the blocks' distinct bigrams. A bigram with a word
that occurs in no other block needs no question: the block's count is the corpus
count. Losses are summed per document inside the block. A frequent word or bigram
is one entry a block, and no vocabulary or table of counts is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstrata.llm import textarrays
from tabstrata.session import scratch_path

MIN_COUNT, ALPHA, PRIOR = 2, 0.5, 50.0
#: Bytes of text that a task gathers into one block.
BLOCK_BYTES = 6 << 20
#: Ranges of hashes: this many for each shuffle partition, more where a range would answer for more bytes of text than this. One task holds one range.
RANGES, RANGE_BYTES = 2, 16 << 20
#: Target ids that may be broadcast (64 MB); more are joined to the documents instead.
BROADCAST_IDS = 8_000_000
_OTHER, _EDGE, _FIRST = 0, 1, 2
_MUL = np.uint64(0x9E3779B97F4A7C15)
_PACKED = ["keys", "counts", "targets", "seq", "words", "ids", "nulls", "marks"]
_BLOCK = "block string, bucket int, n_rows long, n_marked long, " + ", ".join(f"{c} binary" for c in _PACKED)
_ASKED = "block string, bucket int, keys binary, counts binary, targets binary"
_TOTALS = ["kept", "n", "t", "n_other", "t_other"]
_WORDS = "block string, bucket int, ranks binary, counts binary, targets binary, " + ", ".join(f"{c} long" for c in _TOTALS)


def among(ids: pa.Array, chosen: np.ndarray) -> pa.Array:
    """Whether each id is one of the sorted ones; a null id isn't."""
    value = ids.fill_null(0).to_numpy()
    at = np.minimum(np.searchsorted(chosen, value), max(0, len(chosen) - 1))
    hit = (chosen[at] == value) if len(chosen) else np.zeros(len(value), bool)
    return pa.array(hit & ids.is_valid().to_numpy(zero_copy_only=False))


def _by_range(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int, np.uint64]]:
    """Number, first and last place and least possible hash of every range that sorted hashes fall into."""
    least = np.array([(k << 64) // ranges for k in range(ranges)], np.uint64)
    edge = np.r_[np.searchsorted(keys, least), len(keys)]
    for k in np.flatnonzero(np.diff(edge)):
        yield int(k), edge[k], edge[k + 1], least[k]


class _Block:
    """Texts gathered into one block: their words' hashes and the rows' ids and marks."""

    def __init__(self):
        self.bytes, self.rows = 0, []

    def add(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        h, at = textarrays.word_hashes(data, offsets)
        self.rows.append((part.column("doc_id"), part.column("target"), np.diff(at), h))
        self.bytes += data.size + 8 * part.num_rows

    def send(self, block: str, ranges: int) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        ids, mark = (pa.concat_arrays([r[k] for r in self.rows]) for k in (0, 1))
        mark = mark.fill_null(False).to_numpy(zero_copy_only=False)
        words, h = (np.concatenate([r[k] for r in self.rows]) for k in (2, 3))
        own, seq = np.unique(h, return_inverse=True)
        n = np.bincount(seq, minlength=len(own))
        t = np.bincount(seq, np.repeat(mark, words), len(own)).astype(np.int64)
        pack = textarrays.pack
        yield _row(
            block, None, len(mark), int(mark.sum()), seq=pack(seq), words=pack(words), ids=pack(ids.fill_null(0).to_numpy()),
            nulls=np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), marks=np.packbits(mark).tobytes(),
        )
        for k, a, b, least in _by_range(own, ranges):
            yield _row(block, k, None, None, keys=textarrays.pack_sorted(own[a:b] - least), counts=pack(n[a:b]), targets=pack(t[a:b]))


def _row(block: str, bucket: int | None, n_rows: int | None, n_marked: int | None, **packed: bytes) -> pa.RecordBatch:
    numbers = [pa.array([bucket], pa.int32()), pa.array([n_rows], pa.int64()), pa.array([n_marked], pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([block]), *numbers, *(pa.array([packed.get(c)], pa.binary()) for c in _PACKED)], names=["block", "bucket", "n_rows", "n_marked", *_PACKED])


def _blocks(chosen, ranges: int):
    """``chosen``: the target ids, sorted, or None where the rows have a column ``target``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            if chosen is not None:
                batch = batch.append_column("target", among(batch.column("doc_id"), chosen.value))
            for rows, data, offsets in textarrays.slices(batch, "_text"):
                block.add(rows, data, offsets)
                if block.bytes >= BLOCK_BYTES:
                    yield from block.send(f"{part}-{n}", ranges)
                    n, block = n + 1, _Block()
        yield from block.send(f"{part}-{n}", ranges)

    return run


def _added(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Of one range's keys in all blocks: the place of every block's key among the distinct ones, where blocks end, and the distinct keys' two counts."""
    keys = [textarrays.unpack_sorted(b) for b in table.column("keys").to_pylist()]
    every, which = np.unique(np.concatenate(keys), return_inverse=True)
    add = lambda c: np.bincount(which, np.concatenate([textarrays.unpack(b) for b in table.column(c).to_pylist()]).astype(np.int64), len(every)).astype(np.int64)
    return which, np.cumsum([len(k) for k in keys])[:-1], add("counts"), add("targets")


def _cut(values: np.ndarray, at, pack=textarrays.pack) -> pa.Array:
    return pa.array([pack(x) for x in np.split(values, at)], pa.binary())


def _merge_words(min_count: int):
    """For each block the corpus counts of its words and their ranks among the range's kept words; and one row of totals."""

    def run(table: pa.Table) -> pa.Table:
        which, at, n, t = _added(table)
        kept = n >= min_count
        rank = np.maximum(np.cumsum(kept) - 1, 0)
        totals = dict(zip(_TOTALS, (kept.sum(), n[kept].sum(), t[kept].sum(), n[~kept].sum(), t[~kept].sum())))
        sent = {"block": table.column("block"), "bucket": table.column("bucket"), "ranks": _cut(rank[which], at, textarrays.pack_sorted), "counts": _cut(n[which], at), "targets": _cut(t[which], at)}
        return pa.concat_tables([pa.table(sent), pa.table({c: pa.array([int(v)], pa.int64()) for c, v in totals.items()})], promote_options="default").select([c.split()[0] for c in _WORDS.split(", ")])

    return run


def _merge_bigrams(table: pa.Table) -> pa.Table:
    """For each block the corpus counts of the bigrams that it asked for."""
    which, at, n, t = _added(table)
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": _cut(n[which], at), "targets": _cut(t[which], at)})


def _joined(rows: list[dict], column: str, unpack=textarrays.unpack) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(unpack(r[column]) for r in rows)]).astype(np.int64)


class _Opened:
    """A block with the corpus counts of its words: its documents' bigrams, and which of them other blocks may have too."""

    def __init__(self, head: pa.Table, told: list[dict], ranges: int, min_count: int):
        (have,) = head.to_pylist()
        told = sorted(told, key=lambda r: r["bucket"])
        whole = lambda c: textarrays.unpack(have[c]).astype(np.int64)
        self.words, seq, self.ids = whole("words"), whole("seq"), whole("ids")
        bits = lambda c: np.unpackbits(np.frombuffer(have[c], np.uint8))[: len(self.words)].astype(bool)
        self.mark, self.null = bits("marks"), bits("nulls")
        self.n, self.t, rank = _joined(told, "counts"), _joined(told, "targets"), _joined(told, "ranks", textarrays.unpack_sorted)
        kept = self.n >= min_count
        bucket = np.concatenate([np.zeros(0, np.int64), *(np.full(len(textarrays.unpack(r["counts"])), r["bucket"]) for r in told)])
        name = np.r_[_OTHER, _EDGE, rank * ranges + bucket + _FIRST].astype(np.uint64)
        id_ = np.where(kept, np.arange(len(kept)) + _FIRST, _OTHER)[seq]
        at = np.r_[0, np.cumsum(self.words)]
        size, n_docs = len(kept) + _FIRST, len(self.words)
        first, second = np.insert(id_, at[:-1], _EDGE), np.insert(id_, at[1:], _EDGE)
        doc = np.repeat(np.arange(n_docs), self.words + 1)
        entry, self.freq = np.unique((first * size + second) * n_docs + doc, return_counts=True)
        key, self.doc = entry // n_docs, entry % n_docs
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.spread = np.diff(np.r_[start, len(key)])
        self.first, self.second = key // size, key % size
        f, s = self.first[start], self.second[start]
        self.own = np.add.reduceat(self.freq, start)
        self.own_target = np.add.reduceat(self.freq * self.mark[self.doc], start)
        here = np.r_[False, False, np.bincount(seq, minlength=len(kept)) == self.n]  # all the word's places are in this block
        asked = np.flatnonzero(~(here[f] | here[s]))
        h = textarrays.mix(textarrays.mix(name[f[asked]]) * _MUL + name[s[asked]])
        order = np.argsort(h, kind="stable")
        self.asked, self.hash = asked[order], h[order]


def _ask(ranges: int, min_count: int):
    """A block's questions: its open bigrams, one row per range of hashes."""

    def run(head: pa.Table, told: pa.Table) -> pa.Table:
        block, pack = _Opened(head, told.to_pylist(), ranges, min_count), textarrays.pack
        out, n, t = [], block.own[block.asked], block.own_target[block.asked]
        for k, a, b, least in _by_range(block.hash, ranges):
            out.append((head.column("block")[0].as_py(), k, textarrays.pack_sorted(block.hash[a:b] - least), pack(n[a:b]), pack(t[a:b])))
        types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array([r[k] for r in out], types[k]) for k in range(5)], names=["block", "bucket", "keys", "counts", "targets"])

    return run


def losses(first, second, doc, freq, counts: np.ndarray, uni: np.ndarray, total: int, size: int, own: np.ndarray, n_docs: int) -> np.ndarray:
    """Sum over each document's predictions of -log p under one model of ``size`` words and ``total`` predictions.

    ``uni``: counts by the ids used here; ``own``: 1 where the document's counts are in the model.
    """
    n = len(uni)
    pair, which = np.unique(doc * n + second, return_inverse=True)
    mine = np.bincount(which, freq, len(pair))
    at = np.searchsorted(pair, doc * n + first)  # every context is predicted too, the start by the end
    out = own[doc]
    n_own = np.bincount(doc, freq, n_docs)[doc] * out
    p1 = (uni[second] - mine[which] * out + ALPHA) / (total - n_own + ALPHA * size)
    p = (counts - freq * out + PRIOR * p1) / (uni[first] - mine[at] * out + PRIOR)
    return np.bincount(doc, -np.log(p) * freq, n_docs)


def _score(ranges: int, min_count: int, size: int, other: tuple[int, int], edge: tuple[int, int], total: tuple[int, int]):
    def run(head: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        b = _Opened(head, [r for r in rows if r["ranks"] is not None], ranges, min_count)
        answers = sorted((r for r in rows if r["ranks"] is None), key=lambda r: r["bucket"])
        loss = []
        for k, (uni, own, column, mine) in enumerate(((b.n, b.own, "counts", np.ones(len(b.words))), (b.t, b.own_target, "targets", b.mark.astype(float)))):
            counts = own.copy()
            counts[b.asked] = _joined(answers, column)
            uni = np.r_[other[k], edge[k], uni]
            loss.append(losses(b.first, b.second, b.doc, b.freq, np.repeat(counts, b.spread), uni, total[k], size, mine, len(b.words)) / (b.words + 1))
        return pa.table({"doc_id": pa.array(b.ids, mask=b.null), "n_words": b.words, "loss_target": loss[1], "loss_background": loss[0], "score": loss[1] - loss[0]})

    return run


def score(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """doc_id, n_words, loss_target, loss_background and score (their difference) of every row of ``docs``.

    ``targets`` holds the ids of the target documents in a column ``doc_id``.
    Words that all texts together hold less than ``min_count`` times share one id.
    Losses are per prediction: the words and the end. Null and empty texts have
    just the end to predict; repeated rows count and are scored one by one; a
    null id is no target. An empty table gives no rows; without any target the
    target model is the smoothing prior.
    """
    spark = docs.sparkSession
    chosen = targets.select(F.col("doc_id").cast("long").alias("_id")).dropna().distinct()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    n_bytes = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    ranges = max(RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // RANGE_BYTES))
    if chosen.count() <= BROADCAST_IDS:
        ids = np.sort(chosen.toArrow().column("_id").to_numpy())
        known = spark.sparkContext.broadcast(ids)
    else:
        known = None
        rows = rows.join(chosen.withColumn("target", F.lit(True)), F.col("doc_id") == F.col("_id"), "left").select("doc_id", "_text", "target")
    folder = scratch_path(spark, "lm-blocks")
    rows.mapInArrow(_blocks(known, ranges), _BLOCK).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.parquet(folder)
    folder = scratch_path(spark, "lm-words")
    asked = blocks.filter("bucket IS NOT NULL").select("block", "bucket", "keys", "counts", "targets")
    asked.groupBy("bucket").applyInArrow(_merge_words(min_count), _WORDS).write.option("compression", "zstd").parquet(folder)
    told = spark.read.parquet(folder)
    sums = told.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS)).first()
    edge = tuple(blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_rows", "n_marked"))).first())
    other = (sums["n_other"], sums["t_other"])
    total = (sums["n"] + other[0] + edge[0], sums["t"] + other[1] + edge[1])
    heads = blocks.filter("bucket IS NULL").select("block", "seq", "words", "ids", "nulls", "marks")
    told = told.filter("block IS NOT NULL").select("block", "bucket", "ranks", "counts", "targets")
    grams = heads.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_ask(ranges, min_count), _ASKED)
    answers = grams.groupBy("bucket").applyInArrow(_merge_bigrams, "block string, bucket int, counts binary, targets binary")
    both = told.unionByName(answers, allowMissingColumns=True)
    last = _score(ranges, min_count, sums["kept"] + _FIRST, other, edge, total)
    return heads.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(last, "doc_id long, n_words long, loss_target double, loss_background double, score double")
