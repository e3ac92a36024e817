"""Benchmark passages in documents, by SimHash of item-sized windows.

For every benchmark item of L words, documents are looked at in windows of L
words (a shorter document is one window). Windows that share no shingle with
any item can't be similar to one and are passed over; the others get a 64-bit
SimHash of their words by running sums. Fingerprints are looked up among the
items of the same length in a multi-index: 8 blocks of 8 bits, each probed
with its value and the values one bit away. Two fingerprints at most 15 bits
apart have a block at most one bit apart, so every pair within the radius is
found. Each is then verified by the exact weighted similarity of its shingles.

The benchmark is handed to the tasks in blocks of bounded size (arrays, about
ten bytes a byte of its text), one pass over the documents a block; documents
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstrata.llm import textarrays
from tabstrata.llm.pretokens import ragged
from tabstrata.session import scratch_path

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 15
_BLOCKS = 8
#: Bytes of benchmark text in one pass; its index takes about ten times that.
PASS_BYTES = 8 << 20
#: (window, item) pairs that are looked at together.
_PAIRS = 1 << 21
#: Words that one table of running sums covers.
_SUM_WORDS = 8192


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and bytes of every word, and the word offsets of the texts; A-Z lower-cased, ASCII punctuation off the ends of words that have more."""
    start, end, at = textarrays.word_spans(data, offsets)
    return textarrays.hash_spans(textarrays.LOWER[data], start, end), end - start, at


def simhash(h: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit SimHash of the windows ``h[first : first + size]``: the majority of each bit, ties give 0."""
    out = np.zeros(len(first), np.uint64)
    order = np.argsort(first, kind="stable")
    at = 0
    while at < len(order):
        base = int(first[order[at]])
        to = at + int(np.searchsorted(first[order[at:]], base + _SUM_WORDS, "right"))
        these = order[at:to]
        stop = int((first[these] + size[these]).max())
        bits = np.unpackbits(h[base:stop].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.zeros((stop - base + 1, 64), np.int32)
        np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=sums[1:])
        majority = sums[first[these] + size[these] - base] > sums[first[these] - base]
        out[these] = np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)
        at = to
    return out


@dataclass
class _Length:
    """The items of one number of words."""

    words: int
    ids: np.ndarray
    prints: np.ndarray
    edges: np.ndarray  # of each item's entries in shingles, times and weights
    shingles: np.ndarray
    times: np.ndarray
    weights: np.ndarray
    lists: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def build(self) -> None:
        """For each block: items by value, each under the 9 values at most a bit away."""
        near = np.r_[0, 1 << np.arange(8)].astype(np.uint8)
        for b in range(_BLOCKS):
            value = (self.prints >> np.uint64(8 * b)).astype(np.uint8)
            keys = (value[:, None] ^ near[None, :]).reshape(-1)
            items = np.repeat(np.arange(len(self.prints)), len(near))
            order = np.argsort(keys, kind="stable")
            self.lists.append((np.searchsorted(keys[order], np.arange(257)), items[order].astype(np.int32)))

    def item(self, i: int) -> dict[int, tuple[int, int]]:
        """The item's multiset of shingles."""
        own = slice(self.edges[i], self.edges[i + 1])
        return dict(zip(self.shingles[own].tolist(), zip(self.times[own].tolist(), self.weights[own].tolist())))

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of every pair at most ``radius`` bits apart; windows are taken in chunks of about ``_PAIRS`` pairs."""
        step = max(1, _PAIRS // max(1, len(self.prints)))
        if len(prints) > step:
            parts = [self.within(prints[k : k + step], radius) for k in range(0, len(prints), step)]
            window = np.concatenate([w + k * step for k, (w, _, _) in enumerate(parts)])
            return window, np.concatenate([i for _, i, _ in parts]), np.concatenate([d for *_, d in parts])
        pairs = []
        for b, (edge, items) in enumerate(self.lists):
            value = (prints >> np.uint64(8 * b)).astype(np.uint8).astype(np.int64)
            n = edge[value + 1] - edge[value]
            pairs.append(np.repeat(np.arange(len(prints)), n) * len(self.prints) + items[ragged(edge[value], n)])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.prints))
        apart = np.bitwise_count(prints[window] ^ self.prints[item])
        near = apart <= radius
        return window[near], item[near], apart[near]


class Index:
    """Items by length, and their shingles for passing over windows that share none."""

    def __init__(self, ids: list[int], texts: list[str], radius: int = RADIUS):
        if radius >= 2 * _BLOCKS:
            raise ValueError(f"blocks of one bit's tolerance guarantee a radius below {2 * _BLOCKS}")
        self.radius = radius
        data, offsets = textarrays.buffer(textarrays.filled(pa.array(texts, pa.string())))
        h, size, at = _words(data, offsets)
        count = np.diff(at)
        self.lengths: dict[int, _Length] = {}
        told: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n in np.unique(count[count > 0]).tolist():
            own = np.flatnonzero(count == n)
            k = min(SHINGLE, n)
            sets = [multiset(h[at[i] : at[i + 1]], size[at[i] : at[i + 1]], k) for i in own]
            flat = [np.array([f(x) for m in sets for x in m.items()], t) for f, t in ((lambda x: x[0], np.uint64), (lambda x: x[1][0], np.int32), (lambda x: x[1][1], np.int32))]
            group = _Length(n, np.array([ids[i] for i in own]), simhash(h, at[own], count[own]), np.r_[0, np.cumsum([len(m) for m in sets])], *flat)
            group.build()
            self.lengths[n] = group
            keys = np.unique(group.shingles)
            told.setdefault(k, []).append((keys, np.full(len(keys), n)))
        # for each shingle size: shingles, sorted, and the lengths of the items that hold them
        self.keys = {}
        for k, parts in told.items():
            keys, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[keys >> np.uint64(48)] = True
            self.keys[k] = (keys[order], lengths[order], seen)

    def windows(self, h: np.ndarray, at: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per item length: first word, words and text of the windows that share a shingle with an item of that length."""
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        found: dict[int, list[np.ndarray]] = {}
        for k, (keys, lengths, seen) in self.keys.items():
            every = textarrays.chain(h, k)
            if not every.size:
                continue
            place = np.flatnonzero(seen[every >> np.uint64(48)] & (doc[: every.size] == doc[k - 1 :]))
            lo, hi = np.searchsorted(keys, every[place], "left"), np.searchsorted(keys, every[place], "right")
            place, lo, hi = (x[hi > lo] for x in (place, lo, hi))
            hit, size = np.repeat(place, hi - lo), lengths[ragged(lo, hi - lo)]
            for n in np.unique(size).tolist():
                p = hit[size == n]
                a, b = at[doc[p]], at[doc[p] + 1]
                first = np.maximum(a, p - (n - k))
                last = np.maximum(a, np.minimum(p, b - n))
                first = np.minimum(first, last)
                found.setdefault(n, []).append(np.unique(ragged(first, last - first + 1)))
        out = {}
        for n, parts in found.items():
            first = np.unique(np.concatenate(parts))
            out[n] = (first, np.minimum(n, at[doc[first] + 1] - first), doc[first])
        return out


def multiset(h: np.ndarray, size: np.ndarray, k: int) -> dict[int, tuple[int, int]]:
    """Every k-word shingle with how often it is there and its weight, the bytes of its words."""
    k = min(k, len(h))
    heavy = np.convolve(size, np.ones(k, np.int64), "valid") if len(h) else size
    out: dict[int, tuple[int, int]] = {}
    for s, w in zip(textarrays.chain(h, k).tolist(), heavy.tolist()):
        out[s] = (out[s][0] + 1 if s in out else 1, w)
    return out


def similarity(a: dict[int, tuple[int, int]], b: dict[int, tuple[int, int]]) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    both = sum(min(n, b[s][0]) * w for s, (n, w) in a.items() if s in b)
    total = sum(n * w for n, w in a.values()) + sum(n * w for n, w in b.values()) - both
    return both / total if total else 0.0


def leaks(index: Index, data: np.ndarray, offsets: np.ndarray, least: float = SIMILARITY) -> list[dict[int, tuple[float, int, int]]]:
    """For every text: item: (similarity, first word, words) of its best window, the first of equal ones."""
    out: list[dict[int, tuple[float, int, int]]] = [{} for _ in range(len(offsets) - 1)]
    h, size, at = _words(data, offsets)
    for n, (first, words, doc) in index.windows(h, at).items():
        group = index.lengths[n]
        window, item, _ = group.within(simhash(h, first, words), index.radius)
        last, own, items = -1, {}, {i: group.item(i) for i in np.unique(item).tolist()}
        for w, i in zip(window.tolist(), item.tolist()):
            if w != last:
                a, b = first[w], first[w] + words[w]
                last, own = w, multiset(h[a:b], size[a:b], min(SHINGLE, n))
            s = similarity(own, items[i])
            best = out[doc[w]].get(group.ids[i])
            if s >= least and (best is None or s > best[0]):
                out[doc[w]][group.ids[i]] = (s, int(first[w] - at[doc[w]]), int(words[w]))
    return out


_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))


def _mark(index, least: float, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for batch in batches:
            for part, data, offsets in textarrays.slices(batch, "_text"):
                rows = [[{"item_id": int(i), "similarity": s, "first_word": a, "n_words": n} for i, (s, a, n) in sorted(x.items())] for x in leaks(items, data, offsets, least)]
                cols = [part.column("row"), pa.array(rows, _LEAK), *([part.column("_text")] if with_text else [])]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "leaks", "_text"][: len(cols)])
        textarrays.give_back()

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[DataFrame]:
    """The benchmark (id, text) in blocks of about PASS_BYTES, each small enough for the driver; rows of one id are in one block."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("id IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-total // PASS_BYTES) or 1
    for b in range(blocks):
        yield items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)


def mark_leaks(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", keep: list[str] | None = None, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default) and leaks: per item its best window, if that is similar enough.

    An item of fewer than five words has one shingle, all its words; empty
    items and items without an id never match, null and empty texts hold no
    leaks. An empty benchmark gives empty lists. Items with the same id count
    as one, by their best window. With a benchmark of several passes, rows and
    texts are written to the shared folder between passes, so only one index
    is alive at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*(keep if keep is not None else docs.columns)).alias("row"), F.col(text).alias("_text"))
    passes = list(_blocks(benchmark, item_id, text))
    out = None
    for k, block in enumerate(passes):
        last = k == len(passes) - 1
        items = block.collect()
        index = spark.sparkContext.broadcast(Index([r["id"] for r in items], [r["text"] for r in items], radius))
        source = rows if out is None else out.select(F.struct("row", "leaks").alias("row"), "_text")
        kind = source.schema["row"].dataType.simpleString()
        marked = source.mapInArrow(_mark(index, least, not last), f"row {kind}, leaks array<struct<item_id:bigint,similarity:double,first_word:bigint,n_words:bigint>>" + ", _text string" * (not last))
        if out is not None:
            marked = marked.select(F.col("row.row").alias("row"), F.concat("row.leaks", "leaks").alias("leaks"), *(["_text"] if not last else []))
        if not last:
            path = scratch_path(spark, "leaks")
            marked.write.parquet(path)
            index.destroy()
            marked = spark.read.parquet(path)
        out = marked
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns as they were."""
    return mark_leaks(docs, benchmark, item_id, text).filter(F.size("leaks") == 0).select("row.*")
