"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A text is the multiset of its five-word shingles, each weighted by how often
the text has it times ``idf``. Texts whose weighted Jaccard similarity is
``SIMILARITY`` or more are linked; a class is a connected set of links.

1. Tasks send their texts' shingles in blocks to ranges of shingle hashes,
   where document frequencies are counted over all documents. Shingles of one
   document only can't be shared; just their total weight is kept. The others
   go back to the blocks. A document with less than ``SIMILARITY`` of its weight
   in shared shingles can have no link (the shared weight is at most that much
   of the union), so it is done.
2. The rest get ``BANDS`` x ``ROWS`` samples by Ioffe's improved consistent
   weighted sampling; the probability that one sample of two texts agrees is
   their similarity. Equal multisets become one node. Nodes that agree in a
   whole band are candidates, tied by stars to the band's least node, so a band
   of m nodes has m - 1 ties.
3. Candidate components are solved exactly by pivots (see ``_solve``): those of
   bounded size in one task, larger ones in rounds over all their nodes (see
   ``_pivot_links``), where tasks compare parts of bounded size, so that neither
   a task nor the driver holds such a component and a large group of near copies
   is never compared pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstrata.llm import textarrays
from tabstrata.llm.components import connected_components
from tabstrata.llm.pretokens import ragged
from tabstrata.session import scratch_path

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 is missed with probability (1 - 0.8**4)**14 = 6e-4.
BANDS, ROWS = 14, 4
#: Share of all documents added to a document frequency: the weight halves for a shingle in about a third of them.
SMOOTHING = 0.1
#: Nodes and bytes of a component that one task solves.
TASK_NODES, TASK_BYTES = 4000, 16 << 20
#: Pivots of a large component in the first round; each round has twice as many as the one before.
PIVOTS = 16
#: Bytes of nodes, and of pivots, of a large component that one task compares.
PART_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
#: Ranges of shingle hashes for each shuffle partition, and the bytes of text for which there is one at least; a range is held in memory by one task.
RANGES, RANGE_BYTES = 4, 16 << 20
_EPS = 1e-9


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p(1.0 / (np.asarray(df, float) / max(n, 1) + SMOOTHING))


# --------------------------------------------------------------------------------------
# shingles and document frequencies
# --------------------------------------------------------------------------------------
_BLOCK = "bucket int, block string, hashes binary, spread binary, docs binary, times binary, ids binary, totals binary"
_ANSWER = "block string, docs binary, hashes binary, times binary, dfs binary, ids binary, totals binary"


class _Block:
    """Shingles of some documents of a task."""

    def __init__(self):
        self.bytes, self.base, self.parts, self.rows = 0, 0, [], []

    def add(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        h, doc, _ = textarrays.shingles(*textarrays.word_hashes(data, offsets), SHINGLE)
        self.parts.append((h, doc + self.base))
        self.rows.append((part.column("doc_id").to_numpy(zero_copy_only=False), np.bincount(doc, minlength=part.num_rows)))
        self.base += part.num_rows
        self.bytes += data.size

    def send(self, block: str, buckets: int) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        ids, total = (np.concatenate([r[k] for r in self.rows]) for k in (0, 1))
        h, doc = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        pair = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
        times = np.diff(np.r_[pair, len(h)])
        h, doc = h[pair], doc[pair]
        start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        spread, own = np.diff(np.r_[start, len(h)]), h[start]
        edge = np.r_[np.searchsorted(own, np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)), len(own)]
        cut = np.r_[start, len(h)][edge]
        pack = textarrays.pack
        home = int(hashlib.md5(block.encode()).hexdigest(), 16) % buckets  # one range carries the documents' ids along
        for k in range(buckets):
            a, b, lo, hi = edge[k], edge[k + 1], cut[k], cut[k + 1]
            if a == b and k != home:
                continue
            row = [textarrays.pack_sorted(own[a:b]), pack(spread[a:b]), pack(doc[lo:hi]), pack(times[lo:hi]), pack(ids) if k == home else None, pack(total) if k == home else None]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block]), *(pa.array([x], pa.binary()) for x in row)], names=[c.split()[0] for c in _BLOCK.split(", ")])


def _blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            for rows, data, offsets in textarrays.slices(batch, "_text"):
                block.add(rows, data, offsets)
                if block.bytes >= BLOCK_BYTES:
                    yield from block.send(f"{part}-{n}", buckets)
                    n, block = n + 1, _Block()
        yield from block.send(f"{part}-{n}", buckets)
        del block
        textarrays.give_back()

    return run


def _frequencies(table: pa.Table) -> pa.Table:
    """Of one range's shingles in all blocks: for each block those of two documents or more, with document frequencies."""
    rows = table.to_pylist()
    hashes = [textarrays.unpack_sorted(r["hashes"]) for r in rows]
    spread = [textarrays.unpack(r["spread"]).astype(np.int64) for r in rows]
    every, which = np.unique(np.concatenate(hashes), return_inverse=True)
    df = np.bincount(which, np.concatenate(spread), len(every)).astype(np.int64)
    out, at = [], 0
    for r, h, s in zip(rows, hashes, spread):
        own = df[which[at : at + len(h)]]
        at += len(h)
        each = np.repeat(own, s)
        keep = each > 1
        pack = textarrays.pack
        out.append({
            "block": r["block"], "docs": pack(textarrays.unpack(r["docs"])[keep]), "hashes": textarrays.pack_sorted(np.repeat(h, s)[keep]), "times": pack(textarrays.unpack(r["times"])[keep]),
            "dfs": pack(each[keep]), "ids": r["ids"], "totals": r["totals"],
        })
    return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.string()), *((c, pa.binary()) for c in ("docs", "hashes", "times", "dfs", "ids", "totals"))]))


# --------------------------------------------------------------------------------------
# improved consistent weighted sampling
# --------------------------------------------------------------------------------------
def _gamma_table(size: int = 1 << 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), at the middles of ``size`` equal steps."""
    p = (np.arange(size) + 0.5) / size
    lo, hi = np.zeros(size), np.full(size, 40.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return (lo + hi) / 2


_GAMMA = _gamma_table()
_LOG_GAMMA = np.log(_GAMMA)


def samples(h: np.ndarray, weight: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    """(k, texts) sample values; text i has the shingles ``h[start[i] : start[i + 1]]``, at least one."""
    log_w = np.log(weight)
    size = np.diff(np.r_[start, len(h)])
    out = np.zeros((k, len(start)), np.uint64)
    for j in range(k):
        bits = textarrays.mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        r = _GAMMA[(bits & np.uint64(0xFFFF)).astype(np.int64)]
        log_c = _LOG_GAMMA[((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        beta = (bits >> np.uint64(32)).astype(float) / 2.0**32
        t = np.floor(log_w / r + beta)
        log_a = log_c - r * (t - beta) - r
        least = np.flatnonzero(log_a == np.repeat(np.minimum.reduceat(log_a, start), size))
        first = least[np.searchsorted(least, start)]
        out[j] = textarrays.mix(h[first] ^ textarrays.mix(t[first].astype(np.int64).view(np.uint64) + np.uint64(j)))
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) hashes of each band's samples."""
    keys = np.zeros((bands, values.shape[1]), np.uint64)
    for b in range(bands):
        for j in range(rows):
            keys[b] = textarrays.mix(keys[b] * np.uint64(0x9E3779B97F4A7C15) + values[b * rows + j])
    return keys.T


def _packed(h: np.ndarray, times: np.ndarray, dfs: np.ndarray) -> bytes:
    """A multiset: two lengths, then shingles, how often each is there, document frequencies."""
    a, b, c = textarrays.pack_sorted(h), textarrays.pack(times), textarrays.pack(dfs)
    return np.array([len(a), len(b)], "<i8").tobytes() + a + b + c


def _survivors(n_docs: int, least: float, bands: int, rows: int):
    """Of one block: documents with enough shared weight, as multisets of shared shingles with band keys."""

    def run(table: pa.Table) -> pa.Table:
        out = found(table)
        textarrays.give_back()
        return out

    def found(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        home = next(p for p in parts if p["ids"] is not None)
        ids, total = textarrays.unpack(home["ids"]).astype(np.int64), textarrays.unpack(home["totals"]).astype(float)
        doc, times, dfs = (np.concatenate([textarrays.unpack(p[c]) for p in parts]).astype(np.int64) for c in ("docs", "times", "dfs"))
        h = np.concatenate([textarrays.unpack_sorted(p["hashes"]) for p in parts])
        order = np.lexsort((h, doc))  # sums in the same order on every run
        doc, times, dfs, h = (x[order] for x in (doc, times, dfs, h))
        weight = times * idf(dfs, n_docs)
        shared = np.bincount(doc, weight, len(ids))
        alone = total - np.bincount(doc, times, len(ids))
        whole = shared + alone * float(idf(1, n_docs))
        stay = (shared >= (least - _EPS) * whole) & (shared > 0)
        keep = stay[doc]
        doc, h, weight, dfs, times = (x[keep] for x in (doc, h, weight, dfs, times))
        own = np.flatnonzero(stay)
        start = np.searchsorted(doc, own)
        stop = np.r_[start[1:], len(doc)]
        keys = band_keys(samples(h, weight, start, bands * rows), bands, rows).view(np.int64) if len(own) else np.zeros((0, bands), np.int64)
        vectors = [_packed(h[a:b], times[a:b], dfs[a:b]) for a, b in zip(start, stop)]
        # a document with a shingle of its own equals no other
        digests = [hashlib.md5(v + (ids[i].tobytes() if alone[i] else b"")).hexdigest() for v, i in zip(vectors, own)]
        central = np.add.reduceat(dfs * weight, start) / whole[own] if len(own) else np.zeros(0)
        return pa.table({"doc_id": ids[own], "digest": pa.array(digests, pa.string()), "total": whole[own], "central": central, "bands": pa.array(keys.tolist(), pa.list_(pa.int64())), "vector": pa.array(vectors, pa.binary())})

    return run


def shared_vectors(docs: DataFrame, doc_id: str, text: str, n_docs: int, n_bytes: int, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, total, central, bands, vector of the documents that can have links; ``n_bytes`` of all texts set the number of ranges."""
    buckets = max(RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // RANGE_BYTES))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text")).filter("doc_id IS NOT NULL")
    blocks = texts.mapInArrow(_blocks(buckets), _BLOCK)
    answers = blocks.groupBy("bucket").applyInArrow(_frequencies, _ANSWER)
    return answers.groupBy("block").applyInArrow(_survivors(n_docs, least, bands, rows), "doc_id long, digest string, total double, central double, bands array<bigint>, vector binary")


# --------------------------------------------------------------------------------------
# exact similarity
# --------------------------------------------------------------------------------------
def _vector(packed: bytes, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, ascending, and their weights."""
    a, b = np.frombuffer(packed, "<i8", 2).tolist()
    times, dfs = textarrays.unpack(packed[16 + a : 16 + a + b]), textarrays.unpack(packed[16 + a + b :])
    return textarrays.unpack_sorted(packed[16 : 16 + a]), times.astype(float) * idf(dfs, n_docs)


class _Lists:
    """Inverted lists of some nodes, to compare others with all of them."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], totals: np.ndarray):
        h = np.concatenate([v[0] for v in vectors])
        order = np.argsort(h, kind="stable")
        self.h, self.totals = h[order], totals
        self.weight = np.concatenate([v[1] for v in vectors])[order]
        self.node = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])[order]

    def similarities(self, h: np.ndarray, weight: np.ndarray, total: float) -> np.ndarray:
        lo, hi = np.searchsorted(self.h, h, "left"), np.searchsorted(self.h, h, "right")
        at = ragged(lo, hi - lo)
        both = np.bincount(self.node[at], np.minimum(self.weight[at], np.repeat(weight, hi - lo)), len(self.totals))
        return both / (self.totals + total - both)


def _solve(n_docs: int, least: float):
    """Of one candidate component: each node's class, its least node.

    Every node is compared with pivots, the most central first, until it is
    one or is linked to one. Two nodes linked to different pivots can still be
    linked to each other; as one minus the weighted Jaccard similarity is a
    metric, that needs a node x outside the pivot's class within
    2 (1 - least) of the pivot, and a node whose distance from the pivot is at
    least x's less (1 - least). Such nodes become pivots too, until none is
    left. So no link between classes is lost, and nodes deep in a group of
    near copies are never compared with each other.
    """

    def run(table: pa.Table) -> pa.Table:
        node, central = table.column("node").to_numpy(), table.column("central").to_numpy()
        order = np.argsort(node)
        node, central, totals = node[order], central[order], table.column("total").to_numpy()[order]
        packed = table.column("vector").to_pylist()
        vectors = [_vector(packed[i], n_docs) for i in order]
        lists = _Lists(vectors, totals)
        label, pivots = np.arange(len(node)), {}
        free = np.ones(len(node), bool)
        todo = np.lexsort((node, -central)).tolist()
        while todo:
            for i in todo:
                if i in pivots or not free[i]:
                    continue
                pivots[i] = lists.similarities(*vectors[i], totals[i])
                near = np.flatnonzero(pivots[i] >= least - _EPS)
                free[near] = False
                mine = np.unique(label[np.r_[near, i]])
                if len(mine) > 1:
                    label[np.isin(label, mine)] = mine[0]
            again: set[int] = set()
            for i, s in pivots.items():
                outside = s[label != label[i]]
                if outside.size and outside.max() >= 2 * least - 1 - _EPS:
                    again.update(np.flatnonzero((s >= least - _EPS) & ((1 - s) >= (1 - outside.max()) - (1 - least) - _EPS)).tolist())
            todo = sorted(again - set(pivots))
            free[todo] = True
        return pa.table({"node": node, "class_id": node[label]})

    return run


def _compare(n_docs: int, least: float):
    """Some nodes of a component against some of its pivots: links, and near misses that two links could bridge."""
    far = 1 - 2 * (1 - least)

    def run(nodes: pa.Table, pivots: pa.Table) -> pa.Table:
        node, total, packed = nodes.column("node").to_pylist(), nodes.column("total").to_pylist(), nodes.column("vector")
        own = pivots.column("node").to_numpy()
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(own) and node:
            lists = _Lists([_vector(v.as_py(), n_docs) for v in pivots.column("vector")], pivots.column("total").to_numpy())
            for n, t, v in zip(node, total, packed):
                s = lists.similarities(*_vector(v.as_py(), n_docs), t)
                near = np.flatnonzero((s >= far - _EPS) & (own != n))
                out.append((np.full(len(near), n), own[near], s[near]))
        return pa.table({c: np.concatenate([o[k] for o in out]) for k, c in enumerate(("node", "pivot", "similarity"))})

    return run


def _in_parts(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` with a part, so that (component, size, part) has about ``PART_BYTES`` of multisets."""
    each = nodes.groupBy("component", "size").agg(F.ceil(F.sum(F.length("vector")) / PART_BYTES).alias("_n")).select(F.col("component").alias("_c"), F.col("size").alias("_s"), "_n")
    part = F.pmod(F.xxhash64("node"), F.greatest("_n", F.lit(1)))
    return nodes.join(each, (F.col("component") == F.col("_c")) & (F.col("size") == F.col("_s"))).select(*nodes.columns, part.alias(name))


def _pivot_links(nodes: DataFrame, n_docs: int, least: float) -> DataFrame:
    """u, v of links that connect the classes of large components: ``_solve`` in rounds over all their nodes.

    A round opens the most central open nodes of each component as pivots,
    twice as many as the round before, so n nodes that are all unlike take
    about log2(n / ``PIVOTS``) rounds. Nodes and pivots meet in pairs of parts of
    bounded size, only where their total weights allow a similarity that
    counts. Pivots, links and open nodes of a round are tables in the shared
    folder; none of them comes to the driver and no plan grows with the rounds.
    """
    spark = nodes.sparkSession
    reach, far = 1 - least, 1 - 2 * (1 - least)

    def write(df: DataFrame, name: str) -> str:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return path

    def written(df: DataFrame, name: str) -> DataFrame:
        return spark.read.parquet(write(df, name))

    # two multisets are as similar as the smaller total over the larger at most: similar ones are in neighbouring sizes
    size = F.floor(F.log("total") / (-np.log(far) * (1 + 1e-6))) if far > 0 else F.lit(0).cast("long")
    parted = written(_in_parts(nodes.withColumn("size", size), "part"), "near-parts").select("component", "size", "part", "node", "total", "central", "vector")
    parts = written(parted.select("component", "size", "part").distinct(), "near-part-names")
    pair = F.concat_ws("/", "component", "size", "part", "chunk_size", "chunk").alias("pair")

    def compared(chosen: DataFrame) -> DataFrame:
        chunks = _in_parts(chosen.select("component", "size", "node", "total", "vector"), "chunk").withColumnRenamed("size", "chunk_size")
        named = chunks.select("component", "chunk_size", "chunk").distinct()
        pairs = named.select("*", F.explode(F.array(*(F.col("chunk_size") + k for k in (-1, 0, 1)))).alias("size")).join(parts, ["component", "size"])
        left = parted.join(pairs, ["component", "size", "part"]).select(pair, "node", "total", "vector")
        right = chunks.join(pairs, ["component", "chunk_size", "chunk"]).select(pair, "node", "total", "vector")
        return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(_compare(n_docs, least), "node long, pivot long, similarity double")

    state = parted.select("component", "node", "central")
    opened, links_at, pivots_at, per = state, [], [], PIVOTS
    while True:
        rank = F.row_number().over(Window.partitionBy("component").orderBy(F.desc("central"), "node"))
        best = opened.withColumn("k", rank).filter(F.col("k") <= per).select(F.col("node").alias("_n"))
        at = write(parted.join(best, F.col("node") == F.col("_n"), "left_semi").select("component", "size", "node", "total", "vector"), "near-pivots")
        chosen = spark.read.parquet(at)
        if not chosen.isEmpty():
            pivots_at.append(at)
            links_at.append(write(compared(chosen), "near-links"))
            linked = spark.read.parquet(links_at[-1]).filter(F.col("similarity") >= least - _EPS).select("node").unionByName(chosen.select("node")).select(F.col("node").alias("_d"))
            opened = written(opened.join(linked, F.col("node") == F.col("_d"), "left_anti"), "near-open")
            per *= 2
            continue
        # every node is settled; look for pairs of classes that a link could still join
        found, tried = spark.read.parquet(*links_at), spark.read.parquet(*pivots_at)
        links = found.filter(F.col("similarity") >= least - _EPS)
        label = connected_components(links.select(F.col("node").alias("u"), F.col("pivot").alias("v")))
        a = label.select(F.col("node").alias("_x"), F.col("component").alias("cx"))
        b = label.select(F.col("node").alias("_p"), F.col("component").alias("cp"))
        labelled = found.join(a, F.col("node") == F.col("_x"), "left").join(b, F.col("pivot") == F.col("_p"), "left")
        apart = F.coalesce("cx", "node") != F.coalesce("cp", "pivot")
        nearest = labelled.filter(apart).groupBy("pivot").agg(F.max("similarity").alias("s")).select(F.col("pivot").alias("_q"), "s")
        more = links.join(nearest, F.col("pivot") == F.col("_q")).filter((1 - F.col("similarity")) >= (1 - F.col("s")) - reach - _EPS).select(F.col("node").alias("_m")).distinct()
        fresh = state.join(more, F.col("node") == F.col("_m"), "left_semi")
        opened = written(fresh.join(tried.select(F.col("node").alias("_t")), F.col("node") == F.col("_t"), "left_anti"), "near-open")
        if opened.isEmpty():
            return links.select(F.col("node").alias("u"), F.col("pivot").alias("v"))


# --------------------------------------------------------------------------------------
# classes
# --------------------------------------------------------------------------------------
def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, task_nodes: int = TASK_NODES) -> DataFrame:
    """doc_id, class_id of the documents that are in a class with another one; class_id is the least id of the class.

    A text of 1 to 4 words is one shingle of all its words; texts without words
    and rows without an id are in no class. Rows that share an id are one
    document, in the least class of their texts. An empty table gives no rows.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    n_docs, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text)))).first()
    vectors = written(shared_vectors(docs, doc_id, text, n_docs, n_bytes or 0, least, bands, rows), "near-vectors")
    # equal multisets are one node, named by its least document
    alike = vectors.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first(F.struct("total", "central", "bands", "vector")).alias("x"))
    chosen = written(alike.select("digest", "node", "x.*"), "near-nodes")
    # ties of nodes that agree in a band
    keys = chosen.select("node", F.posexplode("bands").alias("band", "key"))
    star = keys.groupBy("band", "key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").select(F.col("band").alias("_b"), F.col("key").alias("_k"), "least")
    ties = keys.join(star, (F.col("band") == F.col("_b")) & (F.col("key") == F.col("_k"))).filter("node != least")
    tied = written(connected_components(ties.select(F.col("node").alias("u"), F.col("least").alias("v"))), "near-components").select(F.col("node").alias("_n"), "component")
    nodes = written(chosen.drop("bands").join(tied, F.col("node") == F.col("_n")).drop("_n"), "near-tied")
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("vector")).alias("b"))
    large = written(sizes.filter((F.col("n") > task_nodes) | (F.col("b") > TASK_BYTES)).select(F.col("component").alias("_c")), "near-large")
    in_large = F.col("component") == F.col("_c")
    small = nodes.join(large, in_large, "left_anti").select("component", "node", "total", "central", "vector")
    classes = small.groupBy("component").applyInArrow(_solve(n_docs, least), "node long, class_id long")
    if not large.isEmpty():
        crowded = written(nodes.join(large, in_large, "left_semi"), "near-crowded")
        joined = connected_components(_pivot_links(crowded, n_docs, least))
        classes = classes.unionByName(joined.select("node", F.col("component").alias("class_id")))
    named = written(classes.filter("node != class_id"), "near-classes").select(F.col("node").alias("_n"), "class_id")
    by_digest = chosen.select("digest", "node").join(named, F.col("node") == F.col("_n"), "left").select(F.col("digest").alias("_d"), F.coalesce("class_id", "node").alias("class_id"))
    every = vectors.select("doc_id", "digest").join(by_digest, F.col("digest") == F.col("_d")).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    every = written(every, "near-members")
    crowd = every.filter("doc_id != class_id").select(F.col("class_id").alias("_c")).distinct()
    return every.join(crowd, F.col("class_id") == F.col("_c"), "left_semi")


def with_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id, class_id of every row: its class, or itself where it has no near duplicate."""
    found = near_duplicate_classes(docs, doc_id, text, **how).select(F.col("doc_id").alias("_d"), "class_id")
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    return ids.join(found, F.col("doc_id") == F.col("_d"), "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that are in another's class; the class's least id stays. Columns as they were."""
    found = near_duplicate_classes(docs, doc_id, text, **how)
    gone = found.filter("doc_id != class_id").select(F.col("doc_id").alias("_gone"))
    packed = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"))
    return packed.join(gone, F.col("id") == F.col("_gone"), "left_anti").select("row.*")
