"""random forests of regression trees grown to purity, without a depth limit.

Every tree has its own Poisson(1) weights for the rows, a hash of seed, tree,
the row's values and its number among equal rows, so the partitioning doesn't
matter. Every split is the best of all midpoints of neighbouring values of the
node's rows: least squared error, ties to the first feature and the lowest cut.
A node of up to ``node_rows`` rows goes to one task, which grows the subtree
below it (``grow``), so a table of that size is a task a tree. A larger node is
split over the whole table, to the same split: tasks add up weights and sums of
the label by feature and value, one pass a level for a group of trees. A
feature of more than ``MAX_VALUES`` values is cut into ranges (some rows of
``RANGE_ROWS`` each, dealt once) and the pass adds up by range; then every
range's rows are gone through in order, from the sums of the ranges before.

A row goes to every tree that drew it, so rows travel packed: those of a block
that go to one subtree are one value, and Spark moves blocks x subtrees, not
rows x trees.

Trees grown to purity have about as many nodes as rows, so a forest is a table
of packed nodes in the shared folder. Up to ``MAX_BROADCAST_NODES`` nodes
(counted) it goes to the tasks that predict; a larger one is met subtree by
subtree, and only a subtree that more than ``PART_ROWS`` rows reach is copied.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import scratch_path

#: Rows of a node that one task takes over.
NODE_ROWS = 250_000
#: Values of a feature that sums over the table are kept for one by one; rows (expected) in a range of a feature with more.
MAX_VALUES, RANGE_ROWS = 2048, 250_000
#: Rows (a node and range) that the driver gathers at once.
RANGE_CUTS = 200_000
#: Nodes of a forest that is sent to the tasks whole (about 30 bytes a node).
MAX_BROADCAST_NODES = 2_000_000
#: Bytes of the sums that a task holds while nodes are split over the table.
SUM_BYTES = 64 << 20
#: Rows that are packed by subtree at once, bytes of them that a task sends at once, nodes in a row of the table of nodes.
BLOCK_ROWS, SEND_BYTES, NODE_SLICE = 1 << 14, 16 << 20, 1 << 15
#: Rows that a task compares with one subtree (expected), and rows x trees that a task gets.
PART_ROWS, TASK_ROWS = 2 * NODE_ROWS, 2_000_000
#: Splits whose scores are this close (relative) are equally good.
TIE = 1e-9
SLICE = 4096
_PARTS = ("feature", "threshold", "left", "right", "value")


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finalizer)."""
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return h ^ (h >> np.uint64(31))


#: Borders of the Poisson(1) counts, and the count for the first 16 bits of a draw where these tell it (else 255).
_CDF = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 20)]))
_COUNTS = np.searchsorted(_CDF, np.arange(1 << 16) / (1 << 16), side="right").astype(np.uint8)
_COUNTS[_COUNTS != np.searchsorted(_CDF, (np.arange(1, (1 << 16) + 1) - 2.0**-37) / (1 << 16), side="right")] = 255


def poisson_weights(keys: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """Rows x trees Poisson(1) weights from a hash of (seed, tree, row)."""
    salts = ((seed * 1_000_003 + trees.astype(object)) * 0x9E3779B97F4A7C15 % (1 << 64)).astype(np.uint64)
    mixed, out = _mix(keys.view(np.uint64)), np.empty((len(trees), len(keys)))
    for k, salt in enumerate(salts):  # a tree at a time, which the processor's cache holds
        h = _mix(mixed ^ salt)
        w = _COUNTS[h >> np.uint64(48)]
        odd = np.flatnonzero(w == 255)
        w[odd] = np.searchsorted(_CDF, (h[odd] >> np.uint64(11)).astype(np.float64) / float(1 << 53), side="right")
        out[k] = w
    return out.T


def grow(X: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int | None = None, min_split: int = 2, min_leaf: int = 1, base: float | None = None) -> dict[str, np.ndarray]:
    """One regression tree as arrays (feature -1 at leaves; rows with x <= threshold go left), all nodes of a level at once.

    Rows are kept sorted by (node, value) for every feature, so a place in any
    of the orders belongs to the same node. Each level takes running sums along
    the orders, the best cut of each node, and deals the rows on; rows of
    finished nodes are left out. ``min_split`` and ``min_leaf`` count rows,
    whatever their weights. Labels are added up less ``base``, about their mean.
    """
    n, p = X.shape
    base = float(np.round(np.average(y, weights=w))) if base is None else base  # keeps sums small; whole labels stay whole
    z = w + 1j * (w * (y - base))  # both are added up at once
    cols = np.ascontiguousarray(X.T)
    orders = [np.argsort(c, kind="stable").astype(np.int32) for c in cols]
    right = np.zeros(n, bool)
    out: dict[str, list[np.ndarray]] = {k: [] for k in (*_PARTS, "rows", "gain")}
    first, depth, count = 0, 0, np.array([n])
    while len(count):
        k = len(count)
        starts = np.cumsum(count) - count
        rows = orders[0]
        sums = np.add.reduceat(z[rows], starts)
        W, S, label = sums.real, sums.imag, y[rows]
        can = (np.maximum.reduceat(label, starts) > np.minimum.reduceat(label, starts)) & (count >= max(min_split, 2 * min_leaf, 2)) & (max_depth is None or depth < max_depth)
        best, feature, cut = np.full(k, -np.inf), np.full(k, -1), np.zeros(k)
        if can.any():
            orders, own, nd = _kept(orders, count, can)
            begin = np.cumsum(count[own]) - count[own]
            inner = np.ones(len(nd) - 1, bool)  # places with a place of the same node after them
            inner[begin[1:] - 1] = False
            if min_leaf > 1:
                place = np.arange(1, len(nd)) - begin[nd[:-1]]
                inner &= (place >= min_leaf) & (count[own][nd[:-1]] - place >= min_leaf)
            for j in range(p):
                x = cols[j][orders[j]]
                some = np.flatnonzero((x[1:] > x[:-1]) & inner)
                if not some.size:
                    continue
                run = np.cumsum(z[orders[j]])
                at = nd[some]
                left = run[some] - np.r_[0.0, run[begin[1:] - 1]][at]
                node = own[at]
                wl, sl = left.real, left.imag
                score = sl**2 / wl + (S[node] - sl) ** 2 / (W[node] - wl)
                lead = _leads(at)
                top = np.maximum.reduceat(score, lead)
                hit = np.flatnonzero(score >= np.repeat(top - TIE * np.abs(top), np.diff(np.r_[lead, len(at)])))
                i, nodes = some[hit[_leads(at[hit])]], node[lead]
                better = top > best[nodes] * (1 + TIE)
                i, nodes, top = i[better], nodes[better], top[better]
                middle = x[i] + (x[i + 1] - x[i]) / 2
                best[nodes], feature[nodes], cut[nodes] = top, j, np.where(middle >= x[i + 1], x[i], middle)
        split = feature >= 0
        child = first + k + 2 * (np.cumsum(split) - 1)
        for key, v in (("feature", feature), ("threshold", cut), ("left", np.where(split, child, -1)), ("right", np.where(split, child + 1, -1)), ("value", base + S / W), ("rows", count), ("gain", np.where(split, best - S * S / W, 0.0))):
            out[key].append(v)
        first, depth = first + k, depth + 1
        if not split.any():
            break
        orders, own, nd = _kept(orders, np.where(can, count, 0), split)
        rows = orders[0]
        right[rows] = cols[feature[own][nd], rows] > cut[own][nd]
        over = np.bincount(nd, right[rows], len(own)).astype(np.int64)
        count = np.c_[count[own] - over, over].ravel()
        low = np.repeat(np.arange(len(count)) % 2 == 0, count)  # the places of rows that go left
        for j in range(p):
            o, dealt = orders[j], np.empty_like(orders[j])
            goes = right[o]
            dealt[low], dealt[~low] = o[~goes], o[goes]
            orders[j] = dealt
    return {key: np.concatenate(v) for key, v in out.items()}


def _kept(orders: list[np.ndarray], count: np.ndarray, which: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The orders with the rows of some nodes only, those nodes, and for each place the number of its node among them."""
    own = np.flatnonzero(which)
    if not which[count > 0].all():
        keep = np.repeat(which, count)
        orders = [o[keep] for o in orders]
    return orders, own, np.repeat(np.arange(len(own)), count[own])


def _leads(at: np.ndarray) -> np.ndarray:
    """Places where a number differs from the one before."""
    return np.flatnonzero(np.r_[True, at[1:] != at[:-1]])


def leaves(tree: dict[str, np.ndarray], X: np.ndarray) -> np.ndarray:
    """Node of the tree where each row ends."""
    at = np.zeros(len(X), np.int64)
    going = np.flatnonzero(tree["feature"][at] >= 0)
    while going.size:
        own = at[going]
        at[going] = np.where(X[going, tree["feature"][own]] <= tree["threshold"][own], tree["left"][own], tree["right"][own])
        going = going[tree["feature"][at[going]] >= 0]
    return at


class _Top:
    """The part of one tree that is split over the table; ``open`` nodes have more rows than a task takes."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value, self.gain, self.depth = [-1], [0.0], [-1], [-1], [math.nan], [0.0], [0]
        self.closed: set[int] = set()  # leaves with a value of their own

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(getattr(self, k)) for k in _PARTS}

    def split(self, i: int, j: int, cut: float, gain: float) -> tuple[int, int]:
        a = len(self.feature)
        for _ in range(2):
            for k, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", math.nan), ("gain", 0.0), ("depth", self.depth[i] + 1)):
                getattr(self, k).append(v)
        self.feature[i], self.threshold[i], self.left[i], self.right[i], self.gain[i] = j, cut, a, a + 1, gain
        return a, a + 1


@dataclass
class ForestModel:
    """A grown forest: the shared tops of its trees and the path of the table of their subtrees' nodes."""

    features: list[str]
    tops: list[dict]
    path: str
    n_nodes: int
    importances: list[float]

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(self.importances)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.read.parquet(self.path).write.mode("overwrite").parquet(f"{path}/nodes")
        state = {"features": self.features, "tops": [{k: v.tolist() for k, v in t.items()} for t in self.tops], "n_nodes": self.n_nodes, "importances": self.importances}
        spark.createDataFrame([(json.dumps(state),)], "forest string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        state = json.loads(spark.read.text(f"{path}/forest").first()[0])
        return ForestModel(state["features"], [{k: np.array(v) for k, v in t.items()} for t in state["tops"]], f"{path}/nodes", state["n_nodes"], state["importances"])

    def trees(self, spark: SparkSession) -> list[dict[int, dict[str, np.ndarray]]]:
        """For each tree its subtrees by the top node they hang from; for forests of a checked size."""
        nodes = spark.read.parquet(self.path).toPandas()
        out: list[dict[int, dict[str, np.ndarray]]] = [{} for _ in self.tops]
        for (t, root), part in nodes.groupby(["tree", "root"]):
            out[t][root] = _tree(part)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction``, the mean of the trees; null where a feature is null or NaN."""
        features, tops = self.features, self.tops
        schema = StructType([f for f in df.schema.fields] + [StructField("prediction", DoubleType())])
        if self.n_nodes > MAX_BROADCAST_NODES:
            return self._by_subtree(df)
        trees = df.sparkSession.sparkContext.broadcast(self.trees(df.sparkSession))

        def score(batches):
            for pdf in batches:
                X = pdf[features].to_numpy(np.float64)
                total = np.zeros(len(X))
                whole = ~np.isnan(X).any(axis=1)
                for top, subtrees in zip(tops, trees.value):
                    total[whole] += _predicted(top, subtrees, X[whole])
                pdf = pdf.copy()
                pdf["prediction"] = np.where(whole, total / len(tops), np.nan)
                yield pdf

        out = df.mapInPandas(score, schema)
        return out.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))

    def _by_subtree(self, df: DataFrame) -> DataFrame:
        """Rows go to the subtrees they reach, a block of rows and a subtree to a task; leaf values are averaged by row."""
        spark, features, tops = df.sparkSession, self.features, self.tops
        path = scratch_path(spark, "forest-rows")
        df.repartition(_files(spark)).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)
        n, p = rows.count(), len(features)
        plain = rows.select("_row", *[F.col(c).cast("double").alias(c) for c in features]).dropna()
        parts = self._parts(plain) if n > PART_ROWS else {}

        def reach(batches):
            for pdf in _gathered(batches, BLOCK_ROWS):
                X, own = pdf[features].to_numpy(np.float64), pdf["_row"].to_numpy(np.int64)
                packed, every = np.c_[own, X.view(np.int64)], np.arange(len(X))
                block = int(own[0])
                turn = int(_mix(own[:1].view(np.uint64))[0] >> np.uint64(1))
                sent = ((t, root, packed[at]) for t, top in enumerate(tops) for root, at in _by_root(leaves(top, X), every))
                for made in _sent(sent):
                    yield made.assign(part=[turn % parts.get(x, 1) for x in zip(made["tree"], made["root"])], block=block)

        plan = spark.createDataFrame([(t, root, k) for (t, root), k in parts.items()], "tree int, root long, _k int")  # subtrees that many rows reach
        upto = F.sequence(F.lit(0), F.coalesce(F.col("_k"), F.lit(1)) - 1)
        nodes = spark.read.parquet(self.path).drop("gains").join(F.broadcast(plan), ["tree", "root"], "left").withColumn("part", F.explode(upto)).drop("_k")
        tasks = _tasks(spark, n * len(tops))
        keys = ["tree", "root", "part"]
        sent = plain.mapInPandas(reach, "tree int, root long, rows binary, part int, block long").repartition(tasks, *keys)

        def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if a.empty:
                return pd.DataFrame({"block": [], "tree": [], "root": [], "rows": [], "v": []})
            t, root = int(a["tree"].iloc[0]), int(a["root"].iloc[0])
            given = np.frombuffer(b"".join(a["rows"]), np.int64).reshape(-1, p + 1)
            X = np.ascontiguousarray(given[:, 1:]).view(np.float64)
            v = _predicted_in(_tree(b), X) if len(b) else np.full(len(X), tops[t]["value"][root])
            cuts = np.cumsum([len(r) // (8 * (p + 1)) for r in a["rows"]])[:-1]
            return pd.DataFrame({"block": a["block"], "tree": a["tree"], "root": a["root"], "rows": [r.tobytes() for r in np.split(given[:, 0], cuts)], "v": [x.tobytes() for x in np.split(v, cuts)]})

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["tree", "root"])
            own, at = np.unique(np.frombuffer(b"".join(pdf["rows"]), np.int64), return_inverse=True)
            return pd.DataFrame({"_row": own, "prediction": np.bincount(at, np.frombuffer(b"".join(pdf["v"]))) / len(tops)})

        found = sent.groupBy(*keys).cogroup(nodes.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(score, "block long, tree int, root long, rows binary, v binary")
        return rows.join(found.groupBy("block").applyInPandas(average, "_row long, prediction double"), "_row", "left").drop("_row")

    def _parts(self, plain: DataFrame) -> dict[tuple[int, int], int]:
        """Parts of the subtrees that more than ``PART_ROWS`` rows reach."""
        features, tops = self.features, self.tops

        def count(batches):
            seen = [np.zeros(len(top["feature"]), np.int64) for top in tops]
            for pdf in batches:
                X = pdf[features].to_numpy(np.float64)
                for t, top in enumerate(tops):
                    seen[t] += np.bincount(leaves(top, X), minlength=len(seen[t]))
            for t, c in enumerate(seen):
                root = np.flatnonzero(c)
                yield pd.DataFrame({"tree": np.full(len(root), t, np.int32), "root": root, "n": c[root]})

        seen = plain.mapInPandas(count, "tree int, root long, n long").groupBy("tree", "root").agg(F.sum("n").alias("n")).where(F.col("n") > PART_ROWS)
        return {(r["tree"], r["root"]): math.ceil(r["n"] / PART_ROWS) for r in seen.collect()}  # a row a subtree at most


def _tasks(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), math.ceil(rows / TASK_ROWS))


def _files(spark: SparkSession) -> int:
    """Files of a table that every task reads a part of: a small table is much work here."""
    return 3 * spark.sparkContext.defaultParallelism


def _gathered(batches, rows: int):
    """Frames of at least ``rows`` rows (the last: fewer) from smaller ones."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def _by_root(root: np.ndarray, rows: np.ndarray):
    """(root, its rows), for every root that occurs."""
    order = np.argsort(root, kind="stable")
    ends = np.flatnonzero(np.diff(root[order])) + 1
    return [(int(root[own[0]]), rows[own]) for own in np.split(order, ends) if own.size]


def _sent(packed):
    """Frames of (tree, root, rows) of about ``SEND_BYTES`` bytes."""
    held, size = [], 0
    for t, root, values in packed:
        held.append((t, root, values.tobytes()))
        size += len(held[-1][2])
        if size >= SEND_BYTES:
            yield pd.DataFrame(held, columns=["tree", "root", "rows"])
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=["tree", "root", "rows"])


_KINDS = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "right": np.int32, "value": np.float64}


def _tree(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    nodes = nodes.sort_values("first")
    return {k: np.frombuffer(b"".join(nodes[k]), kind) for k, kind in _KINDS.items()}


def _predicted_in(tree: dict[str, np.ndarray], X: np.ndarray) -> np.ndarray:
    return tree["value"][leaves(tree, X)]


def _predicted(top: dict, subtrees: dict[int, dict], X: np.ndarray) -> np.ndarray:
    root = leaves(top, X)
    out = top["value"][root].astype(np.float64)
    for r in np.unique(root).tolist():
        if r in subtrees:
            own = root == r
            out[own] = _predicted_in(subtrees[r], X[own])
    return out


def _values(rows: DataFrame, features: list[str]) -> list[np.ndarray | None]:
    """Every feature's values in order, or None where there are more than ``MAX_VALUES``."""

    def told(batches):
        seen: list[np.ndarray | None] = [np.zeros(0) for _ in features]
        for pdf in batches:
            for j, c in enumerate(features):
                if seen[j] is not None:
                    v = np.union1d(seen[j], pdf[c].to_numpy(np.float64))
                    seen[j] = v if len(v) <= MAX_VALUES else None
        yield pd.DataFrame({"feature": range(len(features)), "v": [None if v is None else v.tobytes() for v in seen]})

    out: list[np.ndarray | None] = [np.zeros(0) for _ in features]
    for r in rows.mapInPandas(told, "feature int, v binary").toLocalIterator():  # a row a task and feature
        j = r["feature"]
        if out[j] is not None:
            v = None if r["v"] is None else np.union1d(out[j], np.frombuffer(r["v"]))
            out[j] = v if v is not None and len(v) <= MAX_VALUES else None
    return out


def _bins(x: np.ndarray, key: np.ndarray, values: np.ndarray | None, edges: list[float] | None) -> np.ndarray:
    """Number of each row's value, or of its range: a value that is several edges is dealt over the ranges they enclose."""
    if values is not None:
        return np.searchsorted(values, x)
    lo, hi = np.searchsorted(edges, x, "left"), np.searchsorted(edges, x, "right")
    return lo + (_mix(key.view(np.uint64)) % (hi - lo + 1).astype(np.uint64)).astype(np.int64)


def _middle(a, b):
    """Cut between two neighbouring values, as in ``grow``."""
    m = a + (b - a) / 2
    return np.where(m >= b, a, m)


def _first_best(score: np.ndarray) -> int:
    """The first of the best scores, but for ``TIE``."""
    top = score.max()
    return int(np.argmax(score >= top - TIE * abs(top))) if np.isfinite(top) else 0


def _scores(wl, sl, W, S):
    with np.errstate(divide="ignore", invalid="ignore"):
        return sl**2 / wl + (S - sl) ** 2 / (W - wl)


def _weights(key: np.ndarray, t: int, seed: int, bootstrap: bool) -> np.ndarray:
    return poisson_weights(key, np.array([t]), seed)[:, 0] if bootstrap else np.ones(len(key))


class _Table:
    """The rows of a forest whose largest nodes are split over the whole table."""

    def __init__(self, rows: DataFrame, features: list[str], n: int, base: float, seed: int, bootstrap: bool, min_leaf: int):
        self.rows, self.features, self.base, self.seed, self.bootstrap, self.min_leaf = rows, features, base, seed, bootstrap, min_leaf
        self.values = _values(rows, features)
        self.wide = [j for j, v in enumerate(self.values) if v is None]
        self.edges: dict[int, list[float]] = {}
        ranges = max(2, math.ceil(n / RANGE_ROWS))
        if self.wide:
            cuts = rows.approxQuantile([features[j] for j in self.wide], [k / ranges for k in range(1, ranges)], 0.1 / ranges)
            self.edges = dict(zip(self.wide, cuts))
        self.width = [ranges if v is None else len(v) for v in self.values]
        self.path = self._dealt() if self.wide else None
        self.tasks = _tasks(rows.sparkSession, n * len(self.wide))

    def _dealt(self) -> str:
        """The rows of every range of every feature of many values, in the shared folder."""
        features, wide, edges, names = self.features, self.wide, self.edges, [*self.features, "_y"]

        def deal(batches):
            for pdf in _gathered(batches, BLOCK_ROWS):
                X, key = pdf[features].to_numpy(np.float64), pdf["_key"].to_numpy(np.int64)
                packed, every = np.c_[pdf[names].to_numpy(np.float64).view(np.int64), key], np.arange(len(X))
                yield from _sent((j, r, packed[at]) for j in wide for r, at in _by_root(_bins(X[:, j], key, None, edges[j]), every))

        path = scratch_path(self.rows.sparkSession, "forest-ranges")
        self.rows.mapInPandas(deal, "tree int, root long, rows binary").write.option("compression", "zstd").parquet(path)
        return path

    def at_once(self) -> int:
        """Nodes whose sums a task holds within ``SUM_BYTES``, and whose ranges' best cuts the driver gathers within ``RANGE_CUTS`` rows."""
        ranges = sum(self.width[j] for j in self.wide)
        return max(1, min(SUM_BYTES // (sum(self.width) * 24), RANGE_CUTS // ranges if ranges else SUM_BYTES))

    def split(self, tops: list[_Top], want: list[tuple[int, int]]):
        """For each node wanted (tree, node): weight, sum of the label less ``base``, rows, least and largest label, and every feature's best (score, cut, rows on the left)."""
        arrays = {t: tops[t].arrays() for t, _ in want}
        slots: dict[int, list[int]] = {}
        for t, node in want:
            slots.setdefault(t, []).append(node)
        first = dict(zip(slots, np.cumsum([0, *map(len, slots.values())]).tolist()))
        number = {(t, node): first[t] + k for t, nodes in slots.items() for k, node in enumerate(nodes)}
        own_slot = {t: np.full(len(arrays[t]["feature"]), -1) for t in slots}
        for t, nodes in slots.items():
            own_slot[t][nodes] = np.arange(len(nodes))
        features, width, values, edges, base, weights, min_leaf = self.features, self.width, self.values, self.edges, self.base, partial(_weights, seed=self.seed, bootstrap=self.bootstrap), self.min_leaf
        p, total = len(features), len(want)

        def sums(batches):
            acc = [np.zeros((total, m, 3)) for m in width]
            ends = np.tile([np.inf, -np.inf], (total, 1))
            for pdf in _gathered(batches, BLOCK_ROWS):
                X, y, key = pdf[features].to_numpy(np.float64), pdf["_y"].to_numpy(np.float64), pdf["_key"].to_numpy(np.int64)
                bins = [_bins(X[:, j], key, values[j], edges.get(j)) for j in range(p)]
                for t, nodes in slots.items():
                    w = weights(key, t)
                    own = np.flatnonzero(w > 0)
                    at = own_slot[t][leaves(arrays[t], X[own])]
                    own, at = own[at >= 0], at[at >= 0]
                    w, label, a, k = w[own], y[own], first[t], len(nodes)
                    np.minimum.at(ends[a : a + k, 0], at, label)
                    np.maximum.at(ends[a : a + k, 1], at, label)
                    for j, m in enumerate(width):
                        b = at * m + bins[j][own]
                        for i, v in enumerate((w, w * (label - base), None)):
                            acc[j][a : a + k, :, i] += np.bincount(b, v, k * m).reshape(k, m)
            for j in range(p):
                yield pd.DataFrame({"slot": np.arange(total, dtype=np.int32), "feature": np.int32(j), "lo": ends[:, 0], "hi": ends[:, 1], "part": np.int32(np.random.randint(32)), "sums": [x.tobytes() for x in acc[j]]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            made = sum(np.frombuffer(b) for b in pdf["sums"])
            return pd.DataFrame({"slot": pdf["slot"][:1], "feature": pdf["feature"][:1], "lo": [pdf["lo"].min()], "hi": [pdf["hi"].max()], "part": [0], "sums": [made.tobytes()]})

        def best(pdf: pd.DataFrame) -> pd.DataFrame:
            one = add(pdf)
            j, given = int(one["feature"].iloc[0]), one["sums"].iloc[0]
            told = np.frombuffer(given).reshape(-1, 3)
            W, S, C = told.sum(0)
            made = {"slot": one["slot"], "feature": [j], "lo": one["lo"], "hi": one["hi"], "w": [W], "s": [S], "c": [C], "score": [-np.inf], "cut": [0.0], "left": [0.0], "sums": [given if values[j] is None else None]}
            some = np.flatnonzero(told[:, 2])
            if values[j] is not None and len(some) > 1:
                run = np.cumsum(told[some], 0)[:-1]
                ok = (run[:, 2] >= min_leaf) & (C - run[:, 2] >= min_leaf)
                if ok.any():
                    score = np.where(ok, _scores(run[:, 0], run[:, 1], W, S), -np.inf)
                    k = _first_best(score)
                    made.update(score=[score[k]], cut=[float(_middle(values[j][some[k]], values[j][some[k + 1]]))], left=[run[k, 2]])
            return pd.DataFrame(made)

        kind = "slot int, feature int, lo double, hi double, part int, sums binary"
        parts = self.rows.mapInPandas(sums, kind).groupBy("slot", "feature", "part").applyInPandas(add, kind)
        told = parts.groupBy("slot", "feature").applyInPandas(best, "slot int, feature int, lo double, hi double, w double, s double, c double, score double, cut double, left double, sums binary").toPandas()  # a row a node and feature
        found = {(r.slot, r.feature): (r.score, r.cut, r.left) for r in told.itertuples()}
        if self.wide:
            found |= self._in_ranges(arrays, slots, first, own_slot, told)
        nodes = {r.slot: (r.w, r.s, r.c, r.lo, r.hi) for r in told.itertuples()}
        return {x: (*nodes[i], [found[i, j] for j in range(p)]) for x, i in number.items()}

    def _in_ranges(self, arrays: dict, slots: dict, first: dict, own_slot: dict, told: pd.DataFrame) -> dict:
        """The best cuts of features of many values: each range's rows in order, from the sums of the ranges before."""
        p, base, weights, min_leaf, wide = len(self.features), self.base, partial(_weights, seed=self.seed, bootstrap=self.bootstrap), self.min_leaf, self.wide
        total = sum(map(len, slots.values()))
        before = {j: np.zeros((total, self.width[j], 3)) for j in wide}
        whole = np.zeros((total, 3))
        for r in told.itertuples():
            if r.feature in before:
                made = np.frombuffer(r.sums).reshape(-1, 3)
                before[r.feature][r.slot] = np.cumsum(made, 0) - made
                whole[r.slot] = made.sum(0)
        offsets = self.rows.sparkSession.sparkContext.broadcast(before)

        def cuts(pdf: pd.DataFrame) -> pd.DataFrame:
            j, part = int(pdf["tree"].iloc[0]), int(pdf["root"].iloc[0])
            given = np.frombuffer(b"".join(pdf["rows"]), np.int64).reshape(-1, p + 2)
            given = given[np.argsort(np.ascontiguousarray(given[:, j]).view(np.float64), kind="stable")]
            M, key = np.ascontiguousarray(given[:, :-1]).view(np.float64), np.ascontiguousarray(given[:, -1])
            out = []
            for t, nodes in slots.items():
                w = weights(key, t)
                own = np.flatnonzero(w > 0)
                at = own_slot[t][leaves(arrays[t], M[own, :-1])]
                for k, rows in _by_root(at, own):
                    if k < 0:
                        continue
                    slot = first[t] + k
                    W0, S0, C0 = offsets.value[j][slot, part]
                    W, S, C = whole[slot]
                    x, v = M[rows, j], w[rows]
                    made = [slot, j, part, x[0], x[-1], -np.inf, C0, -np.inf, 0.0, 0.0]
                    if C0 >= min_leaf and C - C0 >= min_leaf:
                        made[5] = float(_scores(W0, S0, W, S))
                    left = C0 + np.arange(1, len(rows))
                    ok = np.flatnonzero((x[1:] > x[:-1]) & (left >= min_leaf) & (C - left >= min_leaf))
                    if ok.size:
                        score = _scores(W0 + np.cumsum(v)[ok], S0 + np.cumsum(v * (M[rows, -1] - base))[ok], W, S)
                        i = _first_best(score)
                        a = ok[i]
                        made[7:] = [score[i], float(_middle(x[a], x[a + 1])), left[a]]
                    out.append(made)
            return pd.DataFrame(out, columns=["slot", "feature", "part", "lo", "hi", "edge", "below", "score", "cut", "left"])

        spark = self.rows.sparkSession
        dealt = spark.read.parquet(self.path).repartition(self.tasks, "tree", "root").groupBy("tree", "root")
        seen = dealt.applyInPandas(cuts, "slot int, feature int, part int, lo double, hi double, edge double, below double, score double, cut double, left double").toPandas()  # a row a node, feature and range
        offsets.destroy()
        found = {(i, j): (-np.inf, 0.0, 0.0) for i in range(total) for j in wide}
        for x, parts in seen.sort_values("part").groupby(["slot", "feature"]):
            last, some = None, []
            for r in parts.itertuples():
                if last is not None and last < r.lo and np.isfinite(r.edge):  # between this range and the last one with rows
                    some.append((r.edge, float(_middle(last, r.lo)), r.below))
                if np.isfinite(r.score):
                    some.append((r.score, r.cut, r.left))
                last = r.hi
            if some:
                found[x] = some[_first_best(np.array([c[0] for c in some]))]
        return found


def train_forest(df: DataFrame, features: list[str], label: str, n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1, random_state: int = 42, bootstrap: bool = True, node_rows: int | None = None) -> ForestModel:
    """a forest on the complete rows of ``df``; defaults are those of the reference (100 trees, no depth limit)."""
    if n_estimators < 1 or min_samples_split < 2 or min_samples_leaf < 1:
        raise ValueError("a forest has a tree, a split two rows and a leaf one row at least")
    spark, p, most = df.sparkSession, len(features), node_rows or NODE_ROWS
    plain = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y")).dropna()
    names = [*features, "_y"]
    each = plain.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))  # equal rows get numbers of their own
    slices = each.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(SLICE).cast("long"))))
    numbered = slices.withColumn("_number", F.explode(F.sequence(F.col("_first"), F.least(F.col("_first") + (SLICE - 1), F.col("_n") - 1))))
    path = scratch_path(spark, "forest-train")
    numbered.select(*names, F.xxhash64(*names, "_number").alias("_key")).repartition(_files(spark), "_key").write.parquet(path)
    rows = spark.read.parquet(path)
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("_y")).first()
    if not n:
        raise ValueError("no complete row to grow a tree from")
    base = float(np.round(mean))  # one for all nodes, wherever they are split
    tops = [_Top() for _ in range(n_estimators)]
    wanted = [(t, 0) for t in range(n_estimators)] if n > most else []
    table = _Table(rows, features, n, base, random_state, bootstrap, min_samples_leaf) if wanted else None
    at_once = table.at_once() if table else 1
    while wanted:
        later = []
        for k in range(0, len(wanted), at_once):
            for (t, i), (w, total, c, lo, hi, found) in table.split(tops, wanted[k : k + at_once]).items():
                top = tops[t]
                top.value[i] = base + total / w if w else base
                best = (-np.inf, 0.0, 0.0)
                feature = -1
                for j, one in enumerate(found):
                    if one[0] > best[0] * (1 + TIE):
                        best, feature = one, j
                if feature < 0 or hi <= lo or max_depth is not None and top.depth[i] >= max_depth or c < max(min_samples_split, 2 * min_samples_leaf):
                    top.closed.add(i)
                    continue
                a, b = top.split(i, feature, float(best[1]), float(best[0] - total * total / w))
                later += [(t, x) for x, own in ((a, best[2]), (b, c - best[2])) if own > most]
        wanted = later
    shared, closed, depth = [t.arrays() for t in tops], [t.closed for t in tops], [t.depth for t in tops]

    def deal(batches):
        trees = np.arange(n_estimators)
        for pdf in _gathered(batches, BLOCK_ROWS):
            X, key = pdf[features].to_numpy(np.float64), pdf["_key"].to_numpy(np.int64)
            w = poisson_weights(key, trees, random_state) if bootstrap else np.ones((len(X), n_estimators))
            packed = np.c_[pdf[names].to_numpy(np.float64).view(np.int64), key]

            def sent(X=X, w=w, packed=packed):
                for t in range(n_estimators):
                    own = np.flatnonzero(w[:, t] > 0)
                    root = leaves(shared[t], X[own])
                    open_ = ~np.isin(root, list(closed[t]))
                    yield from ((t, r, packed[at]) for r, at in _by_root(root[open_], own[open_]))

            yield from _sent(sent())

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        t, root = int(pdf["tree"].iloc[0]), int(pdf["root"].iloc[0])
        given = np.frombuffer(b"".join(pdf["rows"]), np.int64).reshape(-1, p + 2)
        M, key = np.ascontiguousarray(given[:, :-1]).view(np.float64), given[:, -1]
        order = np.lexsort((key, *M.T[::-1]))
        M, key = M[order], key[order]
        w = poisson_weights(key, np.array([t]), random_state)[:, 0] if bootstrap else np.ones(len(M))
        left = None if max_depth is None else max_depth - depth[t][root]
        tree = grow(np.ascontiguousarray(M[:, :-1]), M[:, -1].copy(), w, left, min_samples_split, min_samples_leaf, base)
        inner = tree["feature"] >= 0
        gained = np.bincount(tree["feature"][inner], tree["gain"][inner], p).tolist()
        size = len(tree["feature"])
        return pd.DataFrame([{"tree": t, "root": root, "first": k, "n": min(NODE_SLICE, size - k), **{c: tree[c][k : k + NODE_SLICE].astype(kind).tobytes() for c, kind in _KINDS.items()}, "gains": gained if not k else [0.0] * p} for k in range(0, size, NODE_SLICE)])

    dealt = rows.mapInPandas(deal, "tree int, root long, rows binary").repartition(_tasks(spark, n * n_estimators), "tree", "root")
    path = scratch_path(spark, "forest-nodes")
    parts = ", ".join(f"{c} binary" for c in _KINDS)
    dealt.groupBy("tree", "root").applyInPandas(finish, f"tree int, root long, first long, n long, {parts}, gains array<double>").write.parquet(path)
    gains = np.zeros((n_estimators, p))
    total = 0
    for r in spark.read.parquet(path).groupBy("tree").agg(F.sum("n").alias("n"), *[F.sum(F.col("gains")[j]).alias(f"g{j}") for j in range(p)]).collect():  # a row a tree
        total += r["n"]
        gains[r["tree"]] += [r[f"g{j}"] for j in range(p)]
    for t, top in enumerate(tops):
        np.add.at(gains[t], [j for j in top.feature if j >= 0], [g for j, g in zip(top.feature, top.gain) if j >= 0])
    whole = gains.sum(1, keepdims=True)
    shares = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0)
    return ForestModel(list(features), shared, path, total, shares.mean(0).tolist())
