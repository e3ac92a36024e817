"""Merkle manifest of a dataset: one root digest, and for every row the siblings that prove it.

Rows are leaves. The leaves of each source, by id, are joined 16 at a time into
nodes until one is left, and so are the sources' subroots. Every node is kept
as a content-addressed record (digest, children). Proofs are found by going
down those records: requests start at the root, and at each height join the
record of their digest, go on to every child, and note the children that the
child leaves out. Requests that go the same way are one row until they part,
so a request is for a node, and only the last step has a row for each leaf.

All positions come from a range-partitioned sort (``numbered``), so neither a
hot source nor the whole table is ever one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabstrata.session import scratch_path

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<before:string,after:string>"


def field_text(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(field_text(c) for c in fields)), 256)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with their position (from 0) in their tree and the tree's number of rows; written to the shared folder.

    Rows are cut into ranges of (tree, order) and sorted in each; a tree's
    ranges are counted and each range starts where the ones before end. Equal
    rows are dealt over ranges by where they were read.
    """
    keys = [F.col(c).asc_nulls_first() for c in dict.fromkeys([tree, *order, "_read"])]
    dealt = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    rows = _written(dealt.drop("_read").withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), "merkle-order")
    parts = rows.groupBy(F.col(tree).alias("_tree"), F.col("_part").alias("_in")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy("_tree")
    before = F.coalesce(F.sum("_rows").over(own.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("_before", before).withColumn("n", F.sum("_rows").over(own)).drop("_rows")
    placed = rows.join(parts, (F.col("_part") == F.col("_in")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return placed.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_tree", "_in", "_first", "_before")


class Forest:
    """Trees over numbered leaves (tree, rank, n, digest): their records by height, and roots (tree, depth, digest).

    ``members`` are the rows of the leaves by the node above them, or None.
    """

    def __init__(self, leaves: DataFrame, extra: list[str] | None = None):
        most = leaves.agg(F.max("n")).first()[0] or 0
        level = leaves.select("tree", F.col("rank").alias("node"), "n", "digest", *(extra or []))
        self.records, self.members, depth = [], None, 0
        roots = [level.filter("n = 1").select("tree", F.lit(0).alias("depth"), "digest")]
        while most > 1:
            one = F.struct("node", "digest", *(extra if extra and not depth else []))
            up = level.filter("n > 1").groupBy("tree", F.expr(f"node div {FANOUT}").alias("node"))
            up = up.agg(F.array_sort(F.collect_list(one)).alias("under"), F.max(F.expr(f"(n + {FANOUT - 1}) div {FANOUT}")).alias("n"))
            children = F.col("under.digest")
            level = _written(up.select("tree", "node", "n", F.sha2(F.array_join(children, ""), 256).alias("digest"), children.alias("children"), *([F.col("under").alias("members")] if extra and not depth else [])), "merkle-nodes")
            if not depth:
                self.members = level
            self.records.append(level.select("digest", "children"))
            depth, most = depth + 1, -(-most // FANOUT)
            roots.append(level.filter("n = 1").select("tree", F.lit(depth).alias("depth"), "digest"))
        self.roots = roots[0]
        for r in roots[1:]:
            self.roots = self.roots.unionByName(r)

    def _children(self, requests: DataFrame, height: int) -> DataFrame:
        """The requests' children: each notes what stands before and after it in its node's record."""
        record = self.records[height - 1].dropDuplicates(["digest"])
        found = requests.join(record, "digest").select("tree", "node", "root", "path", "children", F.posexplode("children").alias("digit", "child"))
        before, after = F.array_join(F.slice("children", 1, F.col("digit")), ""), F.array_join(F.slice("children", F.col("digit") + 2, FANOUT), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")).cast(_STEP))
        return found.select("tree", (F.col("node") * FANOUT + F.col("digit")).alias("node"), F.col("child").alias("digest"), "root", F.concat("path", step).alias("path"))

    def descend(self, starts: DataFrame, to: int = 0) -> DataFrame:
        """From starts (tree, depth, digest, path) down to height ``to``: tree, node, digest, root (the start's digest) and the path.

        The requests of every height but the last are written: a plan of all
        heights at once is planned again on the driver after each of its stages.
        """
        begin = lambda h: starts.filter(F.col("depth") == h).select("tree", F.lit(0).cast("long").alias("node"), "digest", F.col("digest").alias("root"), "path")
        at = begin(len(self.records))
        for height in range(len(self.records), to, -1):
            at = self._children(at, height).unionByName(begin(height - 1))
            if height - 1 > to:
                at = _written(at, "merkle-requests")
        return at


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its path (root first) lead to."""
    return F.aggregate(F.reverse(path), digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, those of the leaf first."""
    return F.sha2(F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(df: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None, fields: tuple[str, ...] = FIELDS, tree: str = "source", order: str = "doc_id") -> DataFrame:
    """One row a leaf: ``order`` column, leaf, subroot, root, path (siblings before and after, root first), proof_sha256, folded_root and verified.

    ``tampered`` names columns to replace in rows ``where`` before the leaf is
    checked against the proof of the untampered data. Leaves are ordered by
    ``order`` (null first), ties by their digest; equal rows are leaves of their
    own with equal digests. A null source is a tree like any other and the first
    one. Null and empty fields differ (``-`` and ``0:``). An empty table has no
    rows and no root. Columns other than ``fields`` don't matter, whatever
    their names.
    """
    spark = df.sparkSession
    given = leaf_digest([F.col(c) for c in fields])
    changed = leaf_digest([(tampered or {}).get(c, F.col(c)) for c in fields])
    changed = F.when(where, changed) if where is not None else changed if tampered else F.lit(None).cast("string")
    leaves = _written(df.select(F.col(tree).alias("tree"), F.col(order).alias("id"), given.alias("digest"), changed.alias("changed")), "merkle-leaves")
    leaves = numbered(leaves, "tree", ["id", "digest"])
    sources = Forest(leaves, ["id", "changed"])
    roots = _written(numbered(_written(sources.roots, "merkle-subroots").withColumn("all", F.lit(0)), "all", ["tree"]), "merkle-sources")
    top = Forest(roots.select(F.lit(0).alias("tree"), "rank", "n", "digest"))
    root = top.roots.first()
    if root is None:
        return _nothing(spark, order, df.schema[order].dataType.simpleString())
    start = top.roots.withColumn("path", F.array().cast(f"array<{_STEP}>"))
    paths = _written(top.descend(start).select(F.col("node").alias("rank"), "path"), "merkle-top")
    starts = _written(roots.join(paths, "rank").select("tree", "depth", "digest", "path"), "merkle-starts")
    alone = leaves.filter("n = 1").alias("a").join(starts.alias("s"), F.col("a.tree").eqNullSafe(F.col("s.tree")))
    found = alone.select("a.id", F.col("a.digest").alias("leaf"), "a.changed", F.col("s.digest").alias("subroot"), "s.path")
    if sources.members is not None:
        above = sources.descend(starts.filter("depth > 0"), to=1).alias("r")
        rows = above.join(sources.members.alias("m"), F.col("r.tree").eqNullSafe(F.col("m.tree")) & (F.col("r.node") == F.col("m.node")) & (F.col("r.digest") == F.col("m.digest")))
        rows = rows.select("r.path", F.col("r.root").alias("subroot"), "m.children", F.posexplode("m.members").alias("digit", "member"))
        step = F.struct(F.array_join(F.slice("children", 1, F.col("digit")), "").alias("before"), F.array_join(F.slice("children", F.col("digit") + 2, FANOUT), "").alias("after"))
        rows = rows.select(F.col("member.id").alias("id"), F.col("member.digest").alias("leaf"), F.col("member.changed").alias("changed"), "subroot", F.concat("path", F.array(step.cast(_STEP))).alias("path"))
        found = found.unionByName(rows)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    out = found.select(F.col("id").alias(order), "leaf", "subroot", F.lit(root["digest"]).alias("root"), "path", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _nothing(spark: SparkSession, order: str, kind: str) -> DataFrame:
    return spark.createDataFrame([], f"{order} {kind}, leaf string, subroot string, root string, path array<{_STEP}>, proof_sha256 string, folded_root string, verified boolean")
