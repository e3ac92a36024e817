"""Connected components of an edge table: contraction inside tasks, and star operations between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstrata.session import scratch_path

#: Edges that one task contracts; more edges make more tasks.
EDGES_PER_TASK = 250_000


def least_labels(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Least node of the component of each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task's edges: its components as stars around their least nodes."""
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if parts:
        u, v = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        nodes, which = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = least_labels(which[: len(u)], which[len(u) :], len(nodes))
        away = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(nodes[label[away]])], names=["u", "v"])


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node and the node itself are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
    ties = down.join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return ties.unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node with an edge; ``edges`` has u and v (bigint, no nulls), u != v.

    Each round deals the edges out to tasks of at most ``EDGES_PER_TASK``, which
    replace theirs by stars, and is written to the shared folder. Where one
    task is enough that is the result; else star operations join the tasks'
    stars, until a round leaves the edges as they were. Only counts and
    checksums come to the driver.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.select("u", "v").write.parquet(path)
        return spark.read.parquet(path)

    edges, before = written(edges), None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or now == before:
            break
        before = now
        tasks = -(-now["n"] // EDGES_PER_TASK)
        stars = edges.repartition(tasks).mapInArrow(_contract, "u long, v long")
        if tasks == 1:
            edges = written(stars)
            break
        edges = written(_small(_large(written(stars))))
    # a star: every node is tied to the least one
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
