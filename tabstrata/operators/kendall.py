"""Exact Kendall S = n_concordant - n_discordant for columns of any cardinality.

Divide and conquer over x, carried out level by level for all groups at
once (a group is one block of the previous level; level 0 has one group):

* groups of at most ``leaf`` rows are solved exactly in NumPy
  (``applyInPandas``; an inversion count by vectorized merging);
* larger groups are cut into ``blocks`` x-blocks: a block is a range of
  x values (equal x always share a block, and a value holding more than
  1/blocks of its group gets a block of its own, which has no inner
  pairs). Pairs in different blocks have a known x order, so their
  contribution is sum over rows r of
  #(earlier-block rows with smaller y) - #(earlier-block rows with larger y),
  computed on the distinct (group, y) table with per-block counts and
  running sums over y (bucketed, never one window over the table);
* pairs inside a block are the next level's groups.

Every level reads the rows once; group sizes shrink by about ``blocks``
per level, so there are about log_blocks(n / leaf) levels. No pairs of
rows are formed and no group larger than ``leaf`` is gathered into one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_sums_before


# --------------------------------------------------------------------------------------
# exact S in NumPy
# --------------------------------------------------------------------------------------
def inversions(r: np.ndarray) -> int:
    """Pairs i < j with r[i] > r[j] (strict), by bottom-up merging, vectorized per level."""
    m = len(r)
    a = np.asarray(r, dtype=np.int64).copy()
    inv, w = 0, 1
    idx = np.arange(m)
    while w < m:
        pair = idx // (2 * w)
        left = ((idx // w) % 2) == 0
        key = pair * (m + 1) + a
        lk, rk, rpair = key[left], key[~left], pair[~left]
        if rk.size:
            pos = np.searchsorted(lk, rk, side="right")
            end = np.searchsorted(lk, rpair * (m + 1) + m, side="right")
            inv += int((end - pos).sum())
        a = a[np.lexsort((a, pair))]
        w *= 2
    return inv


def _pairs_tied(v: np.ndarray) -> float:
    _, c = np.unique(v, return_counts=True)
    return float((c * (c - 1) // 2).sum())


def numpy_s(x: np.ndarray, y: np.ndarray) -> float:
    n = len(x)
    if n < 2:
        return 0.0
    order = np.lexsort((y, x))
    ys = y[order]
    ranks = np.unique(ys, return_inverse=True)[1]
    d = inversions(ranks)
    xy = np.unique(np.stack([x, y], axis=1), axis=0, return_counts=True)[1]
    n3 = float((xy * (xy - 1) // 2).sum())
    return n * (n - 1) / 2.0 - _pairs_tied(x) - _pairs_tied(y) + n3 - 2.0 * d


# --------------------------------------------------------------------------------------
# one level
# --------------------------------------------------------------------------------------
def _assign_blocks(rows: DataFrame, sizes: DataFrame, blocks: int) -> DataFrame:
    """Block of each row's x inside its group: 2*floor(below(x)*blocks/n_g) + heavy."""
    vals = rows.groupBy("g", "x").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_sums_before(vals, "g", "x", ["c"]).join(sizes, "g")
    base = F.floor(F.col("before_c") * blocks / F.col("n_g"))
    heavy = (F.col("c") * blocks > F.col("n_g")).cast("long")
    bl = ranked.select("g", "x", (base * 2 + heavy).cast("int").alias("bx"), heavy.alias("single"))
    return rows.join(bl, ["g", "x"])


def _cross_term(rows: DataFrame, nblk: int) -> DataFrame:
    """Sum over groups of the cross-block contribution (one row, column S)."""
    cnt = [F.sum((F.col("bx") == a).cast("long")).alias(f"c{a}") for a in range(nblk)]
    ty = rows.groupBy("g", "y").agg(*cnt)
    tot = ty.groupBy("g").agg(*[F.sum(f"c{a}").alias(f"N{a}") for a in range(nblk)])
    run = running_sums_before(ty, "g", "y", [f"c{a}" for a in range(nblk)]).join(tot, "g")
    # D_a = less_a + le_a - N_a, with le_a = less_a + c_a. The sum over the blocks is one fold of an
    # array: written out, every prefix repeats the ones before it, and the generated code doubles a block
    terms = F.array(*[F.struct(F.col(f"c{a}").alias("c"), (F.col(f"before_c{a}") * 2 + F.col(f"c{a}") - F.col(f"N{a}")).alias("d")) for a in range(nblk)])
    start = F.struct(F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("s"))
    contrib = F.aggregate(terms, start, lambda at, t: F.struct((at["prefix"] + t["d"]).alias("prefix"), (at["s"] + t["c"].cast("double") * at["prefix"]).alias("s")),
                          lambda at: at["s"])
    return run.agg(F.sum(contrib).alias("S"))


def kendall_s(df: DataFrame, x: str, y: str, blocks: int = 16, leaf: int = 200_000,
              max_levels: int = 64) -> tuple[float, int, float, float]:
    """Exact (S, n, n1, n2) over rows where both values are present."""
    from ..session import shared_dir
    shared_dir(df.sparkSession)  # blocks are checkpointed to the shared folder
    base = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) \
             .where(F.col("x").isNotNull() & F.col("y").isNotNull())
    ties = base.groupBy("x").agg(F.count(F.lit(1)).alias("c")).agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2)).first()[0]
    tiesy = base.groupBy("y").agg(F.count(F.lit(1)).alias("c")).agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2)).first()[0]
    cur = base.withColumn("g", F.lit("r"))
    total, n = 0.0, None
    nblk = 2 * blocks

    def leaf_s(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"s": [numpy_s(pdf["x"].to_numpy(), pdf["y"].to_numpy())]})

    for _ in range(max_levels):
        sizes = cur.groupBy("g").agg(F.count(F.lit(1)).alias("n_g"))
        if n is None:
            n = int(sizes.agg(F.sum("n_g")).first()[0] or 0)
        st = sizes.agg(F.max("n_g").alias("mx"), F.sum(F.when(F.col("n_g") > leaf, 1).otherwise(0)).alias("big")).first()
        if st["mx"] is None:
            break
        small = cur.join(sizes.where(F.col("n_g") <= leaf).select("g"), "g")
        s_leaf = small.groupBy("g").applyInPandas(leaf_s, "s double").agg(F.sum("s")).first()[0]
        total += float(s_leaf or 0.0)
        if not st["big"]:
            break
        big = cur.join(sizes.where(F.col("n_g") > leaf), "g")
        blk = _assign_blocks(big.drop("n_g"), sizes.where(F.col("n_g") > leaf), blocks)
        blk = blk.checkpoint(eager=True)  # read three times below; cut the lineage
        total += float(_cross_term(blk, nblk).first()["S"] or 0.0)
        # pairs inside a block: next level; single-valued blocks have none
        cur = blk.where(F.col("single") == 0).select(F.concat_ws(".", "g", F.col("bx").cast("string")).alias("g"), "x", "y")
    else:
        raise RuntimeError("kendall_s did not converge")
    return total, n or 0, float(ties or 0.0), float(tiesy or 0.0)


def kendall_tau_b(df: DataFrame, x: str, y: str, **kw) -> float | None:
    s, n, n1, n2 = kendall_s(df, x, y, **kw)
    n0 = n * (n - 1) / 2.0
    den = (n0 - n1) * (n0 - n2)
    return s / den ** 0.5 if den > 0 else None
