"""Exact linear-interpolated quantiles that scale.

Spark's exact ``percentile`` keeps a value -> count map and merges it in
one task: fine for columns with a moderate number of distinct values,
not for a billion distinct doubles. ``select`` finds the needed order
statistics instead:

1. one pass: count and approximate quantile edges per column;
2. one pass: rows per edge bucket, and how many equal the bucket's lower
   edge (a value held by a third of the table sits on an edge and is
   answered from this count, never sorted);
3. one pass: only rows of the few target buckets that lie strictly above
   the lower edge are numbered (window per (column, bucket), each about
   n / n_buckets rows).

``auto`` decides per column: Spark's ``percentile`` (one value map merged
in one task) for columns with at most ``exact_limit`` approximate distinct
values, ``select`` for the others.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXACT_LIMIT = 100_000  # measured crossover: 500k distinct values already select faster


def _splits(edges) -> list[float]:
    return [float("-inf")] + sorted({float(e) for e in edges if e is not None}) + [float("inf")]


def column_methods(df: DataFrame, columns: list[str], exact_limit: int = EXACT_LIMIT) -> dict[str, str]:
    """'exact' or 'select' per column from one approximate distinct count pass."""
    row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return {c: "exact" if (row[f"d{i}"] or 0) <= exact_limit else "select" for i, c in enumerate(columns)}


def choose_method(df: DataFrame, columns: list[str], exact_limit: int = EXACT_LIMIT) -> str:
    per = column_methods(df, columns, exact_limit)
    return "exact" if all(m == "exact" for m in per.values()) else "select"


def quantiles(df: DataFrame, columns: list[str], probs: list[float], method: str = "auto",
              n_buckets: int = 1024) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column: {column: [q(p) for p in probs]} (nulls skipped)."""
    if not columns:
        return {}
    if method == "auto":
        per = column_methods(df, columns)
        ex = [c for c in columns if per[c] == "exact"]
        se = [c for c in columns if per[c] == "select"]
        out = {}
        if ex:
            out.update(quantiles(df, ex, probs, "exact"))
        if se:
            out.update(_select(df, se, probs, n_buckets))
        return {c: out[c] for c in columns}
    xs = [F.col(c).cast("double") for c in columns]
    if method == "exact":
        arr = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(x, arr).alias(f"q{i}") for i, x in enumerate(xs)]).first()
        return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)
                for i, c in enumerate(columns)}
    if method == "approx":
        row = df.agg(*[F.percentile_approx(x, [float(p) for p in probs], 10000).alias(f"q{i}")
                       for i, x in enumerate(xs)]).first()
        return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)
                for i, c in enumerate(columns)}
    if method != "select":
        raise ValueError(f"unknown quantile method {method!r}")
    return _select(df, columns, probs, n_buckets)


def _select(df: DataFrame, columns: list[str], probs: list[float], nb: int) -> dict[str, list[float | None]]:
    fr = [i / nb for i in range(1, nb)]
    d = df.select(*[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    st = d.agg(*[F.count(f"_v{i}").alias(f"n{i}") for i in range(len(columns))],
               *[F.percentile_approx(f"_v{i}", fr, max(10000, 20 * nb)).alias(f"e{i}")
                 for i in range(len(columns))]).first()
    splits = [_splits(st[f"e{i}"] or []) for i in range(len(columns))]
    b = Bucketizer(splitsArray=splits, inputCols=[f"_v{i}" for i in range(len(columns))],
                   outputCols=[f"_b{i}" for i in range(len(columns))], handleInvalid="keep")
    bd = b.transform(d)
    stacked = bd.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("col"), F.col(f"_v{i}").alias("x"), F.col(f"_b{i}").cast("int").alias("b"),
                 F.element_at(F.array(*[F.lit(s) for s in splits[i]]), F.col(f"_b{i}").cast("int") + 1).alias("lower"))
        for i in range(len(columns))]))).where(F.col("x").isNotNull())
    cnt = (stacked.groupBy("col", "b")
           .agg(F.count(F.lit(1)).alias("c"), F.sum((F.col("x") == F.col("lower")).cast("long")).alias("eq"),
                F.first("lower").alias("lower")).collect())  # at most columns x n_buckets rows
    per_col: dict[int, list] = {}
    for r in cnt:
        per_col.setdefault(r["col"], []).append((r["b"], r["c"], r["eq"], r["lower"]))
    # positions needed, and where they fall
    need: dict[tuple[int, int], set[int]] = {}
    plan: dict[int, list] = {}
    for i in range(len(columns)):
        n = st[f"n{i}"]
        rows = sorted(per_col.get(i, []))
        offs, acc = [], 0
        for bb, c, eq, lower in rows:
            offs.append((bb, acc, c, eq, lower))
            acc += c
        plan[i] = []
        for p in probs:
            if not n:
                plan[i].append(None)
                continue
            h = p * (n - 1)
            lo, hi = int(math.floor(h)), int(math.ceil(h))
            locs = []
            for t in (lo, hi):
                for bb, off, c, eq, lower in offs:
                    if off <= t < off + c:
                        j = t - off
                        locs.append(("edge", lower) if j < eq else ("rank", (bb, j - eq + 1)))
                        if j >= eq:
                            need.setdefault((i, bb), set()).add(j - eq + 1)
                        break
            plan[i].append((h, lo, locs))
    found: dict[tuple[int, int, int], float] = {}
    if need:
        keys = F.array(*[F.lit(i * (1 << 20) + bb) for (i, bb) in need])
        w = Window.partitionBy("col", "b").orderBy("x")
        sub = (stacked.where(F.array_contains(keys, F.col("col") * (1 << 20) + F.col("b")) & (F.col("x") > F.col("lower")))
               .withColumn("r", F.row_number().over(w)))
        ranks = F.array(*[F.lit(r) for s in need.values() for r in s])
        for r in sub.where(F.array_contains(ranks, F.col("r"))).select("col", "b", "r", "x").collect():
            if r["r"] in need.get((r["col"], r["b"]), ()):
                found[(r["col"], r["b"], r["r"])] = r["x"]
    out = {}
    for i, c in enumerate(columns):
        vals = []
        for item in plan[i]:
            if item is None:
                vals.append(None)
                continue
            h, lo, locs = item
            v = [loc[1] if loc[0] == "edge" else found[(i, loc[1][0], loc[1][1])] for loc in locs]
            vals.append(v[0] + (h - lo) * (v[1] - v[0]))
        out[c] = vals
    return out


def grouped_quantiles(df: DataFrame, groups: list[str], col: str, probs: list[float], method: str = "auto",
                      exact_limit: int = EXACT_LIMIT) -> DataFrame:
    """Linear-interpolated quantiles of ``col`` per group: (groups..., q array<double>).

    'exact' is Spark's ``percentile`` (a value map per group). 'rank' reads
    the needed order statistics from running counts over the distinct
    (group, value) table (map-side combined; running sums bucketed by value,
    so neither a hot group nor a hot value lands in one task). 'auto' picks
    'rank' when some group has more than ``exact_limit`` distinct values.
    """
    d = df.select(*groups, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if method == "auto":
        mx = d.groupBy(*groups).agg(F.approx_count_distinct("_x").alias("_d")).agg(F.max("_d")).first()[0] or 0
        method = "exact" if mx <= exact_limit else "rank"
    if method == "exact":
        return d.groupBy(*groups).agg(F.percentile("_x", F.array(*[F.lit(float(p)) for p in probs])).alias("q"))
    if method != "rank":
        raise ValueError(f"unknown grouped quantile method {method!r}")
    # distinct (group, value) rows with counts: a hot value is one row; positions of a value
    # are (rows of its group below it, + its count]
    from .ranking import running_sums_before
    vals = d.groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_c"))
    gkey = "_gk"
    vals = vals.withColumn(gkey, F.to_json(F.struct(*groups)) if groups else F.lit(""))
    run = running_sums_before(vals, gkey, "_x", ["_c"])
    n = vals.groupBy(gkey).agg(F.sum("_c").alias("_n"))
    r = run.join(n, gkey)
    below, upto = F.col("before__c"), F.col("before__c") + F.col("_c")
    aggs = []
    for k, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        aggs += [F.max(F.when((below < lo) & (lo <= upto), F.col("_x"))).alias(f"_lo{k}"),
                 F.max(F.when((below < hi) & (hi <= upto), F.col("_x"))).alias(f"_hi{k}")]
    picked = r.groupBy(*groups).agg(F.first("_n").alias("_n"), *aggs)
    qs = []
    for k, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        qs.append(F.col(f"_lo{k}") + (h - F.floor(h)) * (F.col(f"_hi{k}") - F.col(f"_lo{k}")))
    return picked.select(*groups, F.array(*qs).alias("q"))
