"""Distribution data (C14-C21, C29): histograms, kernel densities, box and
violin statistics, confidence intervals, bootstrap replicates, pair densities.

Everything reduces rows to a bounded number of bins with a map-side
combined ``groupBy`` first; grids, kernels and replicates then work on
those bins (or on per-partition partial sums), never on rows times grid
points.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SQRT_2PI = math.sqrt(2.0 * math.pi)
# Fixed value: two-sided 95% normal quantile.
Z95 = 1.959963984540054


def _bin_expr(x: Column, lo: float, width: float, k: int) -> Column:
    if not width or width <= 0:
        return F.lit(0)
    return F.least(F.greatest(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(0)), F.lit(k - 1)).cast("int")


def auto_bins(n: int, lo: float, hi: float, iqr: float | None) -> int:
    """Bin count from the smaller of the Sturges and Freedman-Diaconis widths."""
    if n <= 1 or hi <= lo:
        return 1
    rng = hi - lo
    w_sturges = rng / (math.log2(n) + 1.0)
    w_fd = 2.0 * iqr * n ** (-1.0 / 3.0) if iqr else 0.0
    w = min(w_sturges, w_fd) if w_fd > 0 else w_sturges
    return max(1, int(math.ceil(rng / w)))


def histogram(df: DataFrame, col: str, bins: int | str = 30, group: str | None = None) -> DataFrame:
    """C14: equal-width bins over [min, max] (last bin closed); empty bins included.

    Pass 1: min/max/n (and IQR for ``bins='auto'``). Pass 2: one grouped
    count of bin indexes, right-joined to the k bin rows so empty bins show.
    """
    x = F.col(col).cast("double")
    d = df.where(x.isNotNull())
    st = d.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")).first()
    spark = df.sparkSession
    if st["n"] == 0:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    lo, hi = float(st["lo"]), float(st["hi"])
    if bins == "auto":
        from .quantiles import quantiles
        q1, q3 = quantiles(d.select(x.alias("_x")), ["_x"], [0.25, 0.75])["_x"]
        k = auto_bins(st["n"], lo, hi, q3 - q1)
    else:
        k = int(bins)
    width = (hi - lo) / k if hi > lo else 0.0
    keys = [group] if group else []
    counts = d.groupBy(*keys, _bin_expr(x, lo, width, k).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(k).select(F.col("id").cast("int").alias("bin"))
    if group:
        grid = d.select(group).distinct().select(group, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left").fillna(0, ["count"])
    return out.select(*keys, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                      F.when(F.col("bin") == k - 1, F.lit(hi))
                      .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                      F.col("count").cast("long").alias("count"))


# --------------------------------------------------------------------------------------
# Gaussian KDE
# --------------------------------------------------------------------------------------
#: Fine bins in a bandwidth, bandwidths beyond which a kernel counts as 0 (it is below 1.3e-14), groups whose statistics are broadcast.
BINS_PER_H, REACH_H, MAX_BROADCAST_GROUPS = 32, 8, 100_000


def with_group_stats(d: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``d`` with their group's statistics: literals without keys, a broadcast up to
    ``MAX_BROADCAST_GROUPS`` groups (counted), else a join that AQE splits where a group is hot."""
    if not keys:
        row = stats.first().asDict()
        return d.withColumns({c: F.lit(v) for c, v in row.items()})
    from ..session import scratch_path
    path = scratch_path(d.sparkSession, "group-stats")  # a row a group; counted, then joined
    stats.write.parquet(path)
    stats = d.sparkSession.read.parquet(path)
    return d.join(F.broadcast(stats) if stats.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS else stats, keys)


def kde(df: DataFrame, col: str, group: str | None = None, grid_size: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE on a grid, Scott bandwidth h = sigma * n^(-1/5) (per group).

    Rows collapse to sparse bins of h / 32 (map-side combined) that keep the
    first moments of their values, so the work follows the occupied bins,
    whatever the range, and no bin is ever wider than the kernel. A kernel is
    summed over a bin by its Taylor series up to the third moment; what is left
    out is below 1e-8 of the bin's share. Each grid point meets only the bins
    within 8 h, by an equi-join on ranges of that width (at most 257 bins each).
    The grid spans [min - cut*h, max + cut*h].
    """
    x = F.col(col).cast("double")
    keys = [group] if group else []
    d = df.where(x.isNotNull() & ~F.isnan(x) & (F.col(group).isNotNull() if group else F.lit(True)))
    st = d.groupBy(*keys).agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                              F.stddev_samp(x).alias("sd"))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    j = with_group_stats(d, st, keys).where(F.col("h") > 0)
    w = F.col("h") / BINS_PER_H
    fb = F.floor((x - F.col("lo")) / w)
    off = x - (F.col("lo") + (fb + 0.5) * w)
    bins = j.select(*keys, "lo", "h", "n", "hi", fb.alias("fb"), off.alias("off")).groupBy(*keys, "fb").agg(
        F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("h").alias("h"), F.first("n").alias("n"),
        *[F.sum(F.pow("off", F.lit(float(k)))).alias(f"m{k}") for k in range(4)])
    bins = bins.withColumn("center", F.col("lo") + (F.col("fb") + 0.5) * w) \
               .withColumn("part", F.floor((F.col("center") - F.col("lo")) / (REACH_H * F.col("h"))))
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid_size - 1)
    g = st.where(F.col("h") > 0).select(*keys, "lo", "hi", "h", "n", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("grid"))
    g = g.withColumn("x", F.col("lo") - cut * F.col("h") + F.col("grid") * step)
    own = F.floor((F.col("x") - F.col("lo")) / (REACH_H * F.col("h")))
    g = g.select(*keys, "grid", "x", F.col("h").alias("_h"), F.col("n").alias("_n"), F.explode(F.array(own - 1, own, own + 1)).alias("part"))
    z = (F.col("x") - F.col("center")) / F.col("h")
    # phi and its derivatives over phi: 1, -z, z^2 - 1, 3z - z^3; moments enter with alternating signs
    series = (F.col("m0") + F.col("m1") / F.col("h") * z + F.col("m2") / (2 * F.pow("h", F.lit(2.0))) * (z * z - 1)
              + F.col("m3") / (6 * F.pow("h", F.lit(3.0))) * (z * z * z - 3 * z))
    term = F.when(F.abs(z) <= REACH_H, F.exp(-0.5 * z * z) * series)
    return (g.join(bins.select(*keys, "part", "center", "h", "m0", "m1", "m2", "m3"), [*keys, "part"], "left")
            .groupBy(*keys, "grid").agg(F.first("x").alias("x"),
                                        (F.coalesce(F.sum(term), F.lit(0.0)) / (F.first("_n") * F.first("_h") * F.lit(SQRT_2PI))).alias("density")))


# --------------------------------------------------------------------------------------
# C17 / C18 / C19
# --------------------------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """C17: q1, median, q3, whiskers (most extreme values inside the 1.5*IQR
    fences), number of points outside, count - per group or for the column."""
    x = F.col(col).cast("double")
    keys = [group] if group else []
    d = df.where(x.isNotNull())
    if group:
        d = d.where(F.col(group).isNotNull())
    if keys:
        from .quantiles import grouped_quantiles
        q = grouped_quantiles(d, keys, col, [0.25, 0.5, 0.75])
    else:
        from .quantiles import quantiles
        one = quantiles(d.select(x.alias("_x")), ["_x"], [0.25, 0.5, 0.75])["_x"]
        q = d.sparkSession.createDataFrame([(one,)], "q array<double>")
    q = q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("lo_f", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_f", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = with_group_stats(d, q, keys)
    inside = (x >= F.col("lo_f")) & (x <= F.col("hi_f"))
    return j.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outside"), F.count(F.lit(1)).alias("count"))


def box_stats_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """C17 for several columns at once (long form): stack, then one grouped pass."""
    st = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                      for c in columns])))
    return box_stats(st, "value", "column")


def violin(df: DataFrame, col: str, group: str, grid_size: int = 100) -> DataFrame:
    """Per-group density on a grid plus the group's quartiles."""
    k = kde(df, col, group, grid_size=grid_size)
    b = box_stats(df, col, group).select(group, "q1", "median", "q3")
    return k.join(b, group)


def group_ci(df: DataFrame, col: str, group: str) -> DataFrame:
    """Group mean with a normal 95% confidence interval (mean +- z * s / sqrt(n))."""
    x = F.col(col).cast("double")
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    half = F.lit(Z95) * F.col("std") / F.sqrt(F.col("n"))
    return g.withColumn("ci_low", F.col("mean") - half).withColumn("ci_high", F.col("mean") + half)


# --------------------------------------------------------------------------------------
# C20: Poisson bootstrap
# --------------------------------------------------------------------------------------
def _mix64(z: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer on uint64 arrays (vectorized, wraps modulo 2^64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _poisson1_thresholds(kmax: int = 20) -> np.ndarray:
    p, acc, out = math.exp(-1.0), 0.0, []
    for k in range(kmax):
        acc += p
        out.append(acc)
        p /= (k + 1)
    return np.array(out)


#: Bytes of replicate sums that a task holds at once; rows whose weights are drawn at once.
SUM_BYTES, DRAWN_ROWS = 64 << 20, 2048


def _interval(sums: np.ndarray, level: float) -> tuple[float, float, int]:
    """Percentile interval of the replicates' means; replicates that drew no row have none."""
    m = sums[1][sums[0] > 0] / sums[0][sums[0] > 0]
    if not m.size:
        return math.nan, math.nan, 0
    lo, hi = np.quantile(m, [(1.0 - level) / 2.0, (1.0 + level) / 2.0])
    return float(lo), float(hi), int(m.size)


def bootstrap_mean_ci(df: DataFrame, col: str, id_col: str, group: str | None = None, replicates: int = 1000,
                      seed: int = 42, level: float = 0.95) -> DataFrame:
    """C20: Poisson bootstrap of the (group) mean: percentile interval over replicates.

    Each row carries repeatable Poisson(1) weights, one per replicate, drawn
    from a hash of (seed, id, replicate); weighted sums are added up with NumPy.
    As long as the sums of all groups (counted) fit into ``SUM_BYTES``, rows
    stay where they are and only sums travel, merged in two steps. With more
    groups, rows are range-sorted by (group, id) and summed group after group:
    a group inside a task is done there, and only the first and last one of each
    range are merged, so a hot group is many tasks and small ones cost no sums.
    """
    keys = [group] if group else []
    d = df.select(*keys, F.col(id_col).cast("long").alias("_id"), F.col(col).cast("double").alias("_x")) \
          .where(F.col("_x").isNotNull())
    if group:
        d = d.where(F.col(group).isNotNull()).withColumn("_g", F.col(group).cast("string"))
    else:
        d = d.withColumn("_g", F.lit(""))
    d = d.select("_g", "_id", "_x")
    B = int(replicates)
    most = max(1, SUM_BYTES // (16 * B))
    few = d.select("_g").distinct().limit(most + 1).count() <= most
    kind = "_g string, _part int, ci_low double, ci_high double, replicates long, sums binary"

    def row(g, sums, done):
        lo, hi, n = _interval(sums, level) if done else (None, None, None)
        return {"_g": g, "_part": int(np.random.randint(32)), "ci_low": lo, "ci_high": hi, "replicates": n, "sums": None if done else sums.tobytes()}

    def drawn(pdf):
        """(group, its sums) of stretches of rows of one group, in order."""
        for at in range(0, len(pdf), DRAWN_ROWS):
            part = pdf.iloc[at:at + DRAWN_ROWS]
            g = part["_g"].to_numpy()
            starts = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1]
            w = _poisson_weights(part["_id"].to_numpy(dtype=np.int64), B, seed)
            sw = np.add.reduceat(w, starts)
            yield from zip(g[starts], np.stack([sw, np.add.reduceat(w * part["_x"].to_numpy()[:, None], starts)], 1))

    def in_place(it):
        acc: dict[str, np.ndarray] = {}
        for pdf in it:
            for g, sums in drawn(pdf.sort_values("_g", kind="stable")):
                acc[g] = acc[g] + sums if g in acc else sums
        yield pd.DataFrame([row(g, sums, False) for g, sums in acc.items()], columns=["_g", "_part", "ci_low", "ci_high", "replicates", "sums"])

    def in_order(it):
        current, total, first, out = None, None, True, []
        for pdf in it:
            for g, sums in drawn(pdf):
                if g == current:
                    total = total + sums
                    continue
                if current is not None:
                    out.append(row(current, total, not first))
                    first = False
                current, total = g, sums
            if out:
                yield pd.DataFrame(out)
                out = []
        if current is not None:
            yield pd.DataFrame([row(current, total, False)])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([row(pdf["_g"].iloc[0], sum(np.frombuffer(b).reshape(2, B) for b in pdf["sums"]), False)])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([row(pdf["_g"].iloc[0], sum(np.frombuffer(b).reshape(2, B) for b in pdf["sums"]), True)])

    merged = lambda p: p.groupBy("_g", "_part").applyInPandas(add, kind).groupBy("_g").applyInPandas(finish, kind)
    if few:
        out = merged(d.mapInPandas(in_place, kind))
    else:
        from ..session import scratch_path
        path = scratch_path(df.sparkSession, "bootstrap")
        d.repartitionByRange("_g", "_id").sortWithinPartitions("_g", "_id").mapInPandas(in_order, kind).write.parquet(path)
        rows = df.sparkSession.read.parquet(path)
        out = rows.where("sums IS NULL").unionByName(merged(rows.where("sums IS NOT NULL")))
    mean = d.groupBy("_g").agg(F.avg("_x").alias("mean"), F.count(F.lit(1)).alias("n"))
    res = mean.join(out, "_g").select("_g", "n", "mean", "ci_low", "ci_high", "replicates")
    return res.withColumnRenamed("_g", group) if group else res.drop("_g")


# --------------------------------------------------------------------------------------
# C21 / C29
# --------------------------------------------------------------------------------------
def pair_density(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """C21 off-diagonal: 2-D histogram for every pair of ``columns``.

    Ranges come from one aggregate pass; all pairs are stacked into
    (x, y, bin_x, bin_y) and counted in ONE grouped aggregate.
    """
    st = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
                *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    b = {}
    for i, c in enumerate(columns):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        w = (hi - lo) / bins if lo is not None and hi > lo else 0.0
        b[c] = _bin_expr(F.col(c).cast("double"), lo or 0.0, w, bins)
    pairs = [(a, c) for i, a in enumerate(columns) for c in columns[i + 1:]]
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(c).alias("y"),
                 F.when(F.col(a).isNotNull() & F.col(c).isNotNull(), b[a]).alias("bin_x"),
                 F.when(F.col(a).isNotNull() & F.col(c).isNotNull(), b[c]).alias("bin_y"))
        for a, c in pairs])))
    return (stacked.where(F.col("bin_x").isNotNull())
            .groupBy("x", "y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))


def pair_columns(df: DataFrame, target: str | None, columns: list[str] | None = None, max_cols: int = 6) -> list[str]:
    """C21 column choice: up to ``max_cols`` numeric columns; with more, the
    ``max_cols - 1`` most target-correlated ones (the target is one of them)."""
    from .profile import numeric_columns
    from .relations import target_correlations
    cols = columns or numeric_columns(df)
    if len(cols) <= max_cols:
        return cols
    if not target:
        return cols[:max_cols - 1]
    tc = target_correlations(df, target, cols).withColumn("a", F.abs("corr"))
    top = [r["feature"] for r in tc.orderBy(F.col("a").desc_nulls_last(), "feature").limit(max_cols - 2).collect()]
    return top + [target]


def before_after(before: DataFrame, after: DataFrame, columns: list[str] | None = None, bins: int = 30,
                 max_cols: int = 6) -> DataFrame:
    """30-bin histograms of the shared numeric columns (first 6) before and
    after preparation, stacked with a ``stage`` column."""
    from .profile import numeric_columns
    shared = [c for c in numeric_columns(before) if c in set(numeric_columns(after))]
    cols = (columns or shared)[:max_cols]
    parts = []
    for stage, frame in (("before", before), ("after", after)):
        for c in cols:
            parts.append(histogram(frame, c, bins).select(F.lit(stage).alias("stage"), F.lit(c).alias("column"),
                                                          "bin", "bin_lo", "bin_hi", "count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _poisson_weights(ids: np.ndarray, B: int, seed: int) -> np.ndarray:
    """rows x B repeatable Poisson(1) weights from a hash of (seed, id, replicate)."""
    salt = np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    reps = np.arange(B, dtype=np.uint64)
    h = _mix64(_mix64(ids.astype(np.uint64)[:, None] ^ salt) + reps[None, :] * np.uint64(0x9E3779B97F4A7C15))
    uu = (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_poisson1_thresholds(), uu, side="right").astype(np.float64)


def regression_band(df: DataFrame, x: str, y: str, id_col: str, replicates: int = 1000, seed: int = 42,
                    level: float = 0.95, grid_size: int = 50) -> DataFrame:
    """C13 band: least-squares line of y on x and its bootstrap percentile band.

    Each replicate's weighted sums (w, wx, wy, wxx, wxy) are accumulated per
    partition with NumPy, so only partitions x replicates rows are
    shuffled; the band is the percentile of a_b + s_b * x over replicates
    at ``grid_size`` points between min(x) and max(x).
    """
    d = df.select(F.col(id_col).cast("long").alias("_id"), F.col(x).cast("double").alias("_x"),
                  F.col(y).cast("double").alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    B = int(replicates)

    def partial(it):
        acc = np.zeros((5, B))
        for whole in it:
            for at in range(0, len(whole), DRAWN_ROWS):
                pdf = whole.iloc[at:at + DRAWN_ROWS]
                w = _poisson_weights(pdf["_id"].to_numpy(dtype=np.int64), B, seed)
                xs, ys = pdf["_x"].to_numpy(), pdf["_y"].to_numpy()
                acc += np.stack([np.ones(len(xs)), xs, ys, xs * xs, xs * ys]) @ w
        yield pd.DataFrame({"rep": np.arange(B, dtype=np.int32), "sw": acc[0], "sx": acc[1], "sy": acc[2],
                            "sxx": acc[3], "sxy": acc[4]})

    sums = d.mapInPandas(partial, "rep int, sw double, sx double, sy double, sxx double, sxy double") \
            .groupBy("rep").agg(*[F.sum(c).alias(c) for c in ("sw", "sx", "sy", "sxx", "sxy")])
    slope = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("sw")) / (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("sw"))
    lines = sums.select("rep", slope.alias("s"), (F.col("sy") / F.col("sw")).alias("my"), (F.col("sx") / F.col("sw")).alias("mx"))
    lines = lines.select("rep", "s", (F.col("my") - F.col("s") * F.col("mx")).alias("a"))
    st = d.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.regr_slope("_y", "_x").alias("s"),
               F.regr_intercept("_y", "_x").alias("a")).first()
    step = (st["hi"] - st["lo"]) / max(grid_size - 1, 1)
    a = (1.0 - level) / 2.0
    band = (lines.select("a", "s", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("grid"))
            .withColumn("x", F.lit(st["lo"]) + F.col("grid") * F.lit(step))
            .groupBy("grid", "x").agg(F.percentile(F.col("a") + F.col("s") * F.col("x"),
                                                   F.array(F.lit(a), F.lit(1.0 - a))).alias("ci")))
    return band.select("grid", "x", (F.lit(st["a"]) + F.lit(st["s"]) * F.col("x")).alias("fit"),
                       F.col("ci")[0].alias("ci_low"), F.col("ci")[1].alias("ci_high"))
