"""Relations between columns.

Correlation matrices are one aggregate pass with one ``corr`` buffer per
pair, returned in long form (x, y, corr). Rank correlations first turn
values into average ranks with a distinct-value table (map-side combined,
so ties and hot values cost one row each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .profile import numeric_columns
from .ranking import ranks_from_counts

MAX_PAIRS_PER_PASS = 1800  # about 60 columns; wider matrices are split into several passes


def group_mean_std(df: DataFrame, group_col, target: str, group_name: str = "group") -> DataFrame:
    """Mean and std (ddof 1) of the target per group, with mean +- std bands.

    ``group_col`` may be an expression (e.g. B9's hour bucket); rows whose
    group is null are dropped.
    """
    g = F.col(group_col) if isinstance(group_col, str) else group_col
    return (df.select(g.alias(group_name), F.col(target).cast("double").alias("_y"))
            .where(F.col(group_name).isNotNull())
            .groupBy(group_name)
            .agg(F.count("_y").alias("count"), F.avg("_y").alias("mean"), F.stddev_samp("_y").alias("std"))
            .withColumn("lower", F.col("mean") - F.col("std"))
            .withColumn("upper", F.col("mean") + F.col("std")))


def _pairs(cols: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def pearson_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long-form Pearson matrix (x, y, corr), pairwise-complete, mirrored, diagonal included.

    ``corr`` skips rows where either value is null, as pandas does.
    """
    cols = columns or numeric_columns(df)
    pairs = _pairs(cols)
    rows = []
    for start in range(0, max(len(pairs), 1), MAX_PAIRS_PER_PASS):
        chunk = pairs[start:start + MAX_PAIRS_PER_PASS]
        diag = cols if start == 0 else []
        aggs = ([F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(chunk)]
                + [F.corr(F.col(c).cast("double"), F.col(c).cast("double")).alias(f"d{i}") for i, c in enumerate(diag)])
        if not aggs:
            continue
        one = df.agg(*aggs)
        structs = []
        for i, (a, b) in enumerate(chunk):
            structs.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"p{i}").alias("corr")))
            structs.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"p{i}").alias("corr")))
        for i, c in enumerate(diag):
            structs.append(F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.col(f"d{i}").alias("corr")))
        rows.append(one.select(F.inline(F.array(*structs))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def with_index(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """Attach the column positions i (of x) and j (of y) to a long matrix."""
    pos = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    return matrix.withColumn("i", pos[F.col("x")]).withColumn("j", pos[F.col("y")])


def lower_triangle(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """C11: keep the strictly lower triangle (mask upper incl. the diagonal)."""
    return with_index(matrix, columns).where(F.col("i") > F.col("j")).drop("i", "j")


MASK_BITS = 60  # null flags of so many columns go into one long


def _rank_tables(df: DataFrame, cols: list[str], partners: list[str], broadcast_limit: int):
    """Average ranks of several columns in one pass, each among all its values and among the rows where a partner has one.

    Every row is stacked into one (column, value, which partners have a value)
    entry a column, and one map-side combined aggregate counts rows per
    (column, value): all of them, and those with each partner. That
    distinct-value table is written once to the shared folder and the number of
    distinct values per column is counted there. Ranks come from
    ``ranks_from_counts``. Returns, per column, the rank table (_v, _r, then _r0,
    _r1, ... by partner) and whether it may be broadcast: the smallest tables
    are broadcast while all their ranks stay within ``broadcast_limit``; the rest
    are shuffle-joined.
    """
    spark = df.sparkSession
    chunks = [partners[i:i + MASK_BITS] for i in range(0, len(partners), MASK_BITS)]
    masks = [sum((F.shiftleft(F.col(c).isNotNull().cast("long"), j) for j, c in enumerate(chunk)), F.lit(0)) for chunk in chunks]
    entries = [F.struct(F.lit(k).alias("_k"), F.col(c).cast("double").alias("_v"), *[m.alias(f"_m{i}") for i, m in enumerate(masks)])
               for k, c in enumerate(cols)]
    has = [F.shiftright(f"_m{j // MASK_BITS}", j % MASK_BITS).bitwiseAND(F.lit(1)) for j in range(len(partners))]
    counts = ["_n"] + [f"_n{j}" for j in range(len(partners))]
    names = ["_r"] + [f"_r{j}" for j in range(len(partners))]
    path = scratch_path(spark, "rank-values")
    (df.select(F.inline(F.array(*entries))).where(F.col("_v").isNotNull())
     .groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(h).alias(f"_n{j}") for j, h in enumerate(has)])
     .write.parquet(path))
    vals = spark.read.parquet(path)
    sizes = {r["_k"]: r["n"] for r in vals.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    ranks = ranks_from_counts(vals, "_k", "_v", counts, sizes, broadcast_limit, names)
    small, used = set(), 0
    for k in sorted(range(len(cols)), key=lambda k: sizes.get(k, 0)):
        if used + sizes.get(k, 0) * len(names) <= broadcast_limit:
            small.add(k)
            used += sizes.get(k, 0) * len(names)
    return [(ranks.where(F.col("_k") == k).select("_v", *names), k in small) for k in range(len(cols))]


def spearman_matrix(df: DataFrame, columns: list[str] | None = None, broadcast_limit: int = 1_000_000) -> DataFrame:
    """Spearman = Pearson on average ranks.

    Without nulls each column is ranked once. With nulls (checked in one
    pass), each pair is ranked among its complete rows, as pandas does: a
    value's rank there is its running count over the rows in which the other
    column has a value, so a column's distinct values carry one count for each
    column that has nulls, and rows are stacked once a column, not once a pair.
    """
    cols = columns or numeric_columns(df)
    nulls = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    partners = [c for c in cols if nulls[c]]
    tables = _rank_tables(df, cols, partners, broadcast_limit)
    r = df.select(*cols)
    for i, c in enumerate(cols):
        table, small = tables[i]
        t = table.select(F.lit(True).alias("_ok"), F.col("_v").alias("_jv"), *[F.col(x).alias(f"_{i}{x}") for x in table.columns[1:]])
        # nulls are spread by a hash of the row, so that they don't meet in one task
        r = r.withColumns({"_ok": F.col(c).isNotNull(), "_jv": F.coalesce(F.col(c).cast("double"), F.xxhash64(*cols).cast("double"))})
        r = r.join(F.broadcast(t) if small else t, ["_ok", "_jv"], "left").drop("_ok", "_jv")
    if not partners:
        return pearson_matrix(r.select(*[F.col(f"_{i}_r").alias(c) for i, c in enumerate(cols)]), cols)

    def among(i: int, other: str) -> Column:
        rank = F.col(f"_{i}_r{partners.index(other)}") if other in partners else F.col(f"_{i}_r")
        return F.when(F.col(other).isNotNull(), rank)

    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    one = r.agg(*[F.corr(among(i, cols[j]), among(j, cols[i])).alias(f"c{i}_{j}") for i, j in pairs])
    both = lambda i, j: [(i, j), (j, i)] if i != j else [(i, j)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(cols[x]).alias("x"), F.lit(cols[y]).alias("y"), F.col(f"c{i}_{j}").alias("corr"))
                                         for i, j in pairs for x, y in both(i, j)])))


# --------------------------------------------------------------------------------------
# Kendall tau-b on collapsed cells
# --------------------------------------------------------------------------------------
def _levels(df: DataFrame, col: str, max_levels: int) -> tuple[DataFrame, int] | None:
    """Dense 0-based codes of ``col`` and their number when it has at most
    ``max_levels`` distinct values (checked), else None."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    k = d.limit(max_levels + 1).count()
    if k > max_levels:
        return None
    # bounded (<= max_levels rows): a single-partition window is fine here
    return d.withColumn(f"_c_{col}", (F.row_number().over(Window.orderBy(col)) - 1).cast("int")), k


def kendall_pair(df: DataFrame, x: str, y: str, max_levels: int = 2048, levels: dict | None = None,
                 **exact_kw) -> DataFrame:
    """Exact Kendall tau-b of two columns, one row (x, y, corr, exact).

    Low-cardinality columns (at most ``max_levels`` distinct values each):
    rows collapse to cells (code_x = i, code_y = j, count c) with a
    map-side combined aggregate. With P(i, j) = #rows with i' <= i and
    j' <= j, every cell gets its concordant partners A = #(i' < i, j' < j)
    and discordant partners D = #(i' < i, j' > j) from prefix sums over the
    code grid, so S = n_c - n_d = sum c * (A - D) needs no pairs of rows or
    cells; every window partition (one grid row or column) holds at most
    max_levels entries. Otherwise the exact divide-and-conquer of
    ``kendall.kendall_s`` is used.
    """
    base = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    levels = levels if levels is not None else {}
    lx = levels[x] if x in levels else _levels(base, x, max_levels)
    ly = levels[y] if y in levels else _levels(base, y, max_levels)
    if lx is None or ly is None:
        from .kendall import kendall_tau_b
        tau = kendall_tau_b(base, x, y, **exact_kw)
        return df.sparkSession.createDataFrame([(x, y, tau, True)], "x string, y string, corr double, exact boolean")
    (lx, kx), (ly, ky) = lx, ly
    # inner joins drop rows whose value is not a level (levels from other rows than ``base``)
    bxy = base.join(F.broadcast(lx), x).join(F.broadcast(ly), y)
    cells = bxy.groupBy(F.col(f"_c_{x}").alias("i"), F.col(f"_c_{y}").alias("j")).agg(
        F.count(F.lit(1)).alias("c"))
    mj = ky - 1  # codes run over 0..k-1; unoccupied rows/columns add nothing
    # every occupied grid row gets all levels 0..mj (bounded by max_levels)
    grid = (cells.select("i").distinct()
            .select("i", F.explode(F.sequence(F.lit(0), F.lit(mj))).alias("j"))
            .join(cells, ["i", "j"], "left").fillna(0, ["c"]))
    by_i = Window.partitionBy("i").orderBy("j")
    by_j = Window.partitionBy("j").orderBy("i")
    g = grid.withColumn("rp", F.sum("c").over(by_i.rowsBetween(Window.unboundedPreceding, 0)))
    g = g.withColumn("P", F.sum("rp").over(by_j.rowsBetween(Window.unboundedPreceding, 0)))
    g = g.withColumn("ct", F.sum("c").over(Window.partitionBy("j")))                 # column total
    g = g.withColumn("last_i", F.max("i").over(Window.partitionBy("j")))             # last occupied row
    g = g.withColumn("Pprev", F.coalesce(F.lag("P").over(by_j), F.lit(0)))          # #(i'<i, j'<=j)
    g = (g.withColumn("A", F.coalesce(F.lag("Pprev").over(by_i), F.lit(0)))         # #(i'<i, j'<j)
         .withColumn("T", F.last("Pprev").over(by_i.rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing))))  # #(i'<i)
    one = g.agg(
        F.sum("c").alias("n"),
        F.sum(F.when(F.col("c") > 0, F.col("c") * (F.col("A") - (F.col("T") - F.col("Pprev"))))).alias("S"),
        F.sum(F.when(F.col("j") == mj, F.col("rp") * (F.col("rp") - 1) / 2)).alias("n1"),   # ties in x
        F.sum(F.when(F.col("i") == F.col("last_i"), F.col("ct") * (F.col("ct") - 1) / 2)).alias("n2"))  # ties in y
    n0 = F.col("n") * (F.col("n") - 1) / 2.0
    return one.select(
        F.lit(x).alias("x"), F.lit(y).alias("y"),
        (F.col("S") / F.sqrt((n0 - F.col("n1")) * (n0 - F.col("n2")))).alias("corr"),
        F.lit(True).alias("exact"))


def kendall_matrix(df: DataFrame, columns: list[str] | None = None, **kw) -> DataFrame:
    """C10 as a long matrix (x, y, corr, exact), mirrored with a unit diagonal."""
    cols = columns or numeric_columns(df)
    parts = []
    # levels per column once; a pair's own null pattern is handled by the inner joins
    mx = kw.get("max_levels", 2048)
    levels = {c: _levels(df.select(c), c, mx) for c in cols}
    for a, b in _pairs(cols):
        p = kendall_pair(df, a, b, levels=levels, **kw)
        parts.append(p)
        parts.append(p.select(F.col("y").alias("x"), F.col("x").alias("y"), "corr", "exact"))
    spark = df.sparkSession
    parts.append(spark.createDataFrame([(c, c, 1.0, True) for c in cols], "x string, y string, corr double, exact boolean"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def target_correlations(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """corr(feature, target) for each numeric feature, self dropped; sort by value desc."""
    types = dict(df.dtypes)
    if types.get(target) not in ("double", "float", "int", "bigint", "smallint", "tinyint") \
            and not str(types.get(target, "")).startswith("decimal"):
        return df.sparkSession.createDataFrame([], "feature string, corr double")
    cols = [c for c in (columns or numeric_columns(df)) if c != target]
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr"))
                                         for i, c in enumerate(cols)])))


def regression_line(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Least-squares line of target on one feature (slope, intercept, n)."""
    x, y = F.col(feature).cast("double"), F.col(target).cast("double")
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_count(y, x).alias("n"))
