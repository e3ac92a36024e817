"""Sorts, top-k, sampling and global positions.

``global_rank`` is the core: the position of every row in the order
(key, id) without a window over the whole table. A bare
``row_number() over (order by key)`` moves every row into one partition;
here rows are cut into range buckets of bounded size, each bucket is
numbered on its own, and a running offset over the (small) bucket table
is added back.

Skew: a key value that holds a large share of the rows shows up as a
repeated edge in the approximate quantiles. Rows equal to such a value
are split further by that value's own id quantiles, so no bucket holds more
than about n / n_buckets rows even when one key holds a third of the table,
and there are at most about 3 x n_buckets buckets.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import uniform

MAX_BUCKETS = 4096


def default_buckets(spark: SparkSession) -> int:
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(MAX_BUCKETS, 4 * n))


def _splits(edges: list) -> list[float]:
    uniq = sorted({float(e) for e in edges if e is not None})
    return [float("-inf")] + uniq + [float("inf")]


def _bucketize(df: DataFrame, col: str, splits: list[float], out: str) -> DataFrame:
    tmp = f"{out}__d"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(col).cast("double"))).drop(tmp)


def _bucket_columns(df: DataFrame, key: str, id_col: str, n_buckets: int, key_is_uniform: bool,
                    accuracy: int | None = None) -> DataFrame:
    """Adds ``_maj`` and ``_min``: (``_maj``, ``_min``) is monotone in (key, id)."""
    if key_is_uniform:
        # key is a [0,1) draw: equal-width buckets are already balanced.
        maj = F.when(F.col(key).isNull(), F.lit(n_buckets)).otherwise(
            F.least(F.floor(F.col(key) * n_buckets), F.lit(n_buckets - 1))).cast("int")
        return df.withColumns({"_maj": maj, "_min": F.lit(0)})
    fr = [i / n_buckets for i in range(1, n_buckets)]
    acc = accuracy or max(10000, 20 * n_buckets)
    row = df.agg(F.percentile_approx(F.col(key), fr, acc).alias("ke"),
                 F.percentile_approx(F.col(id_col).cast("double"), fr, acc).alias("ie")).first()
    kedges = [e for e in (row["ke"] or []) if e is not None]  # of the key's own type
    iedges = [e for e in (row["ie"] or []) if e is not None]
    ksplits = _splits(kedges)
    # an edge repeated in the quantiles holds more than 1/n_buckets of the rows
    heavy = sorted({e for e in kedges if kedges.count(e) > 1})
    out = _bucketize(df, key, ksplits, "_kb")
    out = _bucketize(out, id_col, _splits(iedges), "_ib")
    lower = F.element_at(F.array(*[F.lit(s) for s in ksplits]), F.col("_kb").cast("int") + 1)
    kd = F.col(key).cast("double")
    # rows at an edge: keys that differ may share a double, so heavy keys are compared in their
    # own type; a heavy key's rows are split by id, the keys between two heavy ones stay together
    step = 1
    if heavy:
        listed = F.array(*[F.lit(h).cast(df.schema[key].dataType) for h in heavy])
        cuts = _id_edges(df, key, id_col, listed, [kedges.count(h) for h in heavy], acc)
        step = max(len(c) for c in cuts) + 2
        own = F.get(F.from_json(F.lit(json.dumps(cuts)), "array<array<double>>"), F.col("_below"))
        out = out.withColumn("_below", _count_up_to(listed, len(heavy), lambda h: h < F.col(key)))
        place = _count_up_to(own, step, lambda e: e <= F.col(id_col).cast("double"))
        tie_minor = F.col("_below") * step + F.when(F.get(listed, F.col("_below")) == F.col(key), place + 1).otherwise(F.lit(0))
    else:
        tie_minor = F.lit(0)
    null_maj = F.lit(len(ksplits))
    maj = F.when(F.col(key).isNull(), null_maj).otherwise(F.col("_kb").cast("int"))
    minor = (F.when(F.col(key).isNull(), F.col("_ib").cast("int"))
             .when(kd == lower, tie_minor)
             .otherwise(F.lit((len(heavy) + 1) * step)))
    return out.withColumns({"_maj": maj, "_min": minor}).drop("_kb", "_ib", "_below")


def _id_edges(df: DataFrame, key: str, id_col: str, listed: Column, repeats: list[int], accuracy: int) -> list[list[float]]:
    """For each heavy key its own id edges: as many parts as the quantiles repeat it, rounded up to a power of two.

    All parts together are at most twice the number of quantiles, however the
    ids of a key lie among all ids. One aggregate over the heavy keys' rows.
    """
    parts = [1 << (n - 1).bit_length() for n in repeats]
    d = df.withColumn("_at", F.array_position(listed, F.col(key))).where(F.col("_at") > 0)
    mine = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("_at").cast("int"))
    edges = [F.percentile_approx(F.when(mine == p, F.col(id_col).cast("double")), [i / p for i in range(1, p)], accuracy)
             for p in sorted(set(parts))]
    rows = d.groupBy("_at").agg(F.coalesce(*edges).alias("_e")).collect()  # one row a heavy key
    found = {r["_at"]: sorted({e for e in r["_e"] or [] if e is not None}) for r in rows}
    return [found.get(i + 1, []) for i in range(len(parts))]


def _count_up_to(ascending: Column, size: int, holds) -> Column:
    """Number of leading elements of an ascending array (of at most ``size``) for which ``holds``, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, size).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, by: F.when(F.coalesce(holds(F.get(ascending, at + by - 1)), F.lit(False)), at + by).otherwise(at))


def global_rank(df: DataFrame, key: str, id_col: str, out: str = "rank", n_buckets: int | None = None,
                key_is_uniform: bool = False, descending: bool = False,
                partition_by: list[str] | None = None) -> DataFrame:
    """1-based position of each row in the order (key, id); nulls last.

    With ``partition_by`` the position restarts in every group, and a group
    holding a third of the rows is still spread over all its buckets.

    Jobs: one approximate-quantile pass (skipped for uniform keys), one
    count per bucket (map-side combined), one shuffle by bucket. The
    offset table has at most about 4 x n_buckets rows (times the number of
    groups) and is broadcast only without groups; with groups it is joined
    on (group, bucket).
    """
    spark = df.sparkSession
    nb = n_buckets or default_buckets(spark)
    src = df
    k = key
    if descending:
        k = "_negkey"
        src = df.withColumn(k, -F.col(key))
    b = _bucket_columns(src, k, id_col, nb, key_is_uniform)
    g = list(partition_by or [])
    counts = b.groupBy(*g, "_maj", "_min").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*g).orderBy("_maj", "_min").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, "_maj", "_min", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    wi = Window.partitionBy(*g, "_maj", "_min").orderBy(F.col(k).asc_nulls_last(), F.col(id_col))
    res = (b.join(offsets if g else F.broadcast(offsets), [*g, "_maj", "_min"])
           .withColumn(out, (F.row_number().over(wi) + F.col("_off")).cast("bigint"))
           .drop("_maj", "_min", "_off"))
    if descending:
        res = res.drop(k)
    return res


def position_cuts(df: DataFrame, key: str, id_col: str, starts, n_buckets: int | None = None,
                  key_is_uniform: bool = False) -> tuple[int, dict]:
    """The rows at given 1-based positions of the order (key, id), nulls last,
    without numbering every row.

    ``starts`` maps the row count n to the positions wanted. Rows are cut
    into the same bounded buckets as ``global_rank``; the bucket table
    (counts, running offsets) stays on the cluster and only the buckets
    holding a wanted position (at most one per position, each about
    n / n_buckets rows) are numbered. Returns (n, {position: (key, id, before)})
    where ``before`` counts the rows equal to (key, id) that precede the
    position (0 unless (key, id) is repeated).
    """
    spark = df.sparkSession
    nb = n_buckets or default_buckets(spark)
    b = _bucket_columns(df.select(key, id_col), key, id_col, nb, key_is_uniform)
    counts = b.groupBy("_maj", "_min").agg(F.count(F.lit(1)).alias("_cnt")).persist()
    try:
        n = int(counts.agg(F.sum("_cnt")).first()[0] or 0)
        pos = sorted({int(p) for p in starts(n) if 1 <= p <= n})
        if not pos:
            return n, {}
        # the bucket table is an aggregate (about n_buckets rows): one ordered window over it
        w = Window.orderBy("_maj", "_min").rowsBetween(Window.unboundedPreceding, -1)
        offs = counts.select("_maj", "_min", "_cnt", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
        wanted = F.array(*[F.lit(p) for p in pos])
        targets = offs.where(F.exists(wanted, lambda p: (p > F.col("_off")) & (p <= F.col("_off") + F.col("_cnt"))))
        tgt = [(r["_maj"], r["_min"], r["_off"]) for r in targets.select("_maj", "_min", "_off").collect()]
    finally:
        counts.unpersist()
    tdf = spark.createDataFrame(tgt, "_maj int, _min int, _off long")  # at most len(pos) rows
    wi = Window.partitionBy("_maj", "_min").orderBy(F.col(key).asc_nulls_last(), F.col(id_col))
    sel = (b.join(F.broadcast(tdf), ["_maj", "_min"])
           .withColumn("_pos", F.row_number().over(wi) + F.col("_off"))
           .withColumn("_before", F.row_number().over(wi) - F.rank().over(wi))
           .where(F.col("_pos").isin(pos)).select("_pos", key, id_col, "_before").collect())  # len(pos) rows
    return n, {r["_pos"]: (r[key], r[id_col], r["_before"]) for r in sel}


def cut_index(key: str, id_col: str, cuts: list[tuple], tie_col: str = "_tn") -> Column:
    """Number of cut rows (key, id) at or before each row in the order (key, id), nulls last.

    A row's segment, fold or split label then follows from one projection.
    A cut (key, id, before) with ``before`` > 0 falls inside a run of equal
    (key, id) rows: those rows carry their 0-based number in the run in
    ``tie_col`` and the first ``before`` of them stay before the cut.
    """
    k, i = F.col(key), F.col(id_col)
    terms = []
    for ck, cid, before in cuts:
        same = (k.isNull() if ck is None else (k == F.lit(ck))) & (i == F.lit(cid))
        after = (i > F.lit(cid)) if ck is None else ((k > F.lit(ck)) | ((k == F.lit(ck)) & (i > F.lit(cid))))
        if ck is not None:
            after = k.isNull() | after
        else:
            after = k.isNull() & after
        at = same if not before else same & (F.col(tie_col) >= F.lit(before))
        terms.append((after | at).cast("int"))
    out = F.lit(0)
    for t in terms:
        out = out + t
    return out


def label_by_position(df: DataFrame, key: str, id_col: str, starts, out: str,
                      key_is_uniform: bool = False) -> tuple[int, DataFrame]:
    """Adds ``out`` = number of ``starts(n)`` positions at or before the row's position.

    Positions may repeat (an empty segment) or exceed n (never reached).
    Rows only move when a cut falls inside a run of repeated (key, id)
    (an id that is not unique): the rows of such runs, and only those, are
    numbered by a hash of their content, so that labels don't depend on the
    layout of the input.
    """
    n, cuts = position_cuts(df, key, id_col, starts, key_is_uniform=key_is_uniform)
    marks = [cuts[p] for p in sorted(int(p) for p in starts(n)) if p in cuts]
    runs = {(ck, cid) for ck, cid, before in marks if before}
    if not runs:
        return n, df.withColumn(out, cut_index(key, id_col, marks))
    k, i = F.col(key), F.col(id_col)
    in_run = F.lit(False)
    for ck, cid in runs:
        in_run = in_run | (k.eqNullSafe(F.lit(ck)) & (i == F.lit(cid)))
    w = Window.partitionBy(key, id_col).orderBy("_mid")
    src = df.withColumn("_mid", F.xxhash64(*df.columns))
    tied = src.where(in_run).withColumn("_tn", F.row_number().over(w) - 1).drop("_mid")
    rest = src.where(~in_run).drop("_mid").withColumn("_tn", F.lit(None).cast("int"))
    both = rest.unionByName(tied)
    return n, both.withColumn(out, cut_index(key, id_col, marks)).drop("_tn")


def label_by_group_positions(df: DataFrame, group: str, key: str, id_col: str, starts: DataFrame, out: str,
                             key_is_uniform: bool = False) -> DataFrame | None:
    """Per group, adds ``out`` = number of the group's start positions at or
    before the row's position in the order (key, id); the key has no nulls.

    ``starts`` has one row per group (the caller bounds their number): the
    group and one column per 1-based start position (null or beyond the
    group's size: never reached). Like ``position_cuts``, only the buckets
    holding a start are numbered; the cut rows (at most groups x starts)
    come back to the driver and are broadcast back as a per-group table,
    and rows are labelled by comparison, so no row is shuffled. Returns
    None when a start falls inside a run of repeated (key, id), for the
    caller to number rows instead.
    """
    spark = df.sparkSession
    nb = default_buckets(spark)
    scols = [c for c in starts.columns if c != group]
    b = _bucket_columns(df.select(group, key, id_col), key, id_col, nb, key_is_uniform)
    counts = b.groupBy(group, "_maj", "_min").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(group).orderBy("_maj", "_min").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(group, "_maj", "_min", "_cnt", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    st = starts.select(group, F.inline(F.array(*[F.struct(F.lit(j).alias("_j"), F.col(c).cast("long").alias("_p"))
                                                 for j, c in enumerate(scols)])))
    tg = (offs.join(F.broadcast(st), group)
          .where((F.col("_p") > F.col("_off")) & (F.col("_p") <= F.col("_off") + F.col("_cnt"))))
    tgt = tg.select(group, "_maj", "_min", "_off", "_j", "_p").collect()  # at most groups x starts rows
    tdf = spark.createDataFrame(tgt, tg.select(group, "_maj", "_min", "_off", "_j", "_p").schema)
    wi = Window.partitionBy(group, "_maj", "_min").orderBy(F.col(key), F.col(id_col))
    sel = (b.join(F.broadcast(tdf.select(group, "_maj", "_min", "_off").distinct()), [group, "_maj", "_min"])
           .withColumn("_pos", F.row_number().over(wi) + F.col("_off"))
           .withColumn("_before", F.row_number().over(wi) - F.rank().over(wi))
           .join(F.broadcast(tdf.select(group, "_maj", "_min", "_j", "_p")), [group, "_maj", "_min"])
           .where(F.col("_pos") == F.col("_p"))
           .select(group, "_j", key, id_col, "_before").collect())  # at most groups x starts rows
    if any(r["_before"] for r in sel):
        return None
    per: dict = {}
    for r in sel:
        per.setdefault(r[group], {})[r["_j"]] = (r[key], r[id_col])
    gtype = starts.schema[group].dataType.simpleString()
    ktype = df.schema[key].dataType.simpleString()
    itype = df.schema[id_col].dataType.simpleString()
    cut_rows = [(g, *[x for j in range(len(scols)) for x in per[g].get(j, (None, None))]) for g in per]
    cut_schema = ", ".join([f"`{group}` {gtype}"] + [f"_k{j} {ktype}, _i{j} {itype}" for j in range(len(scols))])
    cuts = spark.createDataFrame(cut_rows, cut_schema)  # one row per group with a cut
    k, i = F.col(key), F.col(id_col)
    lab = F.lit(0)
    for j in range(len(scols)):
        ge = (k > F.col(f"_k{j}")) | ((k == F.col(f"_k{j}")) & (i >= F.col(f"_i{j}")))
        lab = lab + F.coalesce(ge.cast("int"), F.lit(0))
    res = df.join(F.broadcast(cuts), group, "left").withColumn(out, lab)
    return res.drop(*[f"_k{j}" for j in range(len(scols))], *[f"_i{j}" for j in range(len(scols))])


def qcut_starts(n: int, k: int) -> list[int]:
    """1-based first positions of segments 2..k of ``qcut_segment`` (repeated when a segment is empty)."""
    if n <= 1:
        return []
    return [-(-((s - 1) * (n - 1) + 1) // k) + 1 for s in range(2, k + 1)]


def qcut_rows(df: DataFrame, key: str, id_col: str, k: int, out: str = "segment") -> DataFrame:
    """D7 over rows: equal-count segment (1..k) of each row in the order (key, id)."""
    _, lab = label_by_position(df, key, id_col, lambda n: qcut_starts(n, k), "_cut")
    return lab.withColumn(out, (F.col("_cut") + 1).cast("int")).drop("_cut")


def running_before(df: DataFrame, key: str, weight: str, out: str = "before",
                   n_buckets: int | None = None) -> DataFrame:
    """Sum of ``weight`` over all rows with a smaller ``key``; ``key`` must be unique.

    Used on a distinct-value table (value, count) to get the number of rows
    below each value, e.g. for average ranks with ties.
    """
    spark = df.sparkSession
    nb = n_buckets or default_buckets(spark)
    b = _bucket_columns(df, key, key, nb, False)
    sums = b.groupBy("_maj", "_min").agg(F.sum(weight).alias("_s"))
    w = Window.orderBy("_maj", "_min").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_maj", "_min", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_off"))
    wi = (Window.partitionBy("_maj", "_min").orderBy(F.col(key).asc_nulls_last())
          .rowsBetween(Window.unboundedPreceding, -1))
    return (b.join(F.broadcast(offsets), ["_maj", "_min"])
            .withColumn(out, F.coalesce(F.sum(weight).over(wi), F.lit(0)) + F.col("_off"))
            .drop("_maj", "_min", "_off"))


def running_sums_before(df: DataFrame, group: str, key: str, weights: list[str]) -> DataFrame:
    """For a table unique in (group, key): per row, the sums of ``weights`` over rows of
    the same group with a smaller key. Buckets come from global quantile edges of the
    key, so no window holds a whole group; bucket offsets are per (group, bucket)."""
    nb = default_buckets(df.sparkSession)
    b = _bucket_columns(df, key, key, nb, False)
    sums = b.groupBy(group, "_maj", "_min").agg(*[F.sum(w).alias(f"_s_{w}") for w in weights])
    wo = Window.partitionBy(group).orderBy("_maj", "_min").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(group, "_maj", "_min",
                       *[F.coalesce(F.sum(f"_s_{w}").over(wo), F.lit(0)).alias(f"_o_{w}") for w in weights])
    wi = Window.partitionBy(group, "_maj", "_min").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = b.join(offs, [group, "_maj", "_min"])
    return out.select(*df.columns, *[(F.coalesce(F.sum(w).over(wi), F.lit(0)) + F.col(f"_o_{w}")).alias(f"before_{w}")
                                     for w in weights])


def average_rank(df: DataFrame, col: str, out: str, broadcast_limit: int = 1_000_000) -> DataFrame:
    """1-based average rank of ``col`` (ties share the mean of their positions).

    Rows are first collapsed to (value, count) with a map-side combined
    aggregate, so a value held by a third of the rows is one row here.
    When the number of distinct values is at most ``broadcast_limit``
    (checked), that table is ranked with one window and broadcast back;
    otherwise it is ranked with ``running_before`` (bucketed, no
    single-partition window) and joined back with a shuffle join where
    AQE splits a skewed value.
    """
    vals = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_vc"))
    small = vals.limit(broadcast_limit + 1).count() <= broadcast_limit
    if small:
        # the distinct-value table is checked to be small: one ordered window over it
        w = Window.orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
        ranks = vals.select(col, (F.coalesce(F.sum("_vc").over(w), F.lit(0)) + (F.col("_vc") + 1) / 2.0).alias(out))
        return df.join(F.broadcast(ranks), on=col, how="left")
    ranked = running_before(vals, col, "_vc", "_below")
    ranks = ranked.select(col, (F.col("_below") + (F.col("_vc") + 1) / 2.0).alias(out))
    return df.join(ranks, on=col, how="left")


def ranks_from_counts(vals: DataFrame, group: str, value: str, counts: list[str], sizes: dict,
                      window_limit: int = 1_000_000, out: list[str] | None = None) -> DataFrame:
    """Average rank of every distinct value within its group, from a table
    unique in (group, value) with one or more numbers of rows ``counts`` of each
    (one rank column ``out`` for each of them).

    ``sizes`` holds the number of distinct values per group (counted by the
    caller). Groups with at most ``window_limit`` of them are ranked with one
    window per group (a bounded partition); larger groups use
    ``running_sums_before`` (global bucket edges, no window holds a whole
    group). Returns (group, value, out).
    """
    small = [g for g, n in sizes.items() if n <= window_limit]
    big = [g for g, n in sizes.items() if n > window_limit]
    out = out or [f"rank_{c}" for c in counts]
    half = lambda c: (F.col(c) + 1) / 2.0
    parts = []
    if big:
        run = running_sums_before(vals.where(F.col(group).isin(big)), group, value, counts)
        parts.append(run.select(group, value, *[(F.col(f"before_{c}") + half(c)).alias(o) for c, o in zip(counts, out)]))
    if small or not big:
        w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        parts.append(vals.where(F.col(group).isin(small)).select(
            group, value, *[(F.coalesce(F.sum(c).over(w), F.lit(0)) + half(c)).alias(o) for c, o in zip(counts, out)]))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def qcut_segment(pos0: Column, n: Column, k: int) -> Column:
    """Equal-count segment (1..k) of 0-based position ``pos0`` among ``n`` rows.

    Right-closed linear quantile edges of the positions 0..n-1, as in a
    quantile cut of a row index; ``ntile`` splits differently. n = 1 -> 1.
    """
    return F.when(n <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor((pos0 * k + n - 2) / (n - 1)).cast("int"))).cast("int")


def sort_by(df: DataFrame, key: str, ascending: bool = True, tiebreak: str | None = None) -> DataFrame:
    """Sort by one key with a tie-break so the order is total."""
    k = F.col(key).asc_nulls_last() if ascending else F.col(key).desc_nulls_last()
    return df.orderBy(k, *([F.col(tiebreak)] if tiebreak else []))


def top_n_abs(df: DataFrame, col: str, n: int, tiebreak: str) -> DataFrame:
    """D3: n rows with the largest |col| (a top-k: TakeOrderedAndProject, no full sort)."""
    return df.orderBy(F.abs(F.col(col)).desc_nulls_last(), F.col(tiebreak)).limit(n)


def sample_rows(df: DataFrame, k: int, seed: int, id_col: str) -> DataFrame:
    """A repeatable sample of up to k rows (top-k on an md5 draw)."""
    u = uniform(id_col, seed, "sample")
    return df.withColumn("_u", u).orderBy("_u", id_col).limit(k).drop("_u")


def best_by(df: DataFrame, metric: str, name_col: str = "model", largest: bool = False) -> DataFrame:
    """Row of the best model (smallest metric unless ``largest``)."""
    o = F.col(metric).desc_nulls_last() if largest else F.col(metric).asc_nulls_last()
    return df.orderBy(o, F.col(name_col)).limit(1)
