"""Fit/transform preparation operators.

Each fit is ONE aggregate pass returning a driver-sized parameter table
(one row per column); each transform is a projection with those
parameters as literals, so Catalyst collapses a chain of transforms into
a single codegen'd projection over the scan.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalars import uniform
from .profile import numeric_columns, string_columns
from .quantiles import quantiles
from .ranking import global_rank, label_by_group_positions, label_by_position

# --------------------------------------------------------------------------------------
# Simple imputation
# --------------------------------------------------------------------------------------
STRATEGIES = {"mean", "median", "most_frequent", "mode", "constant"}


@dataclass
class ImputerModel:
    values: dict[str, object]            # column -> fill value
    as_double: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, v in self.values.items():
            col = F.col(c).cast("double") if c in self.as_double else F.col(c)
            out[c] = F.coalesce(col, F.lit(v).cast("double" if c in self.as_double else dict(df.dtypes)[c]))
        return df.withColumns(out) if out else df

    def params(self, spark) -> DataFrame:
        rows = [(c, None if v is None else str(v)) for c, v in self.values.items()]
        return spark.createDataFrame(rows, "column string, value string")


def columns_with_nulls(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    cols = columns or df.columns
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"n{i}"]]


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-null value per column, smallest value on ties.

    All columns are stacked and counted in ONE grouped aggregate (partial
    aggregation; no per-value map held in one task), then the top count
    per column and the smallest value at that count are two small
    aggregates over the count table.
    """
    if not columns:
        return {}
    types = dict(df.dtypes)
    numeric = {c for c in columns if isinstance(df.schema[c].dataType, NumericType)}
    st = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
                 F.col(c).cast("string").alias("txt")) for c in columns])))
    counts = st.where(F.col("txt").isNotNull()).groupBy("column", "num", "txt").agg(F.count(F.lit(1)).alias("cnt"))
    top = counts.groupBy("column").agg(F.max("cnt").alias("top"))
    best = (counts.join(F.broadcast(top), "column").where(F.col("cnt") == F.col("top"))
            .groupBy("column").agg(F.min("num").alias("num"), F.min("txt").alias("txt"),
                                   F.min_by("txt", F.col("txt").try_cast("decimal(38,10)")).alias("exact")))
    out = {}
    for r in best.collect():  # one row per column
        c = r["column"]
        if c in numeric:
            whole = types[c] in ("int", "bigint", "smallint", "tinyint") or types[c].startswith("decimal")
            out[c] = decimal.Decimal(r["exact"]) if types[c].startswith("decimal") else int(r["exact"]) if whole else r["num"]
        else:
            out[c] = r["txt"]
    for c in columns:
        out.setdefault(c, None)
    return out


def fit_imputer(df: DataFrame, strategy: str = "mean", columns: list[str] | None = None,
                fill_value=0, exclude: tuple[str, ...] = ()) -> ImputerModel:
    """E1 fit. Default columns: those with any null. Non-numeric columns always use
    the most frequent value. mean/median turn the column into double."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown imputation strategy {strategy!r}")
    strategy = "most_frequent" if strategy == "mode" else strategy
    cols = [c for c in (columns or columns_with_nulls(df)) if c not in exclude]
    num = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
    cat = [c for c in cols if c not in num]
    values: dict[str, object] = {}
    as_double: list[str] = []
    if strategy == "mean" and num:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(num)]).first()
        values.update({c: row[f"v{i}"] for i, c in enumerate(num)})
        as_double = list(num)
    elif strategy == "median" and num:
        med = quantiles(df, num, [0.5])
        values.update({c: med[c][0] for c in num})
        as_double = list(num)
    elif strategy == "constant":
        values.update({c: fill_value for c in num})
    # one stacked count serves the numeric columns (most_frequent) and every categorical column
    values.update(most_frequent(df, (num if strategy == "most_frequent" else []) + cat))
    return ImputerModel(values, as_double)


def impute(df: DataFrame, strategy: str = "mean", columns: list[str] | None = None, fill_value=0,
           exclude: tuple[str, ...] = ()) -> DataFrame:
    """Fit on ``df`` and fill it."""
    return fit_imputer(df, strategy, columns, fill_value, exclude).transform(df)


# --------------------------------------------------------------------------------------
# scaling
# --------------------------------------------------------------------------------------
@dataclass
class ScalerModel:
    method: str
    params: dict[str, tuple[float, float]]  # column -> (center, scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(center)) / F.lit(scale)
                               for c, (center, scale) in self.params.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c) * F.lit(scale) + F.lit(center)
                               for c, (center, scale) in self.params.items()})

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(a), float(b)) for c, (a, b) in self.params.items()],
                                     "column string, center double, scale double")


def fit_scaler(df: DataFrame, method: str = "standard", columns: list[str] | None = None,
               exclude: tuple[str, ...] = ()) -> ScalerModel:
    """E3 standard (ddof 0, zero std -> 1), E4 min-max (zero range -> 1),
    E5 robust (median, IQR; zero IQR -> 1). Nulls are skipped in the fit
    and stay null."""
    if method not in ("standard", "minmax", "robust"):
        raise ValueError(f"Unknown scaling method: {method}")
    num = set(numeric_columns(df))
    cols = [c for c in (columns or numeric_columns(df)) if c in num and c not in exclude]
    if not cols:
        return ScalerModel(method, {})
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if method == "standard":
            aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"b{i}")]
        elif method == "minmax":
            aggs += [F.min(x).alias(f"a{i}"), (F.max(x) - F.min(x)).alias(f"b{i}")]
    row = df.agg(*aggs).first() if aggs else None
    qs = quantiles(df, cols, [0.25, 0.5, 0.75]) if method == "robust" else {}
    params = {}
    for i, c in enumerate(cols):
        if method == "robust":
            q = qs[c]
            center, scale = q[1], (None if q[0] is None else q[2] - q[0])
        else:
            center, scale = row[f"a{i}"], row[f"b{i}"]
        center = 0.0 if center is None else float(center)
        scale = 1.0 if (scale is None or scale == 0 or math.isnan(scale)) else float(scale)
        params[c] = (center, scale)
    return ScalerModel(method, params)


def scale(df: DataFrame, method: str = "standard", columns: list[str] | None = None,
          exclude: tuple[str, ...] = ()) -> tuple[DataFrame, ScalerModel]:
    m = fit_scaler(df, method, columns, exclude)
    return m.transform(df), m


# --------------------------------------------------------------------------------------
# Categorical encoding
# --------------------------------------------------------------------------------------
#: Levels up to which a column's codes are literals in the plan; beyond it they are a table in the shared folder.
MAX_LITERAL_LEVELS = 1000
#: Levels up to which a code table is broadcast (counted when it is made); beyond it rows are joined by a shuffle.
MAX_BROADCAST_LEVELS = 100_000


@dataclass
class EncoderModel:
    """Sorted levels of each column (``levels``), or for columns of many levels the path and size of their code table (``tables``)."""

    method: str
    levels: dict[str, list[str]]
    tables: dict[str, tuple[str, int]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.method == "one_hot":
            keep = [c for c in df.columns if c not in self.levels]
            dummies = []
            for c, lv in self.levels.items():
                for level in lv[1:]:  # the first sorted level is dropped
                    dummies.append(F.coalesce((F.col(c) == F.lit(level)).cast("int"), F.lit(0))
                                   .alias(f"{c}_{level}"))
            return df.select(*keep, *dummies)
        out = {}
        for c, lv in self.levels.items():
            codes = F.create_map(*[x for i, level in enumerate(lv) for x in (F.lit(level), F.lit(i))])
            out[c] = F.element_at(codes, F.col(c).cast("string")) if lv else F.lit(None).cast("int")
        order = df.columns
        for i, (c, (path, n)) in enumerate(self.tables.items()):
            codes = df.sparkSession.read.parquet(path).select(F.col("level").alias(f"_level{i}"), F.col("code").alias(f"_code{i}"))
            df = df.join(F.broadcast(codes) if n <= MAX_BROADCAST_LEVELS else codes, F.col(c).cast("string") == F.col(f"_level{i}"), "left").drop(f"_level{i}")
            out[c] = F.col(f"_code{i}")
        if self.method == "label":
            out = {c: F.coalesce(code, F.lit(-1)) for c, code in out.items()}
        return df.withColumns({c: code.cast("int") for c, code in out.items()}).select(*order)


def fit_encoder(df: DataFrame, method: str = "one_hot", columns: list[str] | None = None,
                max_levels: int = MAX_LITERAL_LEVELS) -> EncoderModel:
    """E8 fit: sorted distinct non-null levels per column.

    Label and ordinal codes take any number of levels: beyond ``max_levels``
    the distinct levels are numbered in range-sorted order (``dense_codes``)
    and kept as a table, which transforms join back. One column a level stops
    at ``max_levels``; ``fit_one_hot_vector`` makes one sparse vector instead.
    """
    if method not in ("one_hot", "label", "ordinal"):
        raise ValueError(f"unknown encoding method {method!r}")
    cols = columns if columns is not None else string_columns(df)
    levels, tables = {}, {}
    for c in cols:
        distinct = df.select(F.col(c).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
        vals = distinct.limit(max_levels + 1).collect()
        if len(vals) <= max_levels:
            levels[c] = sorted(r["v"] for r in vals)
        elif method == "one_hot":
            raise ValueError(f"column {c!r} has more than {max_levels} levels; use fit_one_hot_vector")
        else:
            tables[c] = dense_codes(distinct)
    return EncoderModel(method, levels, tables)


def dense_codes(levels: DataFrame) -> tuple[str, int]:
    """Path and size of a table (level, code) with the distinct values of ``v`` numbered from 0 in sorted order.

    Values are sorted in ranges; each range starts where the ones before it
    end, by a count a range, so no task and not the driver holds all levels.
    """
    from ..session import scratch_path
    spark = levels.sparkSession
    path = scratch_path(spark, "levels")
    at = F.monotonically_increasing_id()
    levels.repartitionByRange(F.col("v")).sortWithinPartitions("v").withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)).write.parquet(path)
    rows = spark.read.parquet(path)
    parts = rows.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    offsets = parts.withColumn("_before", before)
    codes = rows.join(F.broadcast(offsets.drop("_n")), "_part")
    out = scratch_path(spark, "codes")
    codes.select(F.col("v").alias("level"), (F.col("_before") + F.col("_at") - F.col("_first")).cast("int").alias("code")).write.parquet(out)
    return out, int(parts.agg(F.sum("_n")).first()[0] or 0)


def encode(df: DataFrame, method: str = "one_hot", columns: list[str] | None = None,
           max_levels: int = MAX_LITERAL_LEVELS) -> DataFrame:
    return fit_encoder(df, method, columns, max_levels).transform(df)


def fit_one_hot_vector(df: DataFrame, column: str, out_col: str | None = None):
    """E8 for wide categoricals: one sparse vector column instead of one column per level.

    Same semantics as ``one_hot``: levels in sorted order, the first dropped,
    null -> all zeros. Built from Spark ML stages: StringIndexer (alphabetical,
    nulls kept as an extra index), OneHotEncoder (no level dropped) and a
    VectorSlicer that removes index 0 (the first level) and the null slot.
    Returns a fitted PipelineModel; its output is ``out_col`` (default ``<column>_vec``).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorSlicer
    out_col = out_col or f"{column}_vec"
    idx = StringIndexer(inputCol=column, outputCol=f"_{column}_idx", stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(df)
    k = len(idx.labels)
    ohe = OneHotEncoder(inputCols=[f"_{column}_idx"], outputCols=[f"_{column}_ohe"], dropLast=False,
                        handleInvalid="keep")
    sl = VectorSlicer(inputCol=f"_{column}_ohe", outputCol=out_col, indices=list(range(1, k)))
    return Pipeline(stages=[idx, ohe, sl]).fit(df), idx.labels[1:]


# --------------------------------------------------------------------------------------
# Exact-size, repeatable splits
# --------------------------------------------------------------------------------------
def _frac(x) -> Fraction:
    return Fraction(str(x))


def split_sizes(n: int, test_size=0.2, val_size=0.0) -> tuple[int, int, int]:
    """(train, val, test) counts: the held-out part is rounded up, then split again
    into val and test with the test part rounded up; decimal arithmetic throughout."""
    t, v = _frac(test_size), _frac(val_size)
    if v > 0:
        n_vt = math.ceil(n * (t + v))
        n_test = math.ceil(n_vt * (t / (t + v)))
        return n - n_vt, n_vt - n_test, n_test
    n_test = math.ceil(n * t)
    return n - n_test, 0, n_test


def split_labels(df: DataFrame, id_col: str, test_size=0.2, val_size=0.0, seed: int = 42,
                 out: str = "split") -> DataFrame:
    """Label each row train / val / test with exact sizes.

    Rows are ordered by a repeatable md5 draw of their id (ties by id).
    Only the two boundary rows are selected (``label_by_position``, with
    equal-width buckets on the draw); every row is labelled by comparing
    with them, so no row is shuffled and nothing depends on partitioning.
    """
    def starts(n):
        n_train, n_val, _ = split_sizes(n, test_size, val_size)
        return [n_train + 1, n_train + n_val + 1]

    _, r = label_by_position(df.withColumn("_u", uniform(id_col, seed, "split")), "_u", id_col, starts, "_cut",
                             key_is_uniform=True)
    lab = F.when(F.col("_cut") == 0, "train").when(F.col("_cut") == 1, "val").otherwise("test")
    return r.withColumn(out, lab).drop("_u", "_cut")


def _allocate(counts: DataFrame, key: str, n_col: str, total: int, n_all: int, out: str) -> DataFrame:
    """Largest-remainder allocation of ``total`` over groups in proportion to ``n_col``
    (ties by group key). Runs on the per-group count table."""
    q = F.col(n_col) * F.lit(total) / F.lit(n_all) if n_all else F.lit(0.0)
    c = counts.withColumn("_q", q).withColumn("_f", F.floor("_q").cast("long")).withColumn("_r", F.col("_q") - F.col("_f"))
    left = total - (c.agg(F.sum("_f")).first()[0] or 0)
    # the group table has one row per stratum: a small ordered window
    w = Window.orderBy(F.col("_r").desc(), F.col(key))
    return (c.withColumn("_o", F.row_number().over(w))
            .withColumn(out, F.col("_f") + (F.col("_o") <= F.lit(left)).cast("long"))
            .drop("_q", "_f", "_r", "_o"))


MAX_CUT_STRATA = 10_000  # strata whose boundary rows are gathered and broadcast back


def split_labels_stratified(df: DataFrame, id_col: str, stratum: str, test_size=0.2, val_size=0.0,
                            seed: int = 42, out: str = "split") -> DataFrame:
    """Stratified exact-size split; the stratum is used in both stages.

    Per-stratum sizes come from largest-remainder allocation of the totals.
    With at most ``MAX_CUT_STRATA`` strata (counted), only each stratum's
    two boundary rows are selected (``label_by_group_positions`` over
    md5-draw buckets) and rows are labelled by comparing with them through
    a broadcast per-stratum table: no row is shuffled. Otherwise (or when
    an id repeats at a boundary) the position inside a stratum comes from
    ``global_rank`` partitioned by the stratum over the same buckets, so a
    stratum holding a third of the rows is still spread over many tasks.
    """
    # one row per stratum, read by several small jobs: kept once
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_ns")).persist()
    n = int(counts.agg(F.sum("_ns")).first()[0] or 0)
    n_train, n_val, n_test = split_sizes(n, test_size, val_size)
    a = _allocate(counts, stratum, "_ns", n_val + n_test, n, "_nvt")
    if n_val:
        a = _allocate(a, stratum, "_nvt", n_test, n_val + n_test, "_nt")
    else:
        a = a.withColumn("_nt", F.col("_nvt"))
    src = df.withColumn("_u", uniform(id_col, seed, "split"))
    if a.limit(MAX_CUT_STRATA + 1).count() <= MAX_CUT_STRATA:
        starts = a.select(stratum, (F.col("_ns") - F.col("_nvt") + 1).alias("_s0"),
                          (F.col("_ns") - F.col("_nt") + 1).alias("_s1"))
        lab = label_by_group_positions(src, stratum, "_u", id_col, starts, "_cut", key_is_uniform=True)
        counts.unpersist()
        if lab is not None:
            names = F.when(F.col("_cut") == 0, "train").when(F.col("_cut") == 1, "val").otherwise("test")
            return lab.withColumn(out, names).drop("_u", "_cut")
    r = global_rank(df.withColumn("_u", uniform(id_col, seed, "split")), "_u", id_col, "_pos",
                    key_is_uniform=True, partition_by=[stratum])
    # one row per stratum; AQE broadcasts it when it is small at run time
    r = r.join(a.select(stratum, "_ns", "_nvt", "_nt"), stratum, "left")
    n_tr = F.col("_ns") - F.col("_nvt")
    lab = (F.when(F.col("_pos") <= n_tr, "train")
           .when(F.col("_pos") <= n_tr + F.col("_nvt") - F.col("_nt"), "val").otherwise("test"))
    return r.withColumn(out, lab).drop("_u", "_pos", "_ns", "_nvt", "_nt")


def split_dataset(df: DataFrame, id_col: str, target: str, test_size=0.2, val_size=0.0, seed: int = 42,
                  stratify: str | None = None, materialize: bool = False):
    """(train, val or None, test) DataFrames; the target must exist.

    Labels are a projection, so the parts are read through to the source.
    With ``materialize`` the labelled table is written once to the shared
    folder, for inputs that several jobs read.
    """
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in dataframe")
    lab = (split_labels_stratified(df, id_col, stratify, test_size, val_size, seed) if stratify
           else split_labels(df, id_col, test_size, val_size, seed))
    if materialize:
        from ..session import scratch_path
        path = scratch_path(lab.sparkSession, "split")
        lab.write.parquet(path)
        lab = lab.sparkSession.read.parquet(path)
    parts = {k: lab.where(F.col("split") == k).drop("split") for k in ("train", "val", "test")}
    return parts["train"], (parts["val"] if val_size and float(val_size) > 0 else None), parts["test"]
