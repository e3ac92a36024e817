"""Table profiles.

Every profile over many columns is ONE aggregate pass whose single result
row is turned into long form (one row per column) with ``inline``; no
per-column jobs, no driver loops over data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import scalars as S


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns by schema (costs no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def columns_matching(df: DataFrame, fragments: tuple[str, ...] = ("time", "hour", "day")) -> list[str]:
    """Columns whose lower-cased name contains any fragment."""
    return [c for c in df.columns if any(fr in c.lower() for fr in fragments)]


def features_target(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    """Feature columns and target; a missing target raises before anything else."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in dataframe")
    return df.drop(target), target


def _long(row_structs: list[Column]) -> Column:
    return F.inline(F.array(*row_structs))


def quantile_expr(c: Column, probs: list[float], method: str = "exact", accuracy: int = 10000) -> Column:
    """Linear-interpolated quantiles (exact) or approximate ones for very large high-cardinality columns."""
    if method == "exact":
        return F.percentile(c, F.array(*[F.lit(float(p)) for p in probs]))
    if method == "approx":
        return F.percentile_approx(c, [float(p) for p in probs], accuracy)
    raise ValueError(f"unknown quantile method {method!r}")


def describe(df: DataFrame, columns: list[str] | None = None, method: str = "auto") -> DataFrame:
    """C1 (+C16): count, mean, std (ddof 1), min, q25, q50, q75, max per numeric column.

    One aggregate pass; quantiles of columns with a moderate number of
    distinct values come from the same pass, those of the others from the
    scalable exact selection in ``quantiles`` (method 'auto' decides per
    column).
    """
    from .quantiles import column_methods, quantiles
    cols = columns or numeric_columns(df)
    per = column_methods(df, cols) if method == "auto" else {c: method for c in cols}
    sel = [c for c in cols if per[c] == "select"]
    qlit = quantiles(df, sel, [0.25, 0.5, 0.75], "select") if sel else {}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if c not in qlit:
            aggs.append(quantile_expr(x, [0.25, 0.5, 0.75], per[c]).alias(f"q{i}"))
    one = df.agg(*aggs)

    def q(i: int, j: int) -> Column:
        return F.col(f"q{i}")[j] if cols[i] not in qlit else F.lit(qlit[cols[i]][j]).cast("double")
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                        q(i, 0).alias("q25"), q(i, 1).alias("q50"), q(i, 2).alias("q75"),
                        F.col(f"hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    return one.select(_long(structs))


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns and the column lists by kind (schema walk + one count)."""
    num = numeric_columns(df)
    cat = [c for c in df.columns if c not in num]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(num)).alias("numeric_columns"),
        F.lit(",".join(cat)).alias("categorical_columns"))


def missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and percent per column (NaN counts as missing)."""
    cols = columns or df.columns
    types = dict(df.dtypes)

    def is_missing(c: str) -> Column:
        if types[c] in ("double", "float"):
            return F.col(c).isNull() | F.isnan(c)
        return F.col(c).isNull()

    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(is_missing(c).cast("long")).alias(f"x{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"x{i}").alias("missing_count"),
                        (F.col(f"x{i}") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("missing_percent"))
               for i, c in enumerate(cols)]
    return one.select(_long(structs))


def missing_total(df: DataFrame) -> DataFrame:
    """Total number of missing cells in the table."""
    return missing(df).agg(F.sum("missing_count").alias("total_missing"))


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """C4: (column, value, count) for each categorical column; nulls dropped.

    All columns are stacked into (column, value) and counted in ONE grouped
    aggregate (partial aggregation on the map side, so a hot value costs a
    single row per task before the shuffle).
    """
    cols = columns or string_columns(df)
    st = df.select(_long([F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                          for c in cols]))
    return (st.where(F.col("value").isNotNull()).groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def n_unique(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per column, a null counting as one value."""
    cols = columns or df.columns
    aggs = []
    for i, c in enumerate(cols):
        d = F.approx_count_distinct(c) if approx else F.count_distinct(F.col(c))
        aggs.append((d + F.max(F.col(c).isNull().cast("int"))).cast("long").alias(f"d{i}"))
    one = df.agg(*aggs)
    return one.select(_long([F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_unique"))
                             for i, c in enumerate(cols)]))


# --------------------------------------------------------------------------------------
# Quantiles and Tukey fences
# --------------------------------------------------------------------------------------
def iqr_bounds(df: DataFrame, columns: list[str], factor: float = 1.5, method: str = "auto") -> DataFrame:
    """One row per column: q1, q3, iqr, lower, upper (quantiles per ``quantiles``)."""
    from .quantiles import quantiles
    qs = quantiles(df, columns, [0.25, 0.75], method)
    rows = [(c, qs[c][0], qs[c][1]) for c in columns]
    spark = df.sparkSession
    return (spark.createDataFrame(rows, "column string, q1 double, q3 double")
            .withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower", F.col("q1") - factor * F.col("iqr"))
            .withColumn("upper", F.col("q3") + factor * F.col("iqr")))


def iqr_bounds_dict(df: DataFrame, columns: list[str], factor: float = 1.5,
                    method: str = "auto") -> dict[str, tuple[float, float]]:
    """C6 fences as literals (same arithmetic as ``iqr_bounds``, no table round trip)."""
    from .quantiles import quantiles
    qs = quantiles(df, columns, [0.25, 0.75], method)
    out = {}
    for c in columns:
        q1, q3 = qs[c]
        out[c] = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def bounds_dict(bounds: DataFrame) -> dict[str, tuple[float, float]]:
    """Fitted bounds (one row per column: driver-sized) as literals for later projections."""
    return {r["column"]: (r["lower"], r["upper"]) for r in bounds.collect()}


def is_outside(c: str, lo: float, hi: float) -> Column:
    """Strictly outside [lo, hi]; null is never an outlier."""
    x = F.col(c)
    return F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))


def outlier_summary(df: DataFrame, bounds: dict[str, tuple[float, float]], treatment: str) -> DataFrame:
    """Outlier count and percent of rows per column, with the bounds used."""
    cols = list(bounds)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(is_outside(c, *bounds[c]).cast("long")).alias(f"o{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"o{i}").alias("outlier_count"),
                        (F.col(f"o{i}") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("outlier_percent"),
                        F.lit(bounds[c][0]).cast("double").alias("lower_bound"),  # null for a column without values
                        F.lit(bounds[c][1]).cast("double").alias("upper_bound"),
                        F.lit(treatment).alias("treatment"))
               for i, c in enumerate(cols)]
    return one.select(_long(structs))


def apply_iqr_treatment(df: DataFrame, bounds: dict[str, tuple[float, float]], treatment: str,
                        flag_col: str = "is_outlier") -> DataFrame:
    """E6 transform: clip (B11), remove rows out on any column (B14) or flag them."""
    if treatment == "clip":
        # bounds are fractional, so clipped columns are double (as in the reference)
        return df.withColumns({c: S.clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in bounds.items()})
    any_out = S.any_of(*[is_outside(c, lo, hi) for c, (lo, hi) in bounds.items()]) if bounds else F.lit(False)
    if treatment == "remove":
        return df.where(~any_out)
    if treatment == "flag":
        return df.withColumn(flag_col, any_out.cast("int"))
    raise ValueError(f"unknown outlier treatment {treatment!r}")


def detect_and_handle_outliers(df: DataFrame, columns: list[str] | None = None, method: str = "iqr",
                               contamination: float = 0.05, treatment: str = "clip", id_col: str | None = None,
                               seed: int = 42, quantile_method: str = "auto"):
    """Returns (treated DataFrame, outlier summary DataFrame)."""
    cols = columns or numeric_columns(df, exclude=(id_col,) if id_col else ())
    if method == "iqr":
        b = iqr_bounds_dict(df, cols, method=quantile_method)
        return apply_iqr_treatment(df, b, treatment), outlier_summary(df, b, treatment)
    if method == "isolation_forest":
        from .outliers import isolation_forest_outliers
        if id_col is None:
            raise ValueError("isolation_forest needs an id column")
        return isolation_forest_outliers(df, cols, id_col, contamination=contamination, seed=seed,
                                         treatment=treatment)
    raise ValueError(f"unknown outlier method {method!r}")
