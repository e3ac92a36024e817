"""Column-level functions (B-items, A6, A7, repeatable draws).

Every function here returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage codegen and needs no shuffle.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's definitions.
# Time-of-day bands (hours): morning [5,12), afternoon [12,17), evening [17,21),
# night >=21 or <5, anything else (null) 'unknown'.
# Peak hours: 7 <= h <= 9 or 17 <= h <= 19 (both ends inclusive).
# Weekend: day >= 5 (0 = Monday).
# Percent-error denominator floor: 1e-7.
# Fit bands on R^2: > 0.9 excellent, > 0.7 good, > 0.5 moderate, else poor.
PCT_FLOOR = 1e-7
FIT_BANDS = [(0.9, "excellent"), (0.7, "good"), (0.5, "moderate")]

_TWO32 = 4294967296.0


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------------------
# Repeatable draws
# --------------------------------------------------------------------------------------
def uniform(id_col: ColumnOrName, seed: int | str, tag: str = "u") -> Column:
    """U[0,1) draw per row: first 32 bits of md5('<seed>-<tag>-<id>').

    Depends only on the row's id, never on partitioning or task order, so it is
    the same after a retry or a repartition, and equal to the same md5 formula
    in any SQL engine.
    """
    key = F.concat(F.lit(f"{seed}-{tag}-"), _c(id_col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(_TWO32)


def normal_draw(id_col: ColumnOrName, seed: int | str, tag: str = "n") -> Column:
    """Standard normal draw per row (Box-Muller from two md5 draws)."""
    u1 = uniform(id_col, seed, tag + "1")
    u2 = uniform(id_col, seed, tag + "2")
    return F.sqrt(-2.0 * F.log(F.lit(1.0) - u1)) * F.cos(2.0 * math.pi * u2)


def inject_missing(df: DataFrame, columns: list[str], pct: float, seed: int, id_col: str) -> DataFrame:
    """Blank each (row, column) cell with probability ``pct``.

    The reference draws ``int(cells*pct)`` cells with replacement; we use an
    independent repeatable draw per cell, which has the same expected rate and
    needs neither a shuffle nor a driver loop.
    """
    if not 0.0 <= pct <= 1.0:
        raise ValueError("pct must be in [0, 1]")
    out = []
    for f in df.schema.fields:
        if f.name in columns:
            out.append(F.when(uniform(id_col, seed, f.name) < pct, F.lit(None).cast(f.dataType))
                       .otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def cumulative_thresholds(weights: list[float], normalize: bool = False) -> list[float]:
    total = math.fsum(weights)
    if any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative")
    if abs(total - 1.0) > 1e-9:
        if not normalize:
            raise ValueError(f"weights sum to {total!r}, not 1 (pass normalize=True to rescale)")
        weights = [w / total for w in weights]
    acc, out = 0.0, []
    for w in weights[:-1]:
        acc = math.fsum([acc, w])
        out.append(acc)
    return out


def weighted_bucket(id_col: ColumnOrName, weights: list[float], seed: int, tag: str = "w",
                    normalize: bool = False) -> Column:
    """Weighted discrete choice 0..k-1 from a repeatable draw."""
    u = uniform(id_col, seed, tag)
    th = cumulative_thresholds(weights, normalize)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(th))):
        expr = F.when(u < F.lit(th[i]), F.lit(i)).otherwise(expr)
    return expr


# --------------------------------------------------------------------------------------
# Time features
# --------------------------------------------------------------------------------------
def fractional_hour(ts: ColumnOrName) -> Column:
    """B2: hour + minute/60."""
    return F.hour(_c(ts)) + F.minute(_c(ts)) / F.lit(60.0)


def day_of_week(ts: ColumnOrName) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(_c(ts))


def cyclic(c: ColumnOrName, period: float) -> tuple[Column, Column]:
    """Sin and cos of 2*pi*c/period (null stays null)."""
    a = F.lit(2.0 * math.pi) * _c(c) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def time_of_day(h: ColumnOrName) -> Column:
    """B6."""
    h = _c(h)
    return (F.when((h >= 5) & (h < 12), "morning")
            .when((h >= 12) & (h < 17), "afternoon")
            .when((h >= 17) & (h < 21), "evening")
            .when((h >= 21) | (h < 5), "night")
            .otherwise("unknown"))


def any_of(*conds: Column) -> Column:
    """Elementwise OR."""
    return reduce(or_, conds)


def is_peak_hour(h: ColumnOrName) -> Column:
    """Inclusive bands; null -> 0."""
    h = _c(h)
    return F.coalesce(any_of(h.between(7, 9), h.between(17, 19)).cast("int"), F.lit(0))


def is_weekend(d: ColumnOrName) -> Column:
    """Null -> 0."""
    return F.coalesce((_c(d) >= 5).cast("int"), F.lit(0))


def hour_bucket(h: ColumnOrName) -> Column:
    """Floor of the fractional hour as int; null stays null."""
    return F.floor(_c(h)).cast("int")


def engineer_time_features(df: DataFrame, hour_column: str = "post_hour", day_column: str = "post_day") -> DataFrame:
    """B4-B8 on a table; a missing column skips its features like the reference."""
    cols = df.columns
    out = df
    if hour_column in cols:
        s, c = cyclic(hour_column, 24.0)
        out = out.withColumns({"hour_sin": s, "hour_cos": c,
                               "time_of_day": time_of_day(hour_column),
                               "is_peak_hour": is_peak_hour(hour_column)})
    if day_column in cols:
        s, c = cyclic(day_column, 7.0)
        out = out.withColumns({"day_sin": s, "day_cos": c, "is_weekend": is_weekend(day_column)})
    return out


# --------------------------------------------------------------------------------------
# Clip, errors, bands
# --------------------------------------------------------------------------------------
def clip(c: ColumnOrName, lo, hi) -> Column:
    """Clip to [lo, hi]; null stays null (greatest/least alone would skip it)."""
    c = _c(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNotNull(), F.least(F.greatest(c, lo_c), hi_c))


def residual(y: ColumnOrName, p: ColumnOrName) -> Column:
    return _c(y) - _c(p)


def abs_error(y: ColumnOrName, p: ColumnOrName) -> Column:
    return F.abs(_c(y) - _c(p))


def pct_error(y: ColumnOrName, p: ColumnOrName) -> Column:
    """|(y - p) / max(|y|, 1e-7)| * 100."""
    return F.abs((_c(y) - _c(p)) / F.greatest(F.abs(_c(y)), F.lit(PCT_FLOOR))) * F.lit(100.0)


def fit_band(r2: ColumnOrName) -> Column:
    """Verbal band of an R^2 value."""
    r2 = _c(r2)
    expr = F.lit("poor")
    for th, name in reversed(FIT_BANDS):
        expr = F.when(r2 > th, name).otherwise(expr)
    return expr


# --------------------------------------------------------------------------------------
# B1: engagement score
# --------------------------------------------------------------------------------------
def engagement_score(length: ColumnOrName, images: ColumnOrName, tags: ColumnOrName,
                     followers: ColumnOrName, hour: ColumnOrName, day: ColumnOrName,
                     noise: Column | None = None) -> Column:
    """B1: the synthetic engagement rate (percent), clipped to [0.1, 15]."""
    L, I, T, Fo, H, D = (_c(x) for x in (length, images, tags, followers, hour, day))
    base = (F.lit(-0.00005) * F.pow(L - 100, 2) + 0.5
            + 0.7 * F.log1p(I)
            + 0.4 * F.log1p(T) - 0.01 * F.pow(T, 2)
            - 0.3 * F.log10(Fo + 1) + 2.0
            + 0.5 * F.sin((H - 8) * F.lit(math.pi) / 12)
            + 0.3 * (D >= 5).cast("double"))
    if noise is not None:
        base = base + noise
    return clip(base * 2, 0.1, 15.0)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalize NaN to NULL in float/double columns once, at the source."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
