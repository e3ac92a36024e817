"""Regression metrics and residual diagnostics.

Metrics are grouped native aggregates over a predictions table
(y, prediction[, model]); comparing many models is ONE grouped aggregate
over their union, not one job per model.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .ranking import global_rank, qcut_rows


def metric_aggs(y: str, p: str) -> list[Column]:
    """C23 aggregates: mse, rmse, mae, r2 (1 - SSres/SStot), mape (% with 1e-7 floor)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    ss_res = F.sum(e * e)
    ss_tot = F.var_pop(F.col(y).cast("double")) * F.count(e)
    r2 = (F.when(ss_tot > 0, F.lit(1.0) - ss_res / F.nullif(ss_tot, F.lit(0.0)))
          .when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return [F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            r2.alias("r2"), F.avg(S.pct_error(y, p)).alias("mape"), F.count(e).alias("n")]


def regression_metrics(df: DataFrame, y: str = "label", p: str = "prediction",
                       group: list[str] | None = None) -> DataFrame:
    """C23 over a predictions table, optionally per group (e.g. per model)."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    if group:
        return d.groupBy(*group).agg(*metric_aggs(y, p))
    return d.agg(*metric_aggs(y, p))


def with_fit_band(metrics: DataFrame) -> DataFrame:
    """B19 on a metrics table."""
    return metrics.withColumn("fit", S.fit_band("r2"))


def residual_stats(df: DataFrame, y: str = "label", p: str = "prediction") -> DataFrame:
    """Mean, std (ddof 0), min, max of the residuals."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    return df.agg(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), F.min(e).alias("min"), F.max(e).alias("max"))


def error_columns(df: DataFrame, y: str = "label", p: str = "prediction") -> DataFrame:
    """Residual, abs_error, pct_error."""
    return df.withColumns({"residual": S.residual(y, p), "abs_error": S.abs_error(y, p),
                           "pct_error": S.pct_error(y, p)})


def _equal_width_bin(x: Column, lo: Column, hi: Column, k: int) -> Column:
    width = (hi - lo) / k
    b = F.when(width > 0, F.floor((x - lo) / F.nullif(width, F.lit(0.0)))).otherwise(F.lit(0))
    return F.least(F.greatest(b, F.lit(0)), F.lit(k - 1)).cast("int")


def actual_vs_predicted(df: DataFrame, y: str = "label", p: str = "prediction", bins: int = 20) -> DataFrame:
    """Common axis range and a 2-D histogram of (actual, predicted) on it."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    rng = d.agg(F.least(F.min(y), F.min(p)).cast("double").alias("lo"),
                F.greatest(F.max(y), F.max(p)).cast("double").alias("hi")).first()  # two scalars
    lo, hi = F.lit(rng["lo"]), F.lit(rng["hi"])
    return (d.groupBy(_equal_width_bin(F.col(y), lo, hi, bins).alias("bin_actual"),
                      _equal_width_bin(F.col(p), lo, hi, bins).alias("bin_pred"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumns({"axis_min": lo, "axis_max": hi}))


def residual_bins(df: DataFrame, y: str = "label", p: str = "prediction", bins: int = 10) -> DataFrame:
    """Residual and |residual| against predicted, per equal-width bin of the prediction."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    from .quantiles import grouped_quantiles
    rng = d.agg(F.min(p).cast("double").alias("lo"), F.max(p).cast("double").alias("hi")).first()
    e = F.col(y) - F.col(p)
    binned = d.select(_equal_width_bin(F.col(p), F.lit(rng["lo"]), F.lit(rng["hi"]), bins).alias("bin"),
                      F.col(p).alias("_p"), e.alias("_e"))
    med = grouped_quantiles(binned, ["bin"], "_e", [0.5]).select("bin", F.col("q")[0].alias("median_resid"))
    stats = (binned.groupBy("bin")
             .agg(F.count(F.lit(1)).alias("count"), F.avg("_p").alias("mean_pred"),
                  F.avg("_e").alias("mean_resid"), F.stddev_samp("_e").alias("std_resid"),
                  F.avg(F.abs("_e")).alias("mean_abs_resid")))
    return stats.join(med, "bin")


def segments(df: DataFrame, y: str, p: str, id_col: str, k: int = 3) -> DataFrame:
    """Metrics per equal-count segment of the rows ordered by actual value (ties by id).

    The segment is D7's quantile cut of the position; ``qcut_rows`` finds
    only the k - 1 boundary rows and labels rows by comparing with them, so
    no row is shuffled.
    """
    d = df.select(id_col, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p")) \
          .where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    seg = qcut_rows(d, "_y", id_col, k)
    e = F.col("_y") - F.col("_p")
    ss_tot = F.var_pop("_y") * F.count(F.lit(1))
    ss_res = F.sum(e * e)
    r2 = F.when(F.count(F.lit(1)) <= 1, F.lit(None).cast("double")).otherwise(
        F.when(ss_tot > 0, F.lit(1.0) - ss_res / F.nullif(ss_tot, F.lit(0.0)))
        .when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return seg.groupBy("segment").agg(
        F.min("_y").alias("min_value"), F.max("_y").alias("max_value"), F.avg("_y").alias("mean_value"),
        F.count(F.lit(1)).alias("count"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(S.pct_error("_y", "_p")).alias("mape"), r2.alias("r2"))


def compare_models(predictions: DataFrame, y: str = "label", p: str = "prediction", model_col: str = "model",
                   metric: str = "mse") -> DataFrame:
    """Metrics per model from ONE grouped aggregate, sorted by ``metric``
    (r2 descending, error metrics ascending)."""
    m = regression_metrics(predictions, y, p, group=[model_col]).drop("n")
    o = F.col(metric).desc_nulls_last() if metric == "r2" else F.col(metric).asc_nulls_last()
    return m.orderBy(o, F.col(model_col))


# --------------------------------------------------------------------------------------
# Normal Q-Q
# --------------------------------------------------------------------------------------
# Coefficients of Acklam's rational approximation of the
# inverse standard normal CDF (relative error below 1.2e-9).
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
_P_LOW = 0.02425


def _poly(coefs: list[float], x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF as a column expression (no UDF)."""
    q = p - 0.5
    r = q * q
    central = q * _poly(_A, r) / (_poly(_B, r) * r + 1.0)
    ql = F.sqrt(-2.0 * F.log(p))
    low = _poly(_C, ql) / (_poly(_D, ql) * ql + 1.0)
    qu = F.sqrt(-2.0 * F.log(1.0 - p))
    high = -_poly(_C, qu) / (_poly(_D, qu) * qu + 1.0)
    return F.when(p < _P_LOW, low).when(p > 1.0 - _P_LOW, high).otherwise(central)


def filliben(i: Column, n: Column) -> Column:
    """Filliben's order-statistic medians for 1-based rank i of n."""
    last = F.pow(F.lit(0.5), 1.0 / n)
    return (F.when(i == n, last).when(i == 1, 1.0 - last)
            .otherwise((i - 0.3175) / (n + 0.365)))


def qq(df: DataFrame, y: str, p: str, id_col: str, points: int = 100):
    """Normal Q-Q of the residuals: (line DataFrame, points DataFrame).

    Residuals get their global position (D6), a Filliben plotting position
    and its normal quantile as a column expression; the line is
    ``regr_slope/regr_intercept/corr`` over all rows; the points returned
    are ``points`` evenly spaced ranks (the whole set can be as large as
    the table).
    """
    d = df.select(id_col, (F.col(y).cast("double") - F.col(p).cast("double")).alias("residual")) \
          .where(F.col("residual").isNotNull())
    n = d.count()
    r = global_rank(d, "residual", id_col, "i")
    th = r.withColumn("theoretical", norm_ppf(filliben(F.col("i"), F.lit(float(n)))))
    line = th.agg(F.regr_slope("residual", "theoretical").alias("slope"),
                  F.regr_intercept("residual", "theoretical").alias("intercept"),
                  F.corr("residual", "theoretical").alias("r"), F.count(F.lit(1)).alias("n"))
    m = min(points, n)
    ranks = sorted({int(math.floor(j * (n - 1) / max(m - 1, 1) + 0.5)) + 1 for j in range(m)})
    pts = th.where(F.col("i").isin(ranks)).select("i", "theoretical", "residual")
    return line, pts
