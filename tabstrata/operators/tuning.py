"""Validation and tuning.

Folds are a column (contiguous, unshuffled, cut at the k - 1 boundary ids found by
``label_by_position``), so CV never collects rows; all folds' predictions are unioned and
scored in ONE grouped aggregate.
"""

from __future__ import annotations

import itertools
import math
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import models as MD
from .metrics import regression_metrics
from .ranking import global_rank, label_by_position

# The reference's search grids (parameters Spark has no
# equivalent for - solver names, normalize, copy_X - are dropped).
GRIDS = {
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20, 30],
                      "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "gradient_boosting": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2],
                          "max_depth": [3, 5, 7], "subsample": [0.8, 0.9, 1.0]},
    "linear": {"fit_intercept": [True, False]},
    "ridge": {"alpha": [0.1, 1.0, 10.0, 100.0], "fit_intercept": [True, False]},
    "lasso": {"alpha": [0.1, 0.5, 1.0, 5.0, 10.0], "fit_intercept": [True, False], "max_iter": [1000, 2000, 5000]},
}


def fold_starts(n: int, k: int) -> list[int]:
    """1-based first positions of folds 1..k-1: contiguous folds, the first n mod k one row larger."""
    small, big = n // k, n % k
    return [j * (small + 1) + 1 if j <= big else big * (small + 1) + (j - big) * small + 1 for j in range(1, k)]


def assign_folds(df: DataFrame, id_col: str, k: int = 5, out: str = "fold") -> DataFrame:
    """F12 fold column: rows in id order cut into k contiguous folds.

    Only the k - 1 fold boundaries are selected (``label_by_position``);
    rows get their fold from comparisons with them, without a shuffle.
    """
    if k < 2:
        raise ValueError(f"need 2 <= k <= n rows, got k={k}")
    n, lab = label_by_position(df, id_col, id_col, lambda n: fold_starts(n, k), "_cut")
    if k > n:
        raise ValueError(f"need 2 <= k <= n rows, got k={k}, n={n}")
    return lab.withColumn(out, F.col("_cut").cast("int")).drop("_cut")


def _fit_predict(train: DataFrame, test: DataFrame, features, label, model_type, params) -> DataFrame:
    m = MD.train(train, features, label, model_type, **params)
    return MD.predict(m, test.select(*features, label))


# --------------------------------------------------------------------------------------
# linear / ridge / lasso / elastic net from sufficient statistics: every fold (and every grid point) from ONE
# grouped aggregate of the sums and products of the columns less their global means (so a
# large offset cancels nothing); the training statistics of fold i are the totals minus
# fold i's own, the p x p solves run on the driver, and one pass scores all. Only complete
# rows are used, as in ``models.train``.
# --------------------------------------------------------------------------------------
MAX_GRAM_FEATURES = 64


def column_means(f: DataFrame, columns: list[str]) -> np.ndarray:
    row = f.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([row[f"m{i}"] or 0.0 for i in range(len(columns))])


def centred_sums(f: DataFrame, by: str, features: list[str], label: str, means: np.ndarray) -> dict:
    """{group: [n, sx[p], sy, sxx[p,p], sxy[p], syy]} of the columns less ``means``, from one aggregate."""
    p = len(features)
    xs = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(features, means)]
    y = F.col(label).cast("double") - F.lit(float(means[p]))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x).alias(f"sx{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(x * y).alias(f"sxy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"sxx{i}_{j}") for i in range(p) for j in range(i, p)]
    out = {}
    for r in f.groupBy(by).agg(*aggs).collect():  # one row per fold or segment
        sxx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                sxx[i, j] = sxx[j, i] = r[f"sxx{i}_{j}"]
        out[int(r[by])] = [r["n"], np.array([r[f"sx{i}"] for i in range(p)]), r["sy"], sxx,
                           np.array([r[f"sxy{i}"] for i in range(p)]), r["syy"]]
    return out


def _normal_equations(stats, means: np.ndarray, fit_intercept: bool):
    """(A, b) of A w = b: products of the columns less their means, or of the columns themselves without an intercept."""
    n, sx, sy, sxx, sxy = stats[:5]
    mx, my = means[:-1], means[-1]
    if fit_intercept:
        return sxx - np.outer(sx, sx) / n, sxy - sx * sy / n
    return (sxx + np.outer(sx, mx) + np.outer(mx, sx) + n * np.outer(mx, mx),
            sxy + sx * my + mx * sy + n * mx * my)


def solve_l1(stats, means: np.ndarray, l1: float, l2: float, fit_intercept: bool = True, max_iter: int = 10000, tol: float = 1e-9):
    """Lasso / elastic net 1/(2n)||y - Xw||^2 + l1 ||w||_1 + l2/2 ||w||^2 by coordinate descent on the sums: (w, intercept).

    Ends after ``max_iter`` sweeps, or when a sweep changes no column's part of
    the predictions by more than ``tol`` of the largest.
    """
    n, sx, sy = stats[:3]
    A, b = _normal_equations(stats, means, fit_intercept)
    w, size = np.zeros(len(b)), np.sqrt(np.maximum(np.diag(A), 0.0))
    for _ in range(max_iter):
        before = w.copy()
        for j in np.flatnonzero(size > 0):
            rest = b[j] - A[j] @ w + A[j, j] * w[j]
            w[j] = math.copysign(max(abs(rest) - n * l1, 0.0), rest) / (A[j, j] + n * l2)
        if np.abs((w - before) * size).max(initial=0.0) <= tol * np.abs(w * size).max(initial=0.0):
            break
    return w, float(means[-1] + (sy - w @ sx) / n - w @ means[:-1]) if fit_intercept else 0.0


def solve_linear(stats, means: np.ndarray, alpha: float = 0.0, fit_intercept: bool = True):
    """Least squares / ridge (penalty alpha * ||w||^2 on the summed loss): (w, intercept) from centred sums.

    Collinear or constant columns get the solution of least norm, of which all
    solutions' predictions are the same.
    """
    n, sx, sy = stats[:3]
    mx, my = means[:-1], means[-1]
    A, b = _normal_equations(stats, means, fit_intercept)
    A = A + alpha * np.eye(len(sx))
    size = np.sqrt(np.where(np.diag(A) > 0, np.diag(A), 1.0))  # columns of unit length, for the cut-off
    w = np.linalg.lstsq(A / np.outer(size, size), b / size, rcond=1e-11)[0] / size
    return w, float(my + (sy - w @ sx) / n - w @ mx) if fit_intercept else 0.0


def _linear_params(model_type: str, params: dict) -> tuple[float, bool] | None:
    if model_type == "linear":
        return 0.0, bool(params.get("fit_intercept", True))
    if model_type == "ridge":
        return float(params.get("alpha", 1.0)), bool(params.get("fit_intercept", True))
    return None


def _gram_solver(model_type: str, params: dict):
    """(stats, means) -> (w, intercept) of a model that the sums determine; None for the others and for unknown parameters."""
    lin = _linear_params(model_type, params)
    if lin is not None:
        return lambda stats, means: solve_linear(stats, means, *lin)
    if model_type not in ("lasso", "elasticnet") or set(params) - {"alpha", "l1_ratio", "fit_intercept", "max_iter", "tol"}:
        return None
    alpha = float(params.get("alpha", 1.0))
    ratio = 1.0 if model_type == "lasso" else float(params.get("l1_ratio", 0.5))
    rest = bool(params.get("fit_intercept", True)), int(params.get("max_iter", 10000)), float(params.get("tol", 1e-9))
    return lambda stats, means: solve_l1(stats, means, alpha * ratio, alpha * (1 - ratio), *rest)


def _fold_predictions(f: DataFrame, features, label, points: list) -> DataFrame:
    """Predictions of every fold's model for every point's solver (``_gram_solver``), one pass: column pred{j} per point."""
    means = column_means(f, [*features, label])
    stats = centred_sums(f, "fold", features, label, means)
    tot = [sum(v[i] for v in stats.values()) for i in range(5)]
    cols = []
    for j, solver in enumerate(points):
        expr = None
        for k, v in stats.items():
            w, b = solver([tot[i] - v[i] for i in range(5)], means)
            lin = F.lit(float(b))
            for c, wc in zip(features, w):
                lin = lin + F.lit(float(wc)) * F.col(c).cast("double")
            expr = (F.when(F.col("fold") == k, lin) if expr is None else expr.when(F.col("fold") == k, lin))
        cols.append(expr.alias(f"pred{j}"))
    return f.select("fold", F.col(label).cast("double").alias(label), *cols)


def cross_validate(df: DataFrame, features: list[str], label: str, id_col: str, model_type: str = "linear",
                   k: int = 5, params: dict | None = None, parallelism: int = 2, folded: DataFrame | None = None):
    """per-fold metrics (fold, mse, rmse, mae, r2, mape, n) and the summary
    (metric, mean, std with ddof 0) over folds. Rows with a null are left out
    before the folds are cut."""
    params = params or {}
    base = MD.complete_rows(df.select(id_col, *features, label), features, label)
    f = folded if folded is not None else assign_folds(base, id_col, k)
    lin = _gram_solver(model_type, params)
    if lin is not None and len(features) <= MAX_GRAM_FEATURES:
        preds = _fold_predictions(f, features, label, [lin])
        per_fold = regression_metrics(preds, label, "pred0", group=["fold"])
        return per_fold, _summary(per_fold)
    mine = folded is None
    f = f.persist() if mine else f

    def one(i):
        return _fit_predict(f.where(F.col("fold") != i), f.where(F.col("fold") == i), features, label,
                            model_type, params).withColumn("fold", F.lit(i))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        preds = list(ex.map(one, range(k)))
    u = preds[0]
    for p in preds[1:]:
        u = u.unionByName(p)
    per_fold = regression_metrics(u, label, "prediction", group=["fold"])
    if mine:  # k rows are kept, the training rows let go
        per_fold = df.sparkSession.createDataFrame(per_fold.collect(), per_fold.schema)
        f.unpersist()
    return per_fold, _summary(per_fold)


def _summary(per_fold: DataFrame) -> DataFrame:
    long = per_fold.select("fold", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score"))
                                                      for m in ("mse", "rmse", "mae", "r2", "mape")])))
    return long.groupBy("metric").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
                                      F.count(F.lit(1)).alias("folds"))


def param_points(model_type: str, grid: dict | None = None) -> list[dict]:
    g = grid or GRIDS[model_type]
    keys = list(g)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[g[k] for k in keys])]


def _linear_search_scores(folded: DataFrame, features, label, pts, lin, scoring) -> list[tuple]:
    """Every grid point and fold from one aggregate and one scoring pass over the rows."""
    preds = _fold_predictions(folded, features, label, lin)
    long = preds.select("fold", label, F.posexplode(F.array(*[f"pred{j}" for j in range(len(pts))])).alias("point", "prediction"))
    allm = regression_metrics(long, label, "prediction", group=["point", "fold"])
    agg = {r["point"]: r for r in allm.groupBy("point").agg(F.avg(scoring).alias("m"),
                                                            F.stddev_pop(scoring).alias("s")).collect()}
    return [(j, str(p), float(agg[j]["m"]), float(agg[j]["s"])) for j, p in enumerate(pts)]


def search(df: DataFrame, features: list[str], label: str, id_col: str, model_type: str, cv: int = 5,
           scoring: str = "mse", search_method: str = "grid", n_iter: int = 10, seed: int = 42,
           grid: dict | None = None, parallelism: int = 2):
    """grid or random search over the model's grid with k-fold CV, refit of the best.

    Returns (best model, best params, best score, results table). Random
    search draws ``n_iter`` distinct grid points with a seeded generator.
    Linear, ridge, lasso and elastic net grids are scored from per-fold sufficient statistics
    (one aggregate + one scoring pass for all points and folds); other
    models fit once per (point, fold).
    """
    pts = param_points(model_type, grid)
    if search_method == "random":
        pts = random.Random(seed).sample(pts, min(n_iter, len(pts)))
    elif search_method != "grid":
        raise ValueError(f"unknown search method {search_method!r}")
    folded = assign_folds(MD.complete_rows(df.select(id_col, *features, label), features, label), id_col, cv).persist()
    lin = [_gram_solver(model_type, p) for p in pts]
    if all(x is not None for x in lin) and len(features) <= MAX_GRAM_FEATURES:
        rows = _linear_search_scores(folded, features, label, pts, lin, scoring)
    else:
        rows = []
        for i, p in enumerate(pts):
            _, summary = cross_validate(df, features, label, id_col, model_type, cv, p, parallelism, folded)
            s = summary.where(F.col("metric") == scoring).first()
            rows.append((i, str(p), float(s["mean"]), float(s["std"])))
    spark = df.sparkSession
    res = spark.createDataFrame(rows, "point int, params string, mean_score double, std_score double")
    better_high = scoring == "r2"
    best_i = (max if better_high else min)(range(len(rows)), key=lambda j: rows[j][2])
    best = MD.train(df, features, label, model_type, **pts[best_i])
    folded.unpersist()
    return best, pts[best_i], rows[best_i][2], res


# --------------------------------------------------------------------------------------
# learning curve
# --------------------------------------------------------------------------------------
def learning_curve(df: DataFrame, features: list[str], label: str, id_col: str, model_type: str = "linear",
                   cv: int = 5, train_sizes: list[float] | None = None, params: dict | None = None,
                   parallelism: int = 4) -> DataFrame:
    """RMSE of train and validation folds at growing train sizes.

    For fold i the training rows are the other folds in id order; a size m
    keeps the first m of them (position within the training part). A size
    given as a share is one number for all folds, that share of the smallest
    training part. Each (size, fold) fit of a model other than linear and
    ridge is one job submitted from a small thread pool.
    Returns (train_size, train_rmse_mean, train_rmse_std, test_rmse_mean,
    test_rmse_std) with ddof 0 over folds.
    """
    sizes = train_sizes or [round(0.1 * i, 10) for i in range(1, 11)]
    params = params or {}
    base = MD.complete_rows(df.select(id_col, *features, label), features, label)
    n = base.count()
    if cv < 2 or cv > n:
        raise ValueError(f"need 2 <= k <= n rows, got k={cv}, n={n}")
    # contiguous folds have fixed sizes: the first n mod k hold one row more
    counts = {j: n // cv + (1 if j < n % cv else 0) for j in range(cv)}
    n_train = n - max(counts.values())
    every = sorted({min(n_train, max(1, math.floor(s * n_train + 1e-9)) if s <= 1 else int(s)) for s in sizes})
    jobs = [(i, m) for i in range(cv) for m in every]
    lin = _linear_params(model_type, params)
    if lin is not None and len(features) <= MAX_GRAM_FEATURES:
        return _linear_learning_curve(base, id_col, features, label, counts, jobs, *lin)
    f = assign_folds(base, id_col, cv)
    f = global_rank(f, id_col, id_col, "_pos").persist()

    def one(job):
        i, m = job
        tr = f.where(F.col("fold") != i)
        # position within the training part: rows after the held-out fold move up by its size
        tpos = F.when(F.col("fold") < i, F.col("_pos")).otherwise(F.col("_pos") - F.lit(counts[i]))
        tr = tr.where(tpos <= m)
        model = MD.train(tr, features, label, model_type, **params)
        pr_tr = MD.predict(model, tr.select(*features, label)).select(label, "prediction")
        pr_te = MD.predict(model, f.where(F.col("fold") == i).select(*features, label)).select(label, "prediction")
        both = (pr_tr.withColumn("part", F.lit("train")).unionByName(pr_te.withColumn("part", F.lit("test"))))
        mt = regression_metrics(both, label, "prediction", group=["part"]).select("part", "rmse").collect()
        d = {r["part"]: r["rmse"] for r in mt}
        return (i, m, d.get("train"), d.get("test"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        results = list(ex.map(one, jobs))
    f.unpersist()
    spark = df.sparkSession
    pts = spark.createDataFrame(results, "fold int, train_size int, train_rmse double, test_rmse double")
    return (pts.groupBy("train_size").agg(F.avg("train_rmse").alias("train_rmse_mean"),
                                          F.stddev_pop("train_rmse").alias("train_rmse_std"),
                                          F.avg("test_rmse").alias("test_rmse_mean"),
                                          F.stddev_pop("test_rmse").alias("test_rmse_std")))


def diagnose(curve: DataFrame) -> DataFrame:
    """F13 diagnosis on the last point (largest train size), rules in order:
    test > 2*train -> overfitting; both > 0.9*max -> underfitting;
    gap < 0.2*test and test < 0.7*max -> good fit; else more data may help."""
    mx = curve.agg(F.greatest(F.max("train_rmse_mean"), F.max("test_rmse_mean")).alias("mx")).first()["mx"]
    last = curve.orderBy(F.col("train_size").desc()).limit(1)
    tr, te = F.col("train_rmse_mean"), F.col("test_rmse_mean")
    gap = te - tr
    dx = (F.when(te > 2 * tr, "overfitting")
          .when((tr > 0.9 * F.lit(mx)) & (te > 0.9 * F.lit(mx)), "underfitting")
          .when((gap < 0.2 * te) & (te < 0.7 * F.lit(mx)), "good fit")
          .otherwise("more data may help"))
    return last.select("train_size", "train_rmse_mean", "test_rmse_mean", gap.alias("gap"), dx.alias("diagnosis"))


def _sse(stats, means, w, b) -> float:
    """Sum of squared errors of y - (b + w.x) from centred sums."""
    n, sx, sy, sxx, sxy, syy = stats
    c = b + w @ means[:-1] - means[-1]  # the intercept for centred columns
    return float(syy - 2 * c * sy - 2 * w @ sxy + n * c * c + 2 * c * (w @ sx) + w @ sxx @ w)


def _linear_learning_curve(f: DataFrame, id_col: str, features, label, counts: dict, jobs, alpha: float,
                           fit_intercept: bool) -> DataFrame:
    """All (fold, size) fits of OLS / ridge from ONE aggregate.

    Every training set is a prefix of the id order with the held-out fold
    removed, so it is a difference of prefix sums taken at a few cut
    positions. Rows are summed per segment between cuts (segments from
    ``label_by_position``: only the cut rows are found, no row is
    numbered); train and test errors follow from the same sums in closed
    form.
    """
    p = len(features)
    folds = sorted(counts)
    start = {}
    acc = 0
    for k in folds:  # folds are contiguous in id order
        start[k] = acc
        acc += counts[k]
    cuts = set()
    for i, m in jobs:
        cuts.update({start[i], start[i] + counts[i]})
        cuts.add(m if m <= start[i] else m + counts[i])
    cuts = sorted(c for c in cuts if c > 0)
    # segment j holds the positions in (cuts[j-1], cuts[j]]
    _, seg = label_by_position(f, id_col, id_col, lambda n: [c + 1 for c in cuts], "_seg")
    means = column_means(f, [*features, label])
    rows = centred_sums(seg, "_seg", features, label, means)  # one row per segment

    zero = [0, np.zeros(p), 0.0, np.zeros((p, p)), np.zeros(p), 0.0]
    prefix = [zero]  # prefix[j] = sums over positions <= cuts[j-1]
    for j in range(len(cuts) + 1):
        seg_stats = rows.get(j, zero)
        prefix.append([a + b for a, b in zip(prefix[-1], seg_stats)])
    at = {0: prefix[0]}
    for j, c in enumerate(cuts):
        at[c] = prefix[j + 1]

    def diff(a, b):
        return [x - y for x, y in zip(a, b)]

    out = []
    for i, m in jobs:
        held = diff(at[start[i] + counts[i]], at[start[i]])
        train = at[m] if m <= start[i] else diff(at[m + counts[i]], held)
        w, b = solve_linear(train, means, alpha, fit_intercept)
        tr = math.sqrt(max(_sse(train, means, w, b), 0.0) / train[0])
        te = math.sqrt(max(_sse(held, means, w, b), 0.0) / held[0])
        out.append((i, m, tr, te))
    spark = f.sparkSession
    pts = spark.createDataFrame(out, "fold int, train_size int, train_rmse double, test_rmse double")
    return (pts.groupBy("train_size").agg(F.avg("train_rmse").alias("train_rmse_mean"),
                                          F.stddev_pop("train_rmse").alias("train_rmse_std"),
                                          F.avg("test_rmse").alias("test_rmse_mean"),
                                          F.stddev_pop("test_rmse").alias("test_rmse_std")))
