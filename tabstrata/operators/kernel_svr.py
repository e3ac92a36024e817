"""exact epsilon-insensitive support vector regression with an RBF kernel.

The dual is  min 1/2 b'Kb - y'b + epsilon |b|_1  with  sum b = 0, |b_i| <= C.
The kernel of few smooth features has few directions that count, so most of the
way is a Newton fit (``_newton``): pivots are picked until the kernel of every
row is the inner product of ``r`` numbers made of its kernel with the pivots
(``_factor``; the pool they are picked from is a bounded sample and then the rows
of the table that it fails), and the primal problem in these ``r`` weights, with
its loss rounded within ``tol`` / 4 of the two kinks, is solved by passes over the
table that sum gradient and Hessian. Rows lie sorted, so rows of equal features
share their kernel values. Its rows' coefficients, with kernel sums by the exact
kernel, are where decomposition starts; it ends there at once if no row violates.
Kernels with more than ``MAX_RANK`` such directions are decomposed from zero.

Decomposition: the table keeps each row's coefficient b and
kernel sum f = (K b)_i. A pass picks the ``working`` rows that violate the
optimality conditions most (half of them want to rise, half to fall), the
problem in those few coefficients is solved exactly with the others fixed
(``solve``), and the next pass adds the change to every row's kernel sum. So a
pass is one scan with rows x ``working`` kernel values and bounded memory, and
nothing but the working rows comes to the driver. The coefficients keep their
sum (0, after the Newton fit within ``tol`` / 100). It ends when no row of the
table violates the conditions by more than ``tol``; the number of rows that do
is part of the model. The kernel sums are those of an exact solver, different rows
x different support vectors: where these are many, ``models.train_svr``
approximates the kernel.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import scratch_path

#: Support vectors that are sent to the tasks at once when predicting.
MAX_VECTORS = 100_000
#: Kernel values that a task holds at once.
BLOCK = 1 << 18
#: Directions of the kernel at most for the Newton fit (its Hessian is summed in the driver), and the square of a row's part outside them.
MAX_RANK = 1_000
RESIDUAL = 1e-10
#: Different rows that pivots are first picked from, and those added at once where they fall short.
POOL = 4_000
#: Steps tried along a direction in one pass; the first is the one whose gradient and Hessian are summed.
STEPS = 0.5 ** np.arange(20)
#: Rows a partition of the sorted table, about, where there are more of them than cores.
ROWS = 100_000


def kernel(A: np.ndarray, B: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma |a - b|^2) of all pairs; distances are summed one coordinate at a time, so equal rows have exactly 1."""
    sq = np.zeros((len(A), len(B)))
    for j in range(A.shape[1]):
        d = A[:, j][:, None] - B[:, j][None, :]
        sq += d * d
    return np.exp(-gamma * sq)


def _sums(A: np.ndarray, B: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    step = max(1, BLOCK // max(1, len(B)))
    own, at = np.unique(A, axis=0, return_inverse=True)
    return np.concatenate([kernel(own[k : k + step], B, gamma) @ b for k in range(0, len(own), step)] or [np.zeros(0)])[at.ravel()]


def _pivots(Z: np.ndarray, gamma: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Pivots among the rows of Z (pivoted Cholesky) and the matrix that maps kernel values with them to coordinates whose inner products are the kernel; None if more than ``MAX_RANK`` are needed."""
    left, chosen = np.ones(len(Z)), []
    L = np.zeros((len(Z), min(len(Z), MAX_RANK)))
    while len(chosen) < len(Z) and left.max() > RESIDUAL:
        i, k = int(np.argmax(left)), len(chosen)
        if k == MAX_RANK:
            return None
        L[:, k] = (kernel(Z, Z[i : i + 1], gamma)[:, 0] - L[:, :k] @ L[i, :k]) / math.sqrt(left[i])
        left -= L[:, k] ** 2
        left[i] = 0.0
        chosen.append(i)
    return Z[chosen], np.linalg.inv(L[chosen, : len(chosen)]).T


def _factor(state: DataFrame, features: list[str], gamma: float) -> tuple[np.ndarray, np.ndarray] | None:
    """``_pivots`` that hold for every row of the table: the rows they fail are added to the pool, the worst first."""
    spark = state.sparkSession
    pool = state.select(*features).distinct().orderBy(F.xxhash64(*features), *features).limit(POOL).toPandas().to_numpy(np.float64)
    before = 0
    while (found := _pivots(pool, gamma)) is not None:
        if len(found[0]) <= before:  # what is left is rounding
            return found
        before = len(found[0])
        given = spark.sparkContext.broadcast(found)

        def outside(batches, given=given):
            P, M = given.value
            for pdf in batches:
                X = np.unique(pdf[features].to_numpy(np.float64), axis=0)
                left = 1.0 - ((kernel(X, P, gamma) @ M) ** 2).sum(1)
                yield pd.DataFrame(X, columns=features).assign(_left=left)[left > 10 * RESIDUAL]

        kinds = StructType([StructField(c, DoubleType()) for c in [*features, "_left"]])
        worst = state.select(*features).mapInPandas(outside, kinds).groupBy(*features).agg(F.max("_left").alias("_left"))
        worst = worst.orderBy(F.desc("_left"), *features).limit(POOL).toPandas()[features].to_numpy(np.float64)
        if not len(worst):
            return found
        pool = np.unique(np.concatenate([found[0], worst]), axis=0)
    return None


def _loss(e: np.ndarray, C: float, epsilon: float, width: float) -> np.ndarray:
    """Loss of the residuals e, rounded within ``width`` / 2 of the kinks."""
    s = (np.abs(e) - epsilon) / width + 0.5
    out = np.clip(s, 0.0, 1.0) ** 2 / 2 + np.maximum(s - 1.0, 0.0)
    if 2 * epsilon < width:  # both kinks are felt near 0
        s = (-np.abs(e) - epsilon) / width + 0.5
        out += np.clip(s, 0.0, 1.0) ** 2 / 2
    return C * width * out


def _ramps(e: np.ndarray, C: float, epsilon: float, width: float, zone: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the loss (a row's coefficient) and its curvature; with ``zone`` as if the rows that a rounding of that width covers stayed on their slopes."""
    slope, curve = np.zeros_like(e), np.zeros_like(e)
    for sign in (1.0, -1.0):
        s = (sign * e - epsilon) / (zone or width) + 0.5
        on = (s > 0) & (s < 1)
        slope += sign * C * np.where(on, (sign * e - epsilon) / width + 0.5, np.clip(s, 0.0, 1.0))
        curve += (C / width) * on
    return slope, curve


def _newton(state: DataFrame, features: list[str], gamma: float, C: float, epsilon: float, tol: float, most: int):
    """(pivots, map, weights with the constant last, width of the rounding, passes) of the rounded primal problem, or None.

    The width shrinks from the spread of the labels to ``tol`` / 2, where rows
    whose coefficient is neither 0 nor C are within ``tol`` / 4 of a kink.
    """
    found = _factor(state, features, gamma)
    if found is None:
        return None
    spark, r = state.sparkSession, found[0].shape[0]
    given = spark.sparkContext.broadcast(found)

    def sums(at: np.ndarray, step: np.ndarray, width: float, zone: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Losses along ``step``, and the losses' gradient and Hessian at its end."""
        moves = bool(step.any())

        def part(batches):
            P, M = given.value
            loss, grad, curves = np.zeros(len(STEPS)), np.zeros(r + 1), np.zeros((r + 1, r + 1))
            for pdf in batches:
                X, y = pdf[features].to_numpy(np.float64), pdf["_y"].to_numpy(np.float64)
                first = np.flatnonzero(np.r_[True, (X[1:] != X[:-1]).any(1)])  # equal rows lie together
                count = np.diff(np.r_[first, len(X)])
                A = np.c_[kernel(X[first], P, gamma) @ M, np.ones(len(first))]
                e, de = y - np.repeat(A @ at, count), np.repeat(A @ step, count)
                for k, t in enumerate(STEPS if moves else STEPS[:1]):
                    loss[k] += _loss(e - t * de, C, epsilon, width).sum()
                slope, curve = _ramps(e - de, C, epsilon, width, zone)
                grad -= A.T @ np.add.reduceat(slope, first)
                curve = np.add.reduceat(curve, first)
                hit = curve > 0
                curves += A[hit].T @ (A[hit] * curve[hit, None])
            yield pd.DataFrame({"sums": [np.concatenate([loss, grad, curves.ravel()]).tobytes()]})

        whole = state.select(*features, "_y").mapInPandas(part, "sums binary").rdd.map(lambda x: np.frombuffer(x[0])).treeReduce(np.add)
        k = len(STEPS)
        return whole[:k], whole[k : k + r + 1], whole[k + r + 1 :].reshape(r + 1, r + 1)

    inner = np.r_[np.ones(r), 0.0]  # the constant has no penalty
    height = lambda v: float((inner * v * v).sum() / 2)
    label = state.agg(F.avg("_y").alias("m"), F.stddev_pop("_y").alias("s")).first()
    v, none = np.r_[np.zeros(r), label["m"]], np.zeros(r + 1)
    last, passes = tol / 2, 0
    width, zone = max(last, 2.0 * label["s"]), None
    while True:
        losses, grad, curves = sums(v, none, width, zone)
        passes += 1
        value, grad = height(v) + losses[0], grad + inner * v
        while True:
            size = float(np.linalg.norm(grad))
            if zone is None and (size <= (tol / 100 if width <= last else 0.01 * C) or passes >= most):
                break
            # rows that are all beyond the kinks leave the constant free: a little is added
            H = curves + np.diag(inner) + 1e-10 * np.trace(curves) / (r + 1) * np.diag(1.0 - inner) + 1e-12 * np.eye(r + 1)
            step = -np.linalg.solve(H, grad)
            losses, g, h = sums(v, step, width)
            passes += 1
            values = np.array([height(v + t * step) for t in STEPS]) + losses
            g, k = g + inner * (v + step), int(np.argmin(values))
            if values[0] <= value + 1e-4 * float(grad @ step) or zone is None and np.linalg.norm(g) <= size / 2:
                v, value, grad, curves, zone = v + step, values[0], g, h, None
                continue
            if values[k] < value:
                v = v + STEPS[k] * step
            elif zone is None:  # no step helps any more
                break
            losses, grad, curves = sums(v, none, width)
            passes, zone = passes + 1, None
            value, grad = height(v) + losses[0], grad + inner * v
        if width <= last or passes >= most:
            return (*found, v, width, passes) if width <= last and size <= tol else None
        width, zone = max(last, width / 3), width  # the first step keeps the rows that the last rounding covers on their slopes


def rises(b, f, y, epsilon: float):
    """Slope of the objective when a coefficient rises."""
    return f - y + np.where(b >= 0, epsilon, -epsilon)


def falls(b, f, y, epsilon: float):
    """Slope of the objective when a coefficient rises, seen from below: it may fall while this is above the slopes of those that rise."""
    return f - y + np.where(b > 0, epsilon, -epsilon)


def solve(K: np.ndarray, y: np.ndarray, b: np.ndarray, f: np.ndarray, C: float, epsilon: float, tol: float, most: int = 200_000) -> np.ndarray:
    """New coefficients of the working rows: pairs are moved against each other until none violates by ``tol``.

    ``f`` are the kernel sums over all rows of the table. The rising partner
    is the worst one, the falling one promises the largest decrease. A
    coefficient that reaches 0 stops there, as the slope changes.
    """
    b, f = b.copy(), f.copy()
    diagonal = np.diag(K)
    for _ in range(most):
        up = np.where(b < C, rises(b, f, y, epsilon), np.inf)
        down = np.where(b > -C, falls(b, f, y, epsilon), -np.inf)
        i = int(np.argmin(up))
        gain = down - up[i]
        if gain.max() <= tol:
            break
        curve = np.maximum(K[i, i] + diagonal - 2 * K[i], 1e-12)
        j = int(np.argmax(np.where(gain > 0, gain * gain / curve, -1.0)))
        t = min(gain[j] / curve[j], C - b[i], C + b[j])
        t = min(t, -b[i] if b[i] < 0 else t, b[j] if b[j] > 0 else t)
        bi, bj = b[i] + t, b[j] - t
        b[i], b[j] = (C if C - bi < 1e-12 * C else 0.0 if abs(bi) < 1e-15 else bi), (-C if C + bj < 1e-12 * C else 0.0 if abs(bj) < 1e-15 else bj)
        f += t * (K[i] - K[j])
    return b


@dataclass
class KernelSVR:
    """Support vectors (features as scaled, _b) in ``path``, intercept, and how the fit ended."""

    features: list[str]
    center: list[float]
    scale: list[float]
    gamma: float
    intercept: float
    path: str
    n_vectors: int
    #: Rows whose optimality condition is violated by more than the tolerance, passes made, dual objective.
    violators: int
    passes: int
    objective: float

    def save(self, spark: SparkSession, path: str) -> None:
        spark.read.parquet(self.path).write.mode("overwrite").parquet(f"{path}/vectors")
        spark.createDataFrame([(json.dumps({k: v for k, v in self.__dict__.items() if k != "path"}),)], "svr string").coalesce(1).write.mode("overwrite").text(f"{path}/kernel_svr")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KernelSVR:
        return KernelSVR(path=f"{path}/vectors", **json.loads(spark.read.text(f"{path}/kernel_svr").first()[0]))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction``; null where a feature is null. Vectors beyond ``MAX_VECTORS`` take further scans, each written before the next."""
        spark, feats, gamma = df.sparkSession, self.features, self.gamma
        center, scale = np.array(self.center), np.array(self.scale)
        vectors = spark.read.parquet(self.path)
        blocks = max(1, math.ceil(self.n_vectors / MAX_VECTORS))
        out = df.withColumn("prediction", F.lit(self.intercept))
        for k in range(blocks):
            part = vectors.where(F.pmod(F.xxhash64(*feats), F.lit(blocks)) == k).toPandas()
            given = spark.sparkContext.broadcast((part[feats].to_numpy(np.float64), part["_b"].to_numpy(np.float64)))

            def add(batches, given=given):
                V, b = given.value
                for pdf in batches:
                    X = (pdf[feats].to_numpy(np.float64) - center) / scale
                    pdf = pdf.copy()
                    pdf["prediction"] = pdf["prediction"].to_numpy(np.float64) + _sums(X, V, b, gamma)
                    yield pdf

            out = out.mapInPandas(add, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))
            if k < blocks - 1:
                path = scratch_path(spark, "svr-predictions")
                out.write.parquet(path)
                out = spark.read.parquet(path)
        return out.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def train_kernel_svr(df: DataFrame, features: list[str], label: str, C: float = 1.0, epsilon: float = 0.1, gamma: str | float = "scale", scale_data: bool = True, tol: float = 1e-3, working: int = 1000, max_passes: int = 10_000) -> KernelSVR:
    """exact RBF SVR on the complete rows of ``df`` (C 1, epsilon 0.1, gamma 'scale', as the reference)."""
    from .prepare import fit_scaler
    spark, p = df.sparkSession, len(features)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y")).dropna()
    center, scale = [0.0] * p, [1.0] * p
    if scale_data:
        fitted = fit_scaler(d, "standard", features).params
        center, scale = [fitted[c][0] for c in features], [fitted[c][1] for c in features]
    d = d.select(*[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(features, center, scale)], "_y")
    if gamma == "scale":  # 1 / (features * variance of all their values)
        one = d.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(c)).alias(f"{f.__name__}{i}") for i, c in enumerate(features) for f in (F.avg, F.var_pop)]).first()
        if not one["n"]:
            raise ValueError("no complete row to fit")
        means, spread = [one[f"avg{i}"] for i in range(p)], [one[f"var_pop{i}"] for i in range(p)]
        variance = float(np.mean(spread) + np.var(means))
        gamma = 1.0 / (p * variance) if variance > 0 else 1.0
    path = scratch_path(spark, "svr-state")
    d = d.withColumns({"_row": F.monotonically_increasing_id(), "_b": F.lit(0.0), "_f": F.lit(0.0)})
    n = d.count()
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n / ROWS))
    d.repartitionByRange(parts, *features, "_row").sortWithinPartitions(*features, "_row").write.parquet(path)
    state = spark.read.parquet(path)
    slope = F.col("_f") - F.col("_y")
    up = F.when(F.col("_b") < C, slope + F.when(F.col("_b") >= 0, epsilon).otherwise(-epsilon))
    down = F.when(F.col("_b") > -C, slope + F.when(F.col("_b") > 0, epsilon).otherwise(-epsilon))
    kinds = state.schema
    passes = 0
    start = _newton(state, features, gamma, C, epsilon, tol, min(max_passes, 1000)) if n > 2 * working else None  # few rows take fewer passes by decomposition
    if start is not None:
        *given, width, passes = start
        given = spark.sparkContext.broadcast(given)

        def begin(batches, given=given):
            P, M, v = given.value
            for pdf in batches:
                X = pdf[features].to_numpy(np.float64)
                first = np.flatnonzero(np.r_[True, (X[1:] != X[:-1]).any(1)])
                f = (kernel(X[first], P, gamma) @ M) @ v[:-1] + v[-1]
                yield pdf.assign(_b=_ramps(pdf["_y"].to_numpy(np.float64) - np.repeat(f, np.diff(np.r_[first, len(X)])), C, epsilon, width)[0])

        path = scratch_path(spark, "svr-state")
        state.mapInPandas(begin, kinds).write.parquet(path)
        state = spark.read.parquet(path)
        path, vectors = _vectors(state, features)
        whole = KernelSVR(list(features), [0.0] * p, [1.0] * p, float(gamma), 0.0, path, vectors, 0, passes, 0.0).transform(state)
        path = scratch_path(spark, "svr-state")
        whole.withColumn("_f", F.col("prediction")).select(*kinds.names).write.parquet(path)
        state = spark.read.parquet(path)
    while True:
        marked = state.withColumns({"_up": up, "_down": down})
        half = max(1, working // 2)
        rising = marked.where("_up IS NOT NULL").orderBy("_up", "_row").limit(half).toPandas()
        falling = marked.where("_down IS NOT NULL").orderBy(F.desc("_down"), "_row").limit(half).toPandas()
        low, high = float(rising["_up"].iloc[0]), float(falling["_down"].iloc[0])
        if high - low <= tol or passes >= max_passes:
            break
        rows = pd.concat([rising, falling]).drop_duplicates("_row")
        Z, b = rows[features].to_numpy(np.float64), rows["_b"].to_numpy(np.float64)
        new = solve(kernel(Z, Z, gamma), rows["_y"].to_numpy(np.float64), b, rows["_f"].to_numpy(np.float64), C, epsilon, tol / 2)
        moved = np.flatnonzero(new != b)
        given = spark.sparkContext.broadcast((rows["_row"].to_numpy()[moved], Z[moved], new[moved], (new - b)[moved]))

        def step(batches, given=given):
            ids, V, value, change = given.value
            order = np.argsort(ids)
            for pdf in batches:
                pdf = pdf.copy()
                pdf["_f"] = pdf["_f"].to_numpy(np.float64) + _sums(pdf[features].to_numpy(np.float64), V, change, gamma)
                own = pdf["_row"].to_numpy()
                at = order[np.minimum(np.searchsorted(ids, own, sorter=order), len(ids) - 1)]
                hit = ids[at] == own
                coefficient = pdf["_b"].to_numpy(np.float64).copy()
                coefficient[hit] = value[at[hit]]
                pdf["_b"] = coefficient
                yield pdf

        path = scratch_path(spark, "svr-state")
        state.mapInPandas(step, kinds).write.parquet(path)
        state, passes = spark.read.parquet(path), passes + 1
    middle = (low + high) / 2
    wrong = (F.col("_up") < middle - tol) | (F.col("_down") > middle + tol)
    told = state.withColumns({"_up": up, "_down": down}).agg(
        F.sum(F.coalesce(wrong, F.lit(False)).cast("long")).alias("v"),
        F.sum(F.col("_b") * F.col("_f") / 2 - F.col("_y") * F.col("_b") + F.lit(epsilon) * F.abs("_b")).alias("o")).first()
    path, vectors = _vectors(state, features)
    return KernelSVR(list(features), center, scale, float(gamma), -middle, path, vectors, int(told["v"]), passes, float(told["o"]))


def _vectors(state: DataFrame, features: list[str]) -> tuple[str, int]:
    """Path and number of the support vectors; rows of equal features are one, with the sum of their coefficients."""
    path = scratch_path(state.sparkSession, "svr-vectors")
    state.where("_b <> 0").groupBy(*features).agg(F.sum("_b").alias("_b")).where("_b <> 0").write.parquet(path)
    return path, state.sparkSession.read.parquet(path).count()
