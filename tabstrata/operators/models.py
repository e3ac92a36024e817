"""Regression models (F1-F9) on Spark ML.

Every model is a ``PipelineModel`` of (VectorAssembler, estimator), so
prediction is ``transform`` (F8), persistence is Spark ML's (A4/A5), and
the same object scores a streaming DataFrame.

Penalty translation (so the fitted coefficients equal the usual
closed-form / coordinate-descent definitions; ``standardization=False``):
  ridge  min ||y - Xw||^2 + a ||w||^2         -> regParam = a / n * sd_y (ddof 0), elasticNetParam 0, solver normal
  lasso  min 1/(2n)||y - Xw||^2 + a ||w||_1   -> regParam = a, elasticNetParam 1
  enet   min 1/(2n)||..||^2 + a r ||w||_1 + a (1 - r)/2 ||w||^2
                                              -> regParam = a r + a (1 - r) sd_y, elasticNetParam = a r / regParam
Spark scales the L2 part by the label's standard deviation internally,
hence the sd_y factor.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

MODEL_TYPES = ("linear", "ridge", "lasso", "elasticnet", "random_forest", "gradient_boosting", "svr")
NORMAL_SOLVER_MAX_FEATURES = 4096  # Spark's limit for solver="normal"


MAX_TREE_DEPTH = 30  # the deepest tree Spark ML grows


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def _label_sd(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(F.col(label)).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("sd")).first()
    return int(row["n"]), float(row["sd"] or 0.0)


def estimator(model_type: str, df: DataFrame | None = None, label: str = "label", **kw):
    """The Spark estimator for a model type with its usual defaults; unknown parameters raise."""
    known = {"linear": ("fit_intercept",), "ridge": ("alpha", "fit_intercept", "max_iter", "tol"), "lasso": ("alpha", "l1_ratio", "fit_intercept", "max_iter", "tol"),  # the ratio is 1 for it
            
             "elasticnet": ("alpha", "l1_ratio", "fit_intercept", "max_iter", "tol"),
             "random_forest": ("n_estimators", "max_depth", "min_samples_leaf", "max_bins", "random_state"),
             "gradient_boosting": ("n_estimators", "learning_rate", "max_depth", "subsample", "max_bins", "random_state")}
    odd = set(kw) - set(known.get(model_type, kw)) - {"n_features"}
    if odd:
        raise ValueError(f"{model_type} has no parameter {sorted(odd)}")
    if model_type == "linear":
        return LinearRegression(labelCol=label, solver="normal", regParam=0.0, elasticNetParam=0.0,
                                fitIntercept=kw.get("fit_intercept", True), standardization=False)
    if model_type in ("ridge", "lasso", "elasticnet"):
        alpha = float(kw.get("alpha", 1.0))
        fit_intercept = kw.get("fit_intercept", True)
        # the normal solver aggregates X'X once and iterates on that p x p system, so a tight
        # tolerance is free; above its feature limit Spark's L-BFGS/OWL-QN passes over the rows
        n_features = int(kw.get("n_features", 0))
        solver = "normal" if n_features <= NORMAL_SOLVER_MAX_FEATURES else "l-bfgs"
        if model_type == "lasso":
            reg, en = alpha, 1.0
        else:
            n, sd = _label_sd(df, label)
            if solver != "normal" and n > 1:  # L-BFGS scales the L2 part with the sample std
                sd = sd * math.sqrt(n / (n - 1))
            if model_type == "ridge":
                reg, en = (alpha / n * sd if n else 0.0), 0.0
            else:
                rho = float(kw.get("l1_ratio", 0.5))
                reg = alpha * rho + alpha * (1 - rho) * sd
                en = alpha * rho / reg if reg else 0.0
        return LinearRegression(labelCol=label, regParam=reg, elasticNetParam=en, solver=solver,
                                fitIntercept=fit_intercept, standardization=False,
                                maxIter=int(kw.get("max_iter", 10000)), tol=float(kw.get("tol", 1e-9)))
    if model_type == "random_forest":
        depth = kw.get("max_depth")  # None, the default: as deep as Spark grows trees
        depth = MAX_TREE_DEPTH if depth is None else min(int(depth), MAX_TREE_DEPTH)
        return RandomForestRegressor(labelCol=label, numTrees=int(kw.get("n_estimators", 100)),
                                     maxDepth=depth, featureSubsetStrategy="all",
                                     minInstancesPerNode=int(kw.get("min_samples_leaf", 1)),
                                     maxBins=int(kw.get("max_bins", 64)), seed=int(kw.get("random_state", 42)))
    if model_type == "gradient_boosting":
        return GBTRegressor(labelCol=label, maxIter=int(kw.get("n_estimators", 100)),
                            stepSize=float(kw.get("learning_rate", 0.1)), maxDepth=int(kw.get("max_depth", 3)),
                            subsamplingRate=float(kw.get("subsample", 1.0)), maxBins=int(kw.get("max_bins", 64)),
                            seed=int(kw.get("random_state", 42)))
    raise ValueError(f"Unknown model type: {model_type}")


def complete_rows(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows without a null or NaN in the features or the label: what every fit and every validation uses."""
    return df.dropna(subset=[*features, label])


def train(df: DataFrame, features: list[str], label: str, model_type: str = "linear", **kw) -> PipelineModel:
    """Fit (assembler -> estimator) on the complete rows of ``df``; F7 goes through ``train_svr``
    or, with ``exact``, ``kernel_svr.train_kernel_svr``.

    A random forest is grown by ``forest.train_forest`` (exact splits, no depth
    limit); with ``max_bins`` it is Spark's own, binned and 30 levels deep at most.
    """
    if model_type == "svr" and kw.pop("exact", False):
        from .kernel_svr import train_kernel_svr
        return train_kernel_svr(df, features, label, **kw)
    if model_type == "svr":
        return train_svr(df, features, label, **kw)
    if model_type == "random_forest" and "max_bins" not in kw:
        from .forest import train_forest
        odd = set(kw) - {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "random_state", "bootstrap", "node_rows"}
        if odd:
            raise ValueError(f"{model_type} has no parameter {sorted(odd)}")
        return train_forest(df, features, label, **kw)
    d = complete_rows(df, features, label).select(*features, F.col(label).cast("double").alias(label))
    est = estimator(model_type, d, label, n_features=len(features), **kw)
    if model_type == "gradient_boosting" and est.getSubsamplingRate() == 1.0:
        grouped = _grouped(d, features, label, est.getMaxBins())
        if grouped is not None:
            try:
                return Pipeline(stages=[assembler(features), est.setWeightCol("_n")]).fit(grouped)
            finally:
                grouped.unpersist()
    return Pipeline(stages=[assembler(features), est]).fit(d)


def _grouped(d: DataFrame, features: list[str], label: str, max_bins: int) -> DataFrame | None:
    """Rows of equal features as one row (mean label, weight ``_n``), cached; None if that gives other trees or little.

    Trees of squared loss depend on such rows only through their number and
    mean. The candidate cuts are the same while every feature has fewer values
    than bins, as all of them are cuts then; grouping pays from ten rows a group.
    """
    told = d.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*features)).alias("groups"),
                 *[F.approx_count_distinct(c).alias(f"v{j}") for j, c in enumerate(features)]).first()
    if told["groups"] * 10 > told["n"] or max(told[f"v{j}"] for j in range(len(features))) > 1.2 * max_bins:
        return None
    g = d.groupBy(*features).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("_n"))
    g = g.coalesce(max(1, math.ceil(told["groups"] / 50_000))).persist()
    exact = g.agg(*[F.count_distinct(c).alias(f"v{j}") for j, c in enumerate(features)]).first()
    if max(exact) >= max_bins:
        g.unpersist()
        return None
    return g


def predict(model, df: DataFrame) -> DataFrame:
    """F8: add a ``prediction`` column (the assembler's vector column is dropped)."""
    return model.transform(df).drop("features")


def coefficients(model: PipelineModel, features: list[str]) -> DataFrame:
    """Coefficients and intercept of a fitted linear stage (one row per feature)."""
    lr = model.stages[-1]
    spark = _spark()
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def feature_importances(model, features: list[str], top_n: int | None = None) -> DataFrame:
    """Tree importances, else |coefficient|; sorted descending, optionally the top n.

    The table has one row per feature (driver-sized by construction).
    """
    last = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        vals = np.abs(last.coefficients.toArray())
    else:
        raise ValueError("model does not expose feature importances")
    spark = _spark()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, vals)], "feature string, importance double")
    out = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return out.limit(top_n) if top_n else out


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


# --------------------------------------------------------------------------------------
# kernel SVR approximated with random Fourier features
# --------------------------------------------------------------------------------------
@dataclass
class SVRModel:
    """RBF-kernel SVR approximation: z(x) = sqrt(2/D) cos(W s(x) + b) with
    W ~ N(0, 2 gamma), b ~ U(0, 2 pi) (Rahimi & Recht 2007), and a linear
    epsilon-insensitive fit on z. s() standardizes the features (E3)."""
    features: list[str]
    center: np.ndarray
    scale: np.ndarray
    W: np.ndarray
    b: np.ndarray
    coef: np.ndarray
    intercept: float
    gamma: float
    approximation: str = "random Fourier features"
    kernel: str = "rbf"

    def _z(self, X: np.ndarray) -> np.ndarray:
        S = (X - self.center) / self.scale
        if self.kernel == "linear":
            return S
        return math.sqrt(2.0 / self.W.shape[1]) * np.cos(S @ self.W + self.b)

    def save(self, spark, path: str) -> None:
        """The parameters as one JSON row in ``path``."""
        state = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in self.__dict__.items()}
        spark.createDataFrame([(json.dumps(state),)], "svr string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark, path: str) -> SVRModel:
        state = json.loads(spark.read.text(path).first()[0])
        return SVRModel(**{k: np.array(v) if k in ("center", "scale", "W", "b", "coef") else v for k, v in state.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        feats, me = self.features, self
        schema = StructType(list(df.schema.fields) + [StructField("prediction", DoubleType())])

        def score(it):
            for pdf in it:
                X = pdf[feats].to_numpy(dtype=np.float64)
                pdf = pdf.copy()
                pdf["prediction"] = me._z(X) @ me.coef + me.intercept
                yield pdf
        return df.mapInPandas(score, schema)


def train_svr(df: DataFrame, features: list[str], label: str, C: float = 1.0, epsilon: float = 0.1,
              gamma: str | float = "scale", n_components: int = 200, iterations: int = 30, seed: int = 42,
              scale_data: bool = True, tol: float = 1e-6, kernel: str = "rbf") -> SVRModel:
    """approximate RBF SVR (C 1, epsilon 0.1, gamma 'scale'), primal objective
    1/2 ||w||^2 + C * sum_i max(0, |y_i - z_i.w - b| - epsilon) on random Fourier features z.

    Solved by iteratively reweighted least squares for the epsilon-insensitive
    loss (Perez-Cruz et al. 2000): rows outside the tube get weight
    C / (|r| - epsilon) and target y - epsilon * sign(r); each iteration is ONE
    distributed pass summing Z'AZ, Z'A1, 1'A1, Z'Ay', 1'Ay' per partition
    (a (D+1) x (D+1) system, D = n_components), solved on the driver. The
    training rows are persisted for the iterations. Rows with a null feature or
    label are left out. ``kernel`` may be rbf or linear (z(x) is then the scaled
    features themselves).
    """
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"unknown kernel {kernel!r}: rbf or linear")
    from ..operators.prepare import fit_scaler
    d = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y")) \
          .dropna()
    if scale_data:
        sc = fit_scaler(d, "standard", features)
        center = np.array([sc.params[c][0] for c in features])
        scale = np.array([sc.params[c][1] for c in features])
    else:
        center, scale = np.zeros(len(features)), np.ones(len(features))
    if gamma == "scale":
        # 1 / (n_features * Var(all feature values)) on the (scaled) data
        st = d.agg(*[F.avg(((F.col(c) - float(center[i])) / float(scale[i]))).alias(f"m{i}") for i, c in enumerate(features)],
                   *[F.avg(((F.col(c) - float(center[i])) / float(scale[i])) ** 2).alias(f"q{i}") for i, c in enumerate(features)]).first()
        m = np.mean([st[f"m{i}"] for i in range(len(features))])
        q = np.mean([st[f"q{i}"] for i in range(len(features))])
        var = q - m * m
        g = 1.0 / (len(features) * var) if var > 0 else 1.0
    else:
        g = float(gamma)
    rng = np.random.default_rng(seed)
    if kernel == "linear":
        n_components = len(features)
        W, b = np.eye(n_components), np.zeros(n_components)
    else:
        W = rng.normal(0.0, math.sqrt(2.0 * g), size=(len(features), n_components))
        b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    start_b = d.agg(F.percentile_approx("_y", 0.5, 10000)).first()[0] or 0.0
    model = SVRModel(features, center, scale, W, b, np.zeros(n_components), float(start_b), g, kernel=kernel)
    d = d.persist()
    D = n_components
    prev = None
    for _ in range(iterations):
        coef, icpt, me = model.coef.copy(), model.intercept, model

        def normal_eq(batches):
            M = np.zeros((D + 1, D + 1))
            v = np.zeros(D + 1)
            obj = 0.0
            for pdf in batches:
                X = pdf[features].to_numpy(dtype=np.float64)
                y = pdf["_y"].to_numpy(dtype=np.float64)
                Z = np.c_[me._z(X), np.ones(len(y))]
                r = y - (Z[:, :D] @ coef + icpt)
                out = np.abs(r) - epsilon
                obj += C * np.maximum(out, 0.0).sum()
                a = np.where(out > 0, C / np.maximum(out, 1e-8), 0.0)
                yt = y - epsilon * np.sign(r)
                Za = Z * a[:, None]
                M += Z.T @ Za
                v += Za.T @ yt
            yield pd.DataFrame({"g": [np.concatenate([M.ravel(), v, [obj]]).tobytes()]})

        def added(batches):
            total = 0.0
            for pdf in batches:
                for g in pdf["g"]:
                    total = total + np.frombuffer(g)
            if not np.isscalar(total):
                yield pd.DataFrame({"g": [total.tobytes()]})

        # one pass per iteration: a row per partition, added up in about the root of their number of tasks
        some = max(1, int(math.sqrt(d.rdd.getNumPartitions())))
        rows = d.mapInPandas(normal_eq, "g binary").repartition(some).mapInPandas(added, "g binary").collect()
        flat = sum((np.frombuffer(r["g"]) for r in rows), np.zeros((D + 1) * (D + 1) + D + 2))
        M = flat[:(D + 1) * (D + 1)].reshape(D + 1, D + 1)
        v = flat[(D + 1) * (D + 1):-1]
        obj = 0.5 * float(coef @ coef) + float(flat[-1])
        if prev is not None and abs(prev - obj) <= tol * max(abs(prev), 1.0):
            break
        prev = obj
        reg = np.eye(D + 1)
        reg[D, D] = 1e-12  # the intercept is not penalized
        sol = np.linalg.solve(M + reg, v)
        model.coef, model.intercept = sol[:D], float(sol[D])
    d.unpersist()
    return model
