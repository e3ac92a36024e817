"""Bundles (C30, F15) and end-to-end runs.

A bundle is a dict of named DataFrames; ``write_bundle`` stores each as a
table under an output folder on shared storage.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import density as DEN
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import profile as PR
from ..operators import relations as REL
from ..operators import tuning as TU
from ..session import scratch_path
from ..sources.io import load_models, save_model, write_table
from .pipeline import Preparation


def eda_report(df: DataFrame, target: str, id_col: str | None = None, max_cols: int = 6) -> dict[str, DataFrame]:
    """Distributions (histogram with automatic bins and density of every
    numeric column), correlation, target correlation, top-3 scatter lines,
    time columns, pair densities and box statistics, in that order.
    ``max_cols`` limits the pairs and the box statistics only. Persist ``df``
    first if it is dear to recompute: every part reads it."""
    d = df
    num = PR.numeric_columns(d, exclude=(id_col,) if id_col else ())
    feats = [c for c in num if c != target]
    out: dict[str, DataFrame] = {"describe": PR.describe(d, num), "missing": PR.missing(d)}
    for c in num:
        out[f"histogram_{c}"] = DEN.histogram(d, c, "auto")
        out[f"density_{c}"] = DEN.kde(d, c)
    out["correlation"] = REL.pearson_matrix(d, num)
    tc = REL.target_correlations(d, target, num)
    out["target_correlation"] = tc.orderBy(F.col("corr").desc_nulls_last(), "feature")
    top3 = [r["feature"] for r in tc.withColumn("a", F.abs("corr"))
            .orderBy(F.col("a").desc_nulls_last(), "feature").limit(3).collect()]
    for c in top3:
        out[f"scatter_line_{c}"] = REL.regression_line(d, c, target)
    for c in PR.columns_matching(d):
        if c in num and c != target:
            out[f"by_{c}"] = REL.group_mean_std(d, F.floor(F.col(c)).cast("int"), target, c)
    pc = DEN.pair_columns(d, target, num, max_cols)
    out["pair_density"] = DEN.pair_density(d, pc)
    out["box_stats"] = DEN.box_stats_columns(d, num[:max_cols])
    return out


def write_bundle(bundle: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_table(part, f"{folder.rstrip('/')}/{name}", fmt) for name, part in bundle.items()}


def evaluation_report(model, test: DataFrame, features: list[str], label: str, id_col: str,
                      name: str = "model", train: DataFrame | None = None, segments: int = 3,
                      params: dict | None = None, curve_folds: int = 5) -> dict[str, DataFrame]:
    """metrics, actual vs predicted, residual summary and bins,
    importance (skipped if the model has none), segments and, with a
    training set, the learning curve (fitted on the TRAINING rows with the
    model's own ``params``; every model type)."""
    pred = MD.predict(model, test.select(id_col, *features, label))
    out = {"metrics": M.with_fit_band(M.regression_metrics(pred, label, "prediction")).withColumn("model", F.lit(name)),
           "actual_vs_predicted": M.actual_vs_predicted(pred, label, "prediction"),
           "residual_stats": M.residual_stats(pred, label, "prediction"),
           "residual_bins": M.residual_bins(pred, label, "prediction"),
           "segments": M.segments(pred, label, "prediction", id_col, segments)}
    try:
        out["importance"] = MD.feature_importances(model, features)
    except (ValueError, AttributeError):
        pass
    if train is not None and name in MD.MODEL_TYPES:
        out["learning_curve"] = TU.learning_curve(train, features, label, id_col, name, cv=curve_folds, params=params)
    return out


def train_models(train: DataFrame, features: list[str], label: str, id_col: str,
                 model_types: list[str] = ("linear", "ridge", "random_forest"), tune: bool = False,
                 cv_folds: int = 0, params: dict | None = None, save_dir: str | None = None,
                 search_method: str = "random", n_iter: int = 10, tune_folds: int = 5,
                 tune_types: list[str] | None = None, grids: dict | None = None):
    """F16: fit the selected model set; returns (models, cross-validation summaries).

    With ``tune`` every type with a grid (or those in ``tune_types``) is
    searched as well and its best model added as ``<type>_tuned``.
    """
    params = params or {}
    models, cv = {}, {}
    t = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for mt in model_types:
            models[mt] = MD.train(t, features, label, mt, **params.get(mt, {}))
            if tune and mt in TU.GRIDS and (tune_types is None or mt in tune_types):
                models[f"{mt}_tuned"] = TU.search(t, features, label, id_col, mt, cv=tune_folds, search_method=search_method,
                                                  n_iter=n_iter, grid=(grids or {}).get(mt))[0]
            if cv_folds:
                cv[mt] = TU.cross_validate(t, features, label, id_col, mt, cv_folds, params.get(mt, {}))[1]
        for name, model in models.items():
            if save_dir:
                save_model(model, save_dir, name)
    finally:
        t.unpersist()
    return models, cv


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, in files for every task: each part of a run reads it, however dear it is to compute."""
    spark = df.sparkSession
    path = scratch_path(spark, "run-input")
    df.repartition(3 * spark.sparkContext.defaultParallelism).write.parquet(path)
    return spark.read.parquet(path)


def run(df: DataFrame, target: str, id_col: str, config: dict | None = None,
        model_types: list[str] = ("linear", "ridge", "random_forest"), params: dict | None = None,
        test_size=0.2, seed: int = 42, explore: bool = True, val_size=0.0, tune: bool = False,
        cv_folds: int = 0, load_dir: str | None = None, out_dir: str | None = None, report: bool = False,
        **tuning) -> dict:
    """explore -> split -> prepare (fit on train) -> train or load -> evaluate -> best (min MSE).

    ``load_dir``: models saved by an earlier run instead of training. The
    comparison is on the validation part if there is one, then the best model
    is scored on the test part as ``test``. ``report`` adds every model's
    evaluation bundle; with ``out_dir`` models and tables are written there.
    """
    t0 = time.time()
    from ..operators.prepare import split_dataset
    out: dict = {}
    df = _stored(df)
    if explore:
        out["eda"] = eda_report(df, target, id_col)
    train, val, test = split_dataset(df, id_col, target, test_size, val_size, seed, materialize=True)
    prep = Preparation(config).fit(train, target, id_col)
    tr, te = prep.transform(train), prep.transform(test)
    judged = prep.transform(val) if val is not None else te
    features = [c for c in PR.numeric_columns(tr) if c not in (target, id_col)]
    cv: dict = {}
    if load_dir:
        models = load_models(df.sparkSession, load_dir)
    else:
        models, cv = train_models(tr, features, target, id_col, model_types, tune, cv_folds, params,
                                  f"{out_dir.rstrip('/')}/models" if out_dir else None, **tuning)
    preds = None
    for name, m in models.items():
        p = MD.predict(m, judged.select(*features, target)).select(F.lit(name).alias("model"), target, "prediction")
        preds = p if preds is None else preds.unionByName(p)
    comparison = M.compare_models(preds, target, "prediction", metric="mse")
    out.update({"features": features, "models": models, "cv": cv, "comparison": comparison, "best": comparison.limit(1)})
    if val is not None:
        best = comparison.first()["model"]
        out["test"] = M.regression_metrics(MD.predict(models[best], te.select(*features, target)), target, "prediction")
    if report:
        out["reports"] = {name: evaluation_report(m, te, features, target, id_col, name, tr, params=(params or {}).get(name))
                          for name, m in models.items()}
    if out_dir:
        tables = {"comparison": comparison, **{f"cv_{k}": v for k, v in cv.items()}, **{f"eda/{k}": v for k, v in out.get("eda", {}).items()}}
        tables |= {f"report/{name}/{k}": v for name, r in out.get("reports", {}).items() for k, v in r.items()}
        out["written"] = write_bundle(tables, out_dir)
    out["seconds"] = time.time() - t0
    return out
