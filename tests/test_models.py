"""Rows-only operators checked by invariants: penalized fits against coordinate
descent, planted outliers, learning-curve diagnosis rules, fold sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabstrata.operators import models as MD
from tabstrata.operators import tuning as TU


def _coordinate_descent(X, y, alpha, l1_ratio, iters=5000):
    """min 1/(2n)||y - Xw - b||^2 + alpha*r*||w||_1 + alpha*(1-r)/2*||w||^2 (intercept unpenalized)."""
    n, p = X.shape
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = Xc[:, j] @ Xc[:, j] / n + alpha * (1 - l1_ratio)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0.0) / z
    return w


@pytest.fixture(scope="module")
def regression_frame(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(400, 3)) * np.array([1.0, 2.0, 0.5])
    y = X @ np.array([2.0, -1.0, 0.3]) + 1.0 + rng.normal(scale=0.5, size=400)
    df = spark.createDataFrame([(i, *map(float, X[i]), float(y[i])) for i in range(400)],
                               "id long, a double, b double, c double, y double")
    return X, y, df


def test_boosting_on_grouped_rows_equals_all_rows(spark, monkeypatch):
    """Rows of equal features are fitted as one weighted row; features of many values or sampled stages are fitted row by row."""
    rng = np.random.default_rng(9)
    X = np.c_[rng.integers(0, 9, 4000), rng.integers(0, 4, 4000)].astype(float)
    y = 3 * X[:, 0] - X[:, 1] ** 2 + rng.normal(size=4000)
    df = spark.createDataFrame([(i, *map(float, x), float(v)) for i, (x, v) in enumerate(zip(X, y))], "id long, a double, b double, y double").persist()
    sizes, fit = [], MD.Pipeline.fit
    monkeypatch.setattr(MD.Pipeline, "fit", lambda self, d: (sizes.append(d.count()), fit(self, d))[1])
    score = lambda m: [r["prediction"] for r in MD.predict(m, df).orderBy("id").collect()]
    kw = {"n_estimators": 8, "max_depth": 2}
    grouped = score(MD.train(df, ["a", "b"], "y", "gradient_boosting", **kw))
    MD.train(df.withColumn("a", F.col("id") * 1.0), ["a"], "y", "gradient_boosting", n_estimators=1)
    MD.train(df, ["a", "b"], "y", "gradient_boosting", n_estimators=1, subsample=0.8)
    monkeypatch.setattr(MD, "_grouped", lambda *a: None)
    assert grouped == pytest.approx(score(MD.train(df, ["a", "b"], "y", "gradient_boosting", **kw)), rel=1e-9)
    assert sizes == [36, 4000, 4000, 4000]


@pytest.mark.parametrize("kind,params", [("lasso", {}), ("elasticnet", {"l1_ratio": 0.3})])
@pytest.mark.parametrize("fit_intercept", [True, False])
def test_penalized_folds_come_from_one_aggregate(spark, monkeypatch, kind, params, fit_intercept):
    """No fit a fold and point: only the best point is fitted; scores are those of Spark's fits."""
    from tabstrata.operators import tuning as TU

    rng = np.random.default_rng(4)
    X = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.2] + [3.0, 0.0, 1.0]
    y = X @ [2.0, -0.5, 0.0] + rng.normal(size=300) + 40
    df = spark.createDataFrame([(i, *map(float, x), float(v)) for i, (x, v) in enumerate(zip(X, y))], "id long, a double, b double, c double, y double")
    fits, train = [], MD.train
    monkeypatch.setattr(MD, "train", lambda *a, **kw: (fits.append(1), train(*a, **kw))[1])
    grid = {"alpha": [0.05, 2.0], "fit_intercept": [fit_intercept], **{k: [v] for k, v in params.items()}}
    _, best, score, res = TU.search(df, ["a", "b", "c"], "y", "id", kind, cv=3, grid=grid)
    assert len(fits) == 1
    got = [r["mean_score"] for r in res.orderBy("point").collect()]
    folded = TU.assign_folds(df, "id", 3).persist()
    for point, mean in zip(TU.param_points(kind, grid), got, strict=True):
        each = []
        for i in range(3):
            m = train(folded.where(f"fold <> {i}"), ["a", "b", "c"], "y", kind, **point)
            each.append(MD.predict(m, folded.where(f"fold = {i}")).selectExpr("avg(pow(y - prediction, 2))").first()[0])
        assert mean == pytest.approx(np.mean(each), rel=1e-6)
    assert score == min(got)


@pytest.mark.parametrize("kind,alpha,ratio", [("lasso", 0.1, 1.0), ("elasticnet", 0.2, 0.5)])
def test_penalized_match_coordinate_descent(regression_frame, kind, alpha, ratio):
    X, y, df = regression_frame
    m = MD.train(df, ["a", "b", "c"], "y", kind, alpha=alpha, l1_ratio=ratio).stages[-1]
    want = _coordinate_descent(X, y, alpha, ratio)
    assert m.coefficients.toArray() == pytest.approx(want, abs=2e-3)


def test_isolation_forest_finds_planted_outliers(spark):
    from tabstrata.operators.outliers import isolation_forest_outliers
    rng = np.random.default_rng(2)
    X = rng.normal(size=(2000, 2))
    X[:20] += 12.0  # planted far-away points
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)], "id long, a double, b double")
    out, summary = isolation_forest_outliers(df, ["a", "b"], "id", contamination=0.02, treatment="flag", n_trees=50)
    flagged = {r["id"] for r in out.where("is_outlier = 1").select("id").collect()}
    assert set(range(20)) <= flagged
    assert abs(len(flagged) - 40) <= 10
    assert summary.count() == 2


def test_diagnosis_rules(spark):
    def dx(tr, te):
        c = spark.createDataFrame([(10, 9.0, 9.5), (20, tr, te)],
                                  "train_size int, train_rmse_mean double, test_rmse_mean double")
        return TU.diagnose(c).first()["diagnosis"]
    assert dx(1.0, 3.0) == "overfitting"
    assert dx(9.2, 9.4) == "underfitting"
    assert dx(5.0, 5.5) == "good fit"
    assert dx(4.0, 7.0) == "more data may help"


def test_folds_contiguous_first_folds_larger(spark):
    df = spark.range(23).withColumnRenamed("id", "rid")
    f = TU.assign_folds(df, "rid", 5).orderBy("rid").collect()
    sizes = [sum(1 for r in f if r["fold"] == k) for k in range(5)]
    assert sizes == [5, 5, 5, 4, 4]
    assert [r["fold"] for r in f] == sorted(r["fold"] for r in f)


def test_cross_validation_summary(regression_frame):
    _, _, df = regression_frame
    per_fold, summary = TU.cross_validate(df, ["a", "b", "c"], "y", "id", "linear", 4)
    assert per_fold.count() == 4
    s = {r["metric"]: r for r in summary.collect()}
    assert s["rmse"]["folds"] == 4 and 0.3 < s["rmse"]["mean"] < 0.8
    assert s["r2"]["mean"] > 0.9


def test_svr_fits_rbf_signal_better_than_linear(spark):
    rng = np.random.default_rng(4)
    X = rng.uniform(-3, 3, size=(800, 1))
    y = np.exp(-X[:, 0] ** 2) * 3 + rng.normal(scale=0.05, size=800)
    df = spark.createDataFrame([(i, float(X[i, 0]), float(y[i])) for i in range(800)], "id long, x double, y double")
    svr = MD.train(df, ["x"], "y", "svr", n_components=100, iterations=40, C=10.0)
    lin = MD.train(df, ["x"], "y", "linear")
    from tabstrata.operators.metrics import regression_metrics
    e_svr = regression_metrics(svr.transform(df), "y", "prediction").first()["rmse"]
    e_lin = regression_metrics(MD.predict(lin, df), "y", "prediction").first()["rmse"]
    assert e_svr < e_lin


def test_save_and_load_every_model_in_a_folder(spark, regression_frame):
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import load_model, load_models, save_model
    _, _, df = regression_frame
    folder = scratch_path(spark, "models")
    lin = MD.train(df, ["a", "b", "c"], "y", "linear")
    rf = MD.train(df, ["a", "b", "c"], "y", "random_forest", n_estimators=5, max_depth=3)
    save_model(lin, folder, "linear")
    save_model(rf, folder, "forest")
    models = load_models(spark, folder)
    assert list(models) == ["forest", "linear"]
    a = MD.predict(lin, df).select("id", "prediction").collect()
    b = MD.predict(models["linear"], df).select("id", "prediction").collect()
    assert sorted(a) == sorted(b)
    top = MD.feature_importances(models["forest"], ["a", "b", "c"], top_n=2).collect()
    assert len(top) == 2 and top[0]["importance"] >= top[1]["importance"]
    with pytest.raises(Exception):
        load_model(folder + "/missing")


def test_bootstrap_band_and_ci_are_repeatable(spark, regression_frame):
    from tabstrata.operators.density import bootstrap_mean_ci, regression_band
    _, _, df = regression_frame
    a = {r["grid"]: r for r in regression_band(df, "a", "y", "id", replicates=60).collect()}
    b = {r["grid"]: r for r in regression_band(df.repartition(5), "a", "y", "id", replicates=60).collect()}
    for g, r in a.items():
        assert r["ci_low"] <= r["fit"] <= r["ci_high"]
        assert b[g]["ci_low"] == pytest.approx(r["ci_low"]) and b[g]["ci_high"] == pytest.approx(r["ci_high"])
    ci = bootstrap_mean_ci(df, "y", "id", replicates=80).first()
    assert ci["ci_low"] < ci["mean"] < ci["ci_high"] and ci["replicates"] == 80


def test_forest_depth_default_and_unlimited(spark):
    from tabstrata.operators import models as MD
    assert MD.estimator("random_forest").getMaxDepth() == 30  # unlimited by default
    assert MD.estimator("random_forest", max_depth=None).getMaxDepth() == 30
    assert MD.estimator("random_forest", max_depth=20).getMaxDepth() == 20


def test_unknown_parameters_raise(spark):
    from tabstrata.operators import models as MD
    with pytest.raises(ValueError):
        MD.estimator("random_forest", min_samples_split=3)


def test_svr_nulls_kernel_and_save(spark, regression_frame):
    from tabstrata.operators import models as MD
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import load_model, save_model
    _, _, df = regression_frame
    holes = df.withColumn("a", F.when(F.col("id") % 9 != 0, F.col("a")))
    for kernel in ("rbf", "linear"):
        m = MD.train(holes, ["a", "b"], "y", "svr", n_components=40, iterations=6, kernel=kernel)
        assert np.isfinite(m.coef).all()
        back = load_model(save_model(m, scratch_path(spark, "models"), f"svr_{kernel}"))
        a, b = (x.transform(df.select("id", "a", "b")).orderBy("id").limit(20).toPandas().prediction for x in (m, back))
        assert np.allclose(a, b)
    with pytest.raises(ValueError):
        MD.train(df, ["a", "b"], "y", "svr", kernel="cubic")


def test_fold_sums_equal_fits_with_nulls_collinear_columns_and_offsets(spark, regression_frame):
    from tabstrata.operators import tuning as TU
    _, _, df = regression_frame
    odd = df.select("id", F.when(F.col("id") % 9 != 0, F.col("a")).alias("a"), "b", (F.col("a") + F.col("b")).alias("c"), (F.col("y") + 1e9).alias("y"))
    for feats in (["a", "b"], ["a", "b", "c"]):
        fast = {r["fold"]: r["mse"] for r in TU.cross_validate(odd, feats, "y", "id", "linear", 4)[0].collect()}
        base = odd.dropna(subset=[*feats, "y"]).toPandas().sort_values("id").reset_index(drop=True)
        cuts = np.array_split(np.arange(len(base)), 4)
        for i, hold in enumerate(cuts):
            tr = base.drop(index=hold)
            y0 = tr["y"].mean()
            X = np.c_[np.ones(len(tr)), tr[feats]]
            w = np.linalg.lstsq(X, tr["y"] - y0, rcond=None)[0]
            te = base.loc[hold]
            mse = np.mean((te["y"] - y0 - np.c_[np.ones(len(te)), te[feats]] @ w) ** 2)
            assert fast[i] == pytest.approx(mse, rel=1e-4)
    curve = TU.learning_curve(odd, ["a", "b"], "y", "id", "linear", cv=4, train_sizes=[0.3, 1.0]).collect()
    assert len(curve) == 2 and all(r["train_rmse_mean"] > 0 for r in curve)


def _cart(X, y, w, depth, split, leaf):
    """A plain recursive regression tree: nested (feature, cut, left, right), leaf values."""
    if len(y) < max(split, 2 * leaf, 2) or y.min() == y.max() or depth == 0:
        return np.average(y, weights=w)
    best = None
    for j in range(X.shape[1]):
        values = np.unique(X[:, j])
        for a, b in zip(values, values[1:]):
            low = X[:, j] <= a + (b - a) / 2
            if min(low.sum(), (~low).sum()) >= leaf:
                score = sum((w * y)[s].sum() ** 2 / w[s].sum() for s in (low, ~low))
                if best is None or score > best[0] + 1e-9 * abs(best[0]):
                    best = (score, j, a + (b - a) / 2, low)
    if best is None:
        return np.average(y, weights=w)
    _, j, cut, low = best
    return j, cut, *(_cart(X[s], y[s], w[s], None if depth is None else depth - 1, split, leaf) for s in (low, ~low))


def _nested(tree, i=0):
    if tree["feature"][i] < 0:
        return float(tree["value"][i])
    return int(tree["feature"][i]), float(tree["threshold"][i]), _nested(tree, tree["left"][i]), _nested(tree, tree["right"][i])


def _flat(t):
    return [t] if not isinstance(t, tuple) else [t[0], t[1], *_flat(t[2]), *_flat(t[3])]


def test_grow_equals_plain_cart():
    from tabstrata.operators.forest import grow

    rng = np.random.default_rng(0)
    for k in range(60):
        n = int(rng.integers(1, 50))
        X, y, w = rng.integers(0, rng.choice([3, 10, 1000]), (n, 3)).astype(float), rng.normal(size=n), rng.integers(1, 4, n).astype(float)
        y -= np.average(y, weights=w)  # so that both add up around the mean
        for depth, split, leaf in ((None, 2, 1), (3, 2, 1), (None, 5, 2), (None, 10, 4)):
            assert _flat(_nested(grow(X, y, w, depth, split, leaf))) == pytest.approx(_flat(_cart(X, y, w, depth, split, leaf)))


@pytest.fixture(scope="module")
def forest_frame(spark):
    rng = np.random.default_rng(4)
    X = np.round(rng.normal(size=(600, 3)), 2)
    y = np.round(5 * (X[:, 0] > 0) + X[:, 1] + rng.normal(size=600) / 5, 3)
    df = spark.createDataFrame([(i, *map(float, x), float(v)) for i, (x, v) in enumerate(zip(X, y))] + [(9999, None, 1.0, 1.0, 1.0)], "id long, a double, b double, c double, y double")
    return X, y, df


def test_forest_to_purity_and_each_tree_by_itself(spark, forest_frame):
    from tabstrata.operators import forest as FO

    X, y, df = forest_frame
    whole = FO.train_forest(df, ["a", "b", "c"], "y", n_estimators=3, bootstrap=False)
    got = {r.id: r.prediction for r in whole.transform(df).collect()}
    assert got[9999] is None and np.allclose([got[i] for i in range(600)], y)  # unique rows are fitted exactly
    model = FO.train_forest(df.repartition(5), ["a", "b", "c"], "y", n_estimators=100, min_samples_split=5)
    again = FO.train_forest(df, ["a", "b", "c"], "y", n_estimators=100, min_samples_split=5)
    trees, other = model.trees(spark), again.trees(spark)
    assert len(trees) == 100 and all(np.array_equal(a[0]["threshold"], b[0]["threshold"]) for a, b in zip(trees, other))
    keys = np.array([r.k for r in df.where("id < 600").groupBy("a", "b", "c", "y").count().join(df, ["a", "b", "c", "y"]).orderBy("id").select(F.xxhash64("a", "b", "c", "y", F.lit(0).cast("long")).alias("k")).collect()])
    w = FO.poisson_weights(keys, np.arange(100), 42)
    for t in range(0, 100, 25):
        own = w[:, t] > 0
        assert _flat(_nested(trees[t][0])) == pytest.approx(_flat(_cart(X[own], y[own], w[own, t], None, 5, 1)), rel=1e-6)
    assert 0.55 < own.mean() < 0.7 and sum(model.importances) == pytest.approx(1) and int(np.argmax(model.importances)) == 0


def test_forest_split_over_the_table_equals_in_one_task(spark, forest_frame, monkeypatch):
    from tabstrata.operators import forest as FO
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import load_model, save_model

    X, y, df = forest_frame
    coarse = df.withColumns({c: F.round(F.col(c) * 5) for c in "abc"})
    kw = {"n_estimators": 2, "min_samples_leaf": 2, "max_depth": 9, "bootstrap": False}  # cuts lie between the values of all rows, so with all rows they are the same
    one = FO.train_forest(coarse, ["a", "b", "c"], "y", **kw)
    many = FO.train_forest(coarse, ["a", "b", "c"], "y", node_rows=60, **kw)
    assert max(len(t["feature"]) for t in many.tops) > 5
    told = lambda m: np.array([r.prediction for r in m.transform(coarse.where("id < 600")).orderBy("id").collect()])
    assert np.allclose(told(one), told(many)) and np.allclose(one.importances, many.importances)
    path = save_model(many, scratch_path(spark, "models"), "forest")
    monkeypatch.setattr(FO, "MAX_BROADCAST_NODES", 10)  # met subtree by subtree
    assert np.allclose(told(load_model(path)), told(one))
    same = spark.range(500).select(F.lit(1.0).alias("a"), F.lit(2.0).alias("y"))  # a node that can't be split
    assert {r.prediction for r in FO.train_forest(same, ["a"], "y", n_estimators=2, node_rows=50).transform(same).collect()} == {2.0}
    with pytest.raises(ValueError):
        FO.train_forest(df.limit(0), ["a"], "y")


def test_forest_does_not_depend_on_where_nodes_are_split(spark, monkeypatch):
    from tabstrata.operators import forest as FO

    rng = np.random.default_rng(8)
    X = np.c_[np.round(rng.normal(size=3000), 3), rng.integers(0, 4, 3000), np.where(rng.random(3000) < 0.6, 0.5, rng.random(3000))]
    y = np.round(X[:, 0] * X[:, 2] + (X[:, 1] == 2) + rng.normal(size=3000), 2)
    df = spark.createDataFrame([(*map(float, x), float(v)) for x, v in zip(X, y)], "a double, b double, c double, y double")
    monkeypatch.setattr(FO, "RANGE_ROWS", 400)  # ranges, some of them of one value
    monkeypatch.setattr(FO, "RANGE_CUTS", 80)  # few nodes at once
    for kw in ({"min_samples_leaf": 3, "max_depth": 11}, {}):
        one, many = (FO.train_forest(df, ["a", "b", "c"], "y", n_estimators=3, node_rows=k, **kw) for k in (250_000, 300))
        monkeypatch.setattr(FO, "MAX_VALUES", 100)
        wide = FO.train_forest(df.repartition(7), ["a", "b", "c"], "y", n_estimators=3, node_rows=300, **kw)
        told = lambda m: np.array([r.prediction for r in m.transform(df).orderBy("a", "b", "c", "y").collect()])
        assert min(len(t["feature"]) for t in many.tops) > 9
        assert np.allclose(told(one), told(many), atol=1e-9) and np.allclose(told(one), told(wide), atol=1e-9)
        assert np.allclose(one.importances, many.importances) and np.allclose(one.importances, wide.importances)
        monkeypatch.setattr(FO, "MAX_VALUES", 2048)


def test_forest_moves_blocks_and_subtrees_and_copies_only_what_many_rows_reach(spark, forest_frame, monkeypatch):
    from tabstrata.operators import forest as FO

    X, y, df = forest_frame
    kw = {"n_estimators": 6, "node_rows": 60}
    model = FO.train_forest(df, ["a", "b", "c"], "y", **kw)
    told = lambda: {r.id: r.prediction for r in model.transform(df).collect()}
    whole = told()
    assert model.n_nodes > 1000 and spark.read.parquet(model.path).count() < 300  # a row a subtree
    monkeypatch.setattr(FO, "NODE_SLICE", 16)  # subtrees in several rows
    sliced = FO.train_forest(df, ["a", "b", "c"], "y", **kw)
    assert spark.read.parquet(sliced.path).count() > 300 and sliced.importances == pytest.approx(model.importances)
    model = sliced
    assert told() == whole
    monkeypatch.setattr(FO, "MAX_BROADCAST_NODES", 10)
    monkeypatch.setattr(FO, "BLOCK_ROWS", 50)
    monkeypatch.setattr(FO, "PART_ROWS", 40)  # some subtrees are reached by more rows
    parts = model._parts(df.select("a", "b", "c").dropna())
    assert parts and len(parts) < sum(len(t) for t in model.trees(spark))
    assert told() == pytest.approx(whole, nan_ok=True) and whole[9999] is None


def test_forest_grid_has_every_point():
    from tabstrata.operators import tuning as TU
    assert np.prod([len(v) for v in TU.GRIDS["random_forest"].values()]) == 108


def test_bootstrap_of_many_groups_equals_in_place(spark, monkeypatch):
    from tabstrata.operators import density as DEN

    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 701).cast("string"))).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("x"))
    told = lambda: {r.g: (r.n, round(r.mean, 9), round(r.ci_low, 9), round(r.ci_high, 9), r.replicates) for r in DEN.bootstrap_mean_ci(df, "x", "id", "g", 50).collect()}
    whole = told()
    monkeypatch.setattr(DEN, "SUM_BYTES", 16 * 50 * 10)  # ten groups' sums at once
    assert told() == whole and len(whole) > 400
    w = DEN._poisson_weights(np.arange(0, 6000, 3), 50, 42)
    x = np.arange(0, 6000, 3) * 7 % 101
    assert whole["hot"][2:4] == pytest.approx(tuple(np.quantile((w * x[:, None]).sum(0) / w.sum(0), [0.025, 0.975])))
    one = spark.createDataFrame([(1, "a", 2.0)], "id long, g string, x double")
    r = DEN.bootstrap_mean_ci(one, "x", "id", "g", 50).first()
    assert r.ci_low == r.ci_high == 2.0 and 0 < r.replicates < 50  # replicates without the row don't count


def test_exact_kernel_svr_equals_a_full_solve(spark, monkeypatch):
    from tabstrata.operators import kernel_svr as KS
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import load_model, save_model

    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 2))
    y = np.sin(2 * X[:, 0]) * 3 + X[:, 1] + rng.normal(size=400) / 3
    df = spark.createDataFrame([(*map(float, x), float(v)) for x, v in zip(X, y)] + [(None, 1.0, 1.0)], "a double, b double, y double")
    model = KS.train_kernel_svr(df, ["a", "b"], "y", working=100, tol=1e-4)
    assert model.violators == 0 and 1 < model.passes < 200
    S = (X - X.mean(0)) / X.std(0)
    K = KS.kernel(S, S, 0.5)
    assert model.gamma == pytest.approx(0.5)
    b = KS.solve(K, y, np.zeros(400), np.zeros(400), 1.0, 0.1, 1e-6)
    full = b @ K @ b / 2 - y @ b + 0.1 * np.abs(b).sum()
    assert abs(b.sum()) < 1e-9 and np.abs(b).max() <= 1
    assert model.objective == pytest.approx(full, abs=1e-4 * abs(full))
    got = [r.prediction for r in model.transform(df).collect()]
    assert got[-1] is None
    free = (np.abs(b) > 1e-6) & (np.abs(b) < 1 - 1e-6)
    want = K @ b + np.mean((y - K @ b - 0.1 * np.sign(b))[free])
    assert np.allclose(sorted(got[:-1]), sorted(want), atol=0.01)
    path = save_model(model, scratch_path(spark, "models"), "svr")
    monkeypatch.setattr(KS, "MAX_VECTORS", 50)  # several scans
    again = [r.prediction for r in load_model(path).transform(df).collect()]
    assert np.allclose(sorted(p for p in again if p is not None), sorted(got[:-1]))
    one = KS.train_kernel_svr(df.limit(1), ["a", "b"], "y")
    assert one.n_vectors == 0 and one.transform(df.limit(1)).first().prediction == pytest.approx(float(y[0]), abs=0.2)
    with pytest.raises(ValueError):
        KS.train_kernel_svr(df.limit(0), ["a", "b"], "y")


def test_exact_kernel_svr_of_many_rows_takes_few_passes(spark, monkeypatch):
    from tabstrata.operators import kernel_svr as KS

    rng = np.random.default_rng(5)
    X = np.c_[rng.integers(0, 9, 800), rng.integers(0, 11, 800)].astype(float)  # rows of equal features
    y = np.sin(X[:, 0]) + X[:, 1] / 3 + rng.normal(size=800) * 2
    df = spark.createDataFrame([(*map(float, x), float(v)) for x, v in zip(X, y)], "a double, b double, y double")
    S = (X - X.mean(0)) / X.std(0)
    K = KS.kernel(S, S, 0.5)
    for epsilon in (0.1, 0.0):
        model = KS.train_kernel_svr(df, ["a", "b"], "y", working=8, epsilon=epsilon, max_passes=95)  # 100 passes only to visit every row
        b = KS.solve(K, y, np.zeros(800), np.zeros(800), 1.0, epsilon, 1e-5)
        full = b @ K @ b / 2 - y @ b + epsilon * np.abs(b).sum()
        assert model.violators == 0 and model.n_vectors <= len(np.unique(X, axis=0))
        assert model.objective == pytest.approx(full, rel=1e-5)
    monkeypatch.setattr(KS, "MAX_RANK", 3)  # decomposition from zero
    slow = KS.train_kernel_svr(df, ["a", "b"], "y", working=300, epsilon=0.0)
    assert slow.violators == 0 and slow.objective == pytest.approx(model.objective, rel=1e-5)
    a, c = ([r.prediction for r in m.transform(df.limit(50)).collect()] for m in (model, slow))
    assert np.allclose(a, c, atol=0.01)
