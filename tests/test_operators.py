"""Operators against brute force / closed form on small fixtures, and invariants."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabstrata.operators import metrics as M
from tabstrata.operators import prepare as P
from tabstrata.operators import profile as PR
from tabstrata.operators import relations as REL
from tabstrata.session import scratch_path, table


def test_impute_median_even_count_and_mode_ties(spark):
    df = spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 2, "a"), (4, 2, "b"), (5, None, None)],
                               "id int, x int, c string")
    med = P.impute(df, "median", ["x"]).where("id = 5").first()["x"]
    assert med == 1.5  # linear median of {1,1,2,2}; an approximate imputer would give 1
    mf = P.impute(df, "most_frequent", ["x", "c"]).where("id = 5").first()
    assert mf["x"] == 1 and mf["c"] == "a"  # ties -> smallest


def test_scalers_constant_column_and_inverse(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0), (3, 5.0, 8.0)], "id int, c double, x double")
    for method in ("standard", "minmax", "robust"):
        out, m = P.scale(df, method, ["c", "x"])
        assert {r["c"] for r in out.collect()} == {0.0}
        back = m.inverse(out).orderBy("id").collect()
        assert [r["x"] for r in back] == pytest.approx([1.0, 3.0, 8.0])
    std = P.fit_scaler(df, "standard", ["x"]).params["x"]
    assert std[1] == pytest.approx(np.std([1.0, 3.0, 8.0]))  # ddof 0


def test_onehot_drops_first_sorted_level_and_null_is_zero(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, cat string")
    out = P.encode(df, "one_hot", ["cat"]).orderBy("id")
    assert out.columns == ["id", "cat_b", "cat_c"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    lab = [r["cat"] for r in P.encode(df, "label", ["cat"]).orderBy("id").collect()]
    assert lab == [1, 0, -1, 2]


def test_split_exact_sizes_disjoint_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "pid")
    lab = P.split_labels(df, "pid", 0.2, 0.1, 7)
    counts = {r["split"]: r["count"] for r in lab.groupBy("split").count().collect()}
    assert counts == {"train": 700, "val": 100, "test": 200}
    again = P.split_labels(df.repartition(5), "pid", 0.2, 0.1, 7)
    assert sorted(lab.collect()) == sorted(again.collect())
    assert P.split_sizes(1000, 0.2, 0.1) == (700, 100, 200)


def test_stratified_split_proportions(spark):
    rows = [(i, "a" if i < 600 else "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "pid long, s string")
    lab = P.split_labels_stratified(df, "pid", "s", 0.2)
    got = {(r["s"], r["split"]): r["count"] for r in lab.groupBy("s", "split").count().collect()}
    assert got == {("a", "train"): 480, ("a", "test"): 120, ("b", "train"): 320, ("b", "test"): 80}


def test_kendall_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 200).astype(float)
    y = (x + rng.integers(0, 3, 200)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = REL.kendall_pair(df, "x", "y").first()["corr"]
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in itertools.combinations(range(200), 2))
    n0 = 200 * 199 / 2
    n1 = sum(c * (c - 1) / 2 for c in np.unique(x, return_counts=True)[1])
    n2 = sum(c * (c - 1) / 2 for c in np.unique(y, return_counts=True)[1])
    assert got == pytest.approx(s / math.sqrt((n0 - n1) * (n0 - n2)))


def test_metrics_r2_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 1.0), (3.0, 2.0)], "label double, prediction double")
    r2 = M.regression_metrics(df).first()["r2"]
    assert r2 == pytest.approx(1 - 6 / 2)  # SSres = 4 + 1 + 1, SStot = 2
    const = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    assert M.regression_metrics(const).first()["r2"] == 1.0


def test_segments_counts_sum_to_n(spark):
    df = spark.createDataFrame([(i, float(i % 4), float(i)) for i in range(11)], "id long, label double, prediction double")
    seg = M.segments(df, "label", "prediction", "id", 3).orderBy("segment").collect()
    assert [r["count"] for r in seg] == [4, 3, 4]
    one = M.segments(df.limit(1), "label", "prediction", "id", 3).collect()
    assert len(one) == 1 and one[0]["r2"] is None


def test_iqr_outliers_flag_remove_clip(spark):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 100, None])],
                               "id int, x double")
    out, summary = PR.detect_and_handle_outliers(df, ["x"], treatment="flag", id_col="id")
    assert out.where("is_outlier = 1").count() == 1
    assert summary.first()["outlier_count"] == 1
    removed, _ = PR.detect_and_handle_outliers(df, ["x"], treatment="remove", id_col="id")
    assert removed.count() == 9  # the null row is not an outlier
    clipped, _ = PR.detect_and_handle_outliers(df, ["x"], treatment="clip", id_col="id")
    assert clipped.where("id = 9").first()["x"] is None


@pytest.mark.parametrize("block_rows,fanout", [(37, 64), (10, 2)])
def test_knn_impute_matches_brute_force(spark, block_rows, fanout):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 3))
    X[rng.random((120, 3)) < 0.15] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    from tabstrata.operators.knn import knn_impute
    got = {r["id"]: (r["a"], r["b"], r["c"]) for r in knn_impute(df, ["a", "b", "c"], "id", k=3, block_rows=block_rows,
                                                                   fanout=fanout).collect()}
    means = np.nanmean(X, axis=0)
    for i in range(120):
        for j in range(3):
            if not np.isnan(X[i, j]):
                assert got[i][j] == pytest.approx(X[i, j])
                continue
            cands = []
            for d in range(120):
                if np.isnan(X[d, j]):
                    continue
                sh = ~np.isnan(X[i]) & ~np.isnan(X[d])
                if not sh.any():
                    continue
                dist = math.sqrt(np.sum((X[i, sh] - X[d, sh]) ** 2) * 3 / sh.sum())
                cands.append((dist, d))
            want = np.mean([X[d, j] for _, d in sorted(cands)[:3]]) if cands else means[j]
            assert got[i][j] == pytest.approx(want)


def test_ols_and_ridge_closed_form(spark):
    from tabstrata.operators import models as MD
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y double")
    lin = MD.train(df, ["a", "b", "c"], "y", "linear").stages[-1]
    A = np.c_[X, np.ones(300)]
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    assert lin.coefficients.toArray() == pytest.approx(beta[:3], abs=1e-6)
    alpha = 10.0
    rid = MD.train(df, ["a", "b", "c"], "y", "ridge", alpha=alpha).stages[-1]
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert rid.coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_describe_invariant_under_repartition(spark):
    ev = table(spark, "/root/testdata/sf0.001", "events")
    a = PR.describe(ev, ["value"]).first().asDict()
    b = PR.describe(ev.repartition(7), ["value"]).first().asDict()
    assert a.keys() == b.keys()
    for k in a:  # equal up to the order of floating-point sums
        assert a[k] == (b[k] if isinstance(b[k], str) else pytest.approx(b[k], rel=1e-12))


def test_pearson_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.2, 2.0), (4.0, None, 3.5)],
                               "a double, b double, c double")
    m = {(r["x"], r["y"]): r["corr"] for r in REL.pearson_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 6.2])[0, 1])
    assert m[("b", "a")] == m[("a", "b")]
    assert len(REL.lower_triangle(REL.pearson_matrix(df, ["a", "b", "c"]), ["a", "b", "c"]).collect()) == 3


def test_select_quantiles_equal_exact_with_heavy_value(spark):
    from tabstrata.operators.quantiles import quantiles
    rng = np.random.default_rng(5)
    vals = rng.normal(size=3000)
    vals[::3] = 0.25  # a third of the rows hold one value
    rows = [(i, float(v) if i % 17 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    exact = quantiles(df, ["x"], probs, "exact")["x"]
    sel = quantiles(df, ["x"], probs, "select", n_buckets=16)["x"]
    assert sel == pytest.approx(exact, abs=1e-12)
    want = np.quantile([v for _, v in rows if v is not None], probs)
    assert sel == pytest.approx(list(want), abs=1e-12)


def test_exact_kendall_recursion_matches_brute_force(spark):
    from tabstrata.operators.kendall import inversions, kendall_s, numpy_s
    rng = np.random.default_rng(8)
    n = 1500
    x = np.round(rng.normal(size=n), 2)
    x[: n // 3] = 0.5  # a third of the rows share one x value
    y = np.round(x * 0.7 + rng.normal(size=n), 1)
    brute = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in itertools.combinations(range(n), 2))
    assert numpy_s(x, y) == pytest.approx(brute)
    r = rng.integers(0, 50, 300)
    assert inversions(r) == sum(1 for i, j in itertools.combinations(range(300), 2) if r[i] > r[j])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(3)
    s, cnt, n1, n2 = kendall_s(df, "x", "y", blocks=4, leaf=60)
    assert cnt == n
    assert s == pytest.approx(brute)
    assert n1 == pytest.approx(sum(c * (c - 1) / 2 for c in np.unique(x, return_counts=True)[1]))


def test_exact_kendall_recursion_at_the_default_number_of_blocks(spark):
    """32 counts a value: the sum over the blocks stays a small plan (the driver ran out of memory on its code)."""
    from tabstrata.operators.kendall import kendall_s, numpy_s
    rng = np.random.default_rng(18)
    x = np.round(rng.normal(size=2000), 2)
    y = np.round(x * 0.3 + rng.normal(size=2000), 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(3)
    s, n, _, _ = kendall_s(df, "x", "y", leaf=500)
    assert n == 2000 and s == numpy_s(x, y)


def test_grouped_quantiles_rank_equals_exact(spark):
    from tabstrata.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(9)
    g = rng.integers(0, 3, 2500)
    g[:900] = 7  # a hot group
    v = np.round(rng.normal(size=2500), 3)
    v[::4] = 0.0
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    ex = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "v", probs, "exact").collect()}
    rk = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "v", probs, "rank").collect()}
    assert ex.keys() == rk.keys()
    for k in ex:
        assert rk[k] == pytest.approx(ex[k], abs=1e-12)
        assert rk[k] == pytest.approx(list(np.quantile(v[g == k], probs)), abs=1e-12)


def test_kendall_matrix_with_different_null_patterns(spark):
    rng = np.random.default_rng(12)
    a = rng.integers(0, 6, 300).astype(float)
    b = (a + rng.integers(0, 3, 300)).astype(float)
    c = rng.integers(0, 4, 300).astype(float)
    rows = []
    for i in range(300):
        rows.append((None if i % 7 == 0 or a[i] == 5 else float(a[i]), None if i % 5 == 0 else float(b[i]),
                     None if i % 11 == 0 else float(c[i])))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["x"], r["y"]): r["corr"] for r in REL.kendall_matrix(df, ["a", "b", "c"]).collect()}
    for u, v in [("a", "b"), ("a", "c"), ("b", "c")]:
        pairs = [(r[["a", "b", "c"].index(u)], r[["a", "b", "c"].index(v)]) for r in rows]
        pairs = [(p, q) for p, q in pairs if p is not None and q is not None]
        x = np.array([p for p, _ in pairs]); y = np.array([q for _, q in pairs])
        n = len(x)
        s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in itertools.combinations(range(n), 2))
        n0 = n * (n - 1) / 2
        n1 = sum(k * (k - 1) / 2 for k in np.unique(x, return_counts=True)[1])
        n2 = sum(k * (k - 1) / 2 for k in np.unique(y, return_counts=True)[1])
        assert got[(u, v)] == pytest.approx(s / math.sqrt((n0 - n1) * (n0 - n2)))
        assert got[(v, u)] == got[(u, v)]


def test_preprocess_fits_on_train_only_by_default(spark):
    from tabstrata.plans.pipeline import preprocess
    rows = [(i, float(i), float(i % 7), "a" if i % 2 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "pid long, x double, target double, cat string")
    cfg = {"time_features": {"enabled": False}, "outliers": {"enabled": False}}
    tr, _, te, m = preprocess(df, "target", "pid", cfg, test_size=0.25, seed=3)
    assert tr.count() == 150 and te.count() == 50
    mean_x = tr.agg(F.avg("x")).first()[0]
    assert abs(mean_x) < 1e-9  # standardized with the training rows' own mean
    assert "target" not in m.scaler.params and "pid" not in m.scaler.params
    _, _, _, m_all = preprocess(df, "target", "pid", cfg, test_size=0.25, seed=3, fit_on="all", include_target=True)
    assert m_all.scaler.params["x"][0] == pytest.approx(99.5) and "target" in m_all.scaler.params


def test_one_hot_vector_matches_one_hot_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "b")], "id int, cat string")
    model, names = P.fit_one_hot_vector(df, "cat")
    assert names == ["b", "c"]
    vec = {r["id"]: list(r["cat_vec"].toArray()) for r in model.transform(df).collect()}
    cols = {r["id"]: [r["cat_b"], r["cat_c"]] for r in P.encode(df, "one_hot", ["cat"]).collect()}
    assert vec == {k: [float(x) for x in v] for k, v in cols.items()}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_spearman_pairwise_complete_matches_pandas(spark, limit):
    """Pairs ranked among their complete rows, heavy ties, both broadcast and shuffle joins."""
    import pandas as pd
    rng = np.random.default_rng(3)
    n = 400
    a = rng.integers(0, 5, n).astype(float)
    a[: n // 3] = 2.0                                  # one value holds a third of the rows
    b = rng.normal(size=n).round(1)
    c = rng.integers(0, 40, n).astype(float)
    for arr, frac in ((a, 0.1), (b, 0.2), (c, 0.05)):
        arr[rng.random(n) < frac] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    want = pdf.corr(method="spearman")
    for nulls in (True, False):
        src, ref = (df, want) if nulls else (df.na.drop(), pdf.dropna().corr(method="spearman"))
        got = {(r["x"], r["y"]): r["corr"] for r in REL.spearman_matrix(src, ["a", "b", "c"], broadcast_limit=limit).collect()}
        for x, y in itertools.product("abc", repeat=2):
            assert got[(x, y)] == pytest.approx(ref.loc[x, y], abs=1e-12)


def test_spearman_stacks_rows_once_a_column(spark, monkeypatch):
    """With nulls a row is one entry a column and an all-null column has no correlations; more null flags than one long holds."""
    import pandas as pd
    monkeypatch.setattr(REL, "MASK_BITS", 2)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({c: rng.integers(0, 9, 300).astype(float) for c in "abcde"})
    for c, frac in zip("abcd", (0.7, 0.2, 0.4, 0.1)):
        pdf.loc[rng.random(300) < frac, c] = np.nan
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) + (None,) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(3)
    out = REL.spearman_matrix(df, list("abcdef"))
    got = {(r["x"], r["y"]): r["corr"] for r in out.collect()}
    want = pdf.corr(method="spearman")
    assert len(got) == 36
    for x, y in itertools.product("abcdef", repeat=2):
        if "f" in (x, y):
            assert got[(x, y)] is None or math.isnan(got[(x, y)])
        else:
            assert got[(x, y)] == pytest.approx(want.loc[x, y], abs=1e-12)
    (table, _), *_ = REL._rank_tables(df, list("abcdef"), list("abcdf"), 1_000_000)
    assert table.count() == pdf["a"].nunique()


def test_stratified_cuts_equal_ranked_path(spark, monkeypatch):
    """Boundary cuts per stratum label rows exactly like numbering every row per stratum."""
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1, 2001)]
    df = spark.createDataFrame(rows, "id long, s string").repartition(5)
    for test_size, val_size in ((0.2, 0.0), (0.25, 0.15)):
        cut = {r["id"]: r["split"] for r in P.split_labels_stratified(df, "id", "s", test_size, val_size, 7).collect()}
        monkeypatch.setattr(P, "MAX_CUT_STRATA", 0)
        ranked = {r["id"]: r["split"] for r in P.split_labels_stratified(df, "id", "s", test_size, val_size, 7).collect()}
        monkeypatch.setattr(P, "MAX_CUT_STRATA", 10_000)
        assert cut == ranked
        assert len(cut) == 2000


def test_csv_mixed_round_trip(spark):
    from decimal import Decimal
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import read_csv
    path = scratch_path(spark, "mixed") + ".csv"
    lines = ["a,b,c,d", '120.0,1.5,"say ""hi"", ok",2024-01-02', "NA,NaN,,", '7,2,"two', 'lines",2024-02-03']
    spark.createDataFrame([("\n".join(lines),)], "t string").coalesce(1).write.text(path)
    rows = read_csv(spark, path, "a int, b double, c string, d date").orderBy("a").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [(None, None, None), (7, 2.0, "two\nlines"), (120, 1.5, 'say "hi", ok')]
    inferred = read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "date"}
    with pytest.raises(Exception, match="not a int"):
        read_csv(spark, path, "b int").collect()


def test_csv_is_split_unless_a_field_has_line_feeds(spark):
    """A file without quoted line feeds is read in ranges by several tasks, with equal rows."""
    from tabstrata.session import scratch_path
    from tabstrata.sources.io import read_csv, write_table
    src = spark.range(20000).select("id", F.concat(F.lit('a "b", '), F.col("id")).alias("s"), F.when(F.col("id") % 7 > 0, F.col("id") / 8).alias("x"))
    path = scratch_path(spark, "split")
    write_table(src.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        got = read_csv(spark, path, "id long, s string, x double")
        assert got.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, src.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_outliers_of_an_all_null_column(spark):
    from tabstrata.operators.profile import detect_and_handle_outliers
    df = spark.createDataFrame([(1, None), (2, None), (50, None)], "x int, y double")
    out, summary = detect_and_handle_outliers(df, ["x", "y"])
    assert out.count() == 3 and {r["column"]: r["outlier_count"] for r in summary.collect()}["y"] == 0


def test_most_frequent_keeps_64_bit_integers(spark):
    from tabstrata.operators.prepare import impute
    big = 9007199254740993
    df = spark.createDataFrame([(big,), (big,), (9,), (10,), (None,)], "x bigint")
    assert [r["x"] for r in impute(df, "most_frequent", ["x"]).collect()].count(big) == 3


def test_knn_prunes_clustered_data_and_stays_exact(spark):
    """Twelve far clusters with ties and repeated rows: equal to comparing all pairs, and most pairs are never compared."""
    from tabstrata.operators.knn import KnnIndex, distances, fit_knn

    rng = np.random.default_rng(5)
    X = np.round(rng.integers(0, 12, 1500)[:, None] * 100.0 + rng.normal(size=(1500, 3)), 1)
    X[:400] = X[0]  # a value that many rows share
    X[rng.random(X.shape) < 0.08] = np.nan
    X[7] = np.nan
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in x]) for i, x in enumerate(X)], "id long, a double, b double, c double")
    index = fit_knn(df, cols, "id", block_rows=100)
    want = X.copy()
    dist = distances(X, X)
    for i, j in zip(*np.nonzero(np.isnan(X))):
        has = np.flatnonzero(~np.isnan(X[:, j]) & np.isfinite(dist[i]))
        near = has[np.lexsort((has, dist[i, has]))][:5]
        want[i, j] = X[near, j].mean() if near.size else np.nanmean(X[:, j])
    got = np.array([list(r[1:]) for r in sorted(index.impute(df, 5, count=True).select("id", *cols).collect())])
    assert np.allclose(got, want, atol=1e-9)
    assert index.visited["visited"] < 0.35 * index.visited["all"]
    path = scratch_path(spark, "knn-test")
    index.save(spark, path)
    again = KnnIndex.load(spark, path).impute(df.where("id < 300"), 5).select("id", *cols)
    assert np.allclose(np.array([list(r[1:]) for r in sorted(again.collect())]), want[:300], atol=1e-9)


def test_knn_columns_of_few_values_are_answered_by_equality(spark, monkeypatch):
    """Ties at distance 0 go to the smallest ids and aren't searched for; a search of every query gives the same."""
    from tabstrata.operators import knn

    rng = np.random.default_rng(8)
    X = np.c_[rng.integers(0, 5, 1200), rng.integers(0, 3, 1200) - 1, rng.integers(0, 40, 1200)].astype(float)
    X[rng.random(X.shape) < 0.12] = np.nan
    X[5], X[6, 0], X[9] = np.nan, np.inf, [0.0, -0.0, np.nan]
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in x]) for i, x in enumerate(X)], "id long, a double, b double, c double")
    index = knn.fit_knn(df, cols, "id", block_rows=100)
    with np.errstate(invalid="ignore"):
        dist = knn.distances(X, X)
    want = X.copy()
    for i, j in zip(*np.nonzero(np.isnan(X))):
        has = np.flatnonzero(~np.isnan(X[:, j]) & np.isfinite(dist[i]))
        near = has[np.lexsort((has, dist[i, has]))][:5]
        want[i, j] = X[near, j].mean() if near.size else np.nanmean(X[:, j])
    got = np.array([list(r[1:]) for r in sorted(index.impute(df, 5, count=True).select("id", *cols).collect())])
    assert np.allclose(got, want, atol=1e-9)
    assert index.visited["visited"] < 0.02 * index.visited["all"]
    monkeypatch.setattr(knn, "MAX_COPIES", 0)
    again = np.array([list(r[1:]) for r in sorted(index.impute(df, 5).select("id", *cols).collect())])
    assert np.allclose(again, want, atol=1e-9)


def test_preprocess_searches_the_neighbours_of_training_rows_once(spark, monkeypatch):
    from tabstrata.operators.knn import KnnIndex
    from tabstrata.plans.pipeline import preprocess

    rows = [(i, None if i % 7 == 0 else float(i % 24), None if i % 11 == 0 else float(i % 7), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, post_hour double, post_day double, y double")
    searched, impute = [], KnnIndex.impute
    monkeypatch.setattr(KnnIndex, "impute", lambda self, d, *a, **kw: (searched.append(1), impute(self, d, *a, **kw))[1])
    train, _, test, model = preprocess(df, "y", "id", {"missing_values": {"strategy": "knn"}})
    assert len(searched) == 2  # the training and the test part
    raw = df.join(train.select("id"), "id")
    key = lambda r: r["id"]
    for a, b in zip(sorted(train.collect(), key=key), sorted(model.transform(raw).select(*train.columns).collect(), key=key), strict=True):
        assert list(a) == pytest.approx(list(b), abs=1e-9)


def test_knn_rare_patterns_share_a_cell(spark, monkeypatch):
    from tabstrata.operators import knn

    rng = np.random.default_rng(6)
    X = rng.normal(size=(200, 4))
    X[rng.random(X.shape) < 0.3] = np.nan
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in x]) for i, x in enumerate(X)], "id long, a double, b double, c double, d double")
    whole = sorted(knn.knn_impute(df, ["a", "b", "c", "d"], "id", 3).collect())
    monkeypatch.setattr(knn, "MAX_PATTERNS", 3)
    assert sorted(knn.knn_impute(df, ["a", "b", "c", "d"], "id", 3).collect()) == whole


def test_kde_equals_the_direct_sum_on_heavy_tails(spark):
    from tabstrata.operators.density import kde

    rng = np.random.default_rng(8)
    x = np.exp(rng.normal(8, 2, 50_000))
    rows = spark.createDataFrame(pd.DataFrame({"x": x, "g": np.where(np.arange(len(x)) % 3 > 0, "hot", "other")}))
    for group in (None, "g"):
        got = kde(rows, "x", group, grid_size=120).toPandas()
        for name, part in got.groupby(group) if group else [(None, got)]:
            own = x if name is None else rows.where(F.col("g") == name).toPandas()["x"].to_numpy()
            h = own.std(ddof=1) * len(own) ** -0.2
            want = np.array([np.exp(-0.5 * ((p - own) / h) ** 2).sum() / (len(own) * h * np.sqrt(2 * np.pi)) for p in part["x"]])
            assert len(part) == 120 and np.allclose(part["density"], want, rtol=1e-6, atol=want.max() * 1e-9)


def test_isolation_forest_with_repeated_ids_and_rows(spark):
    from tabstrata.operators.outliers import fit_isolation_forest

    ids = spark.range(20_000).select((F.col("id") % 10).alias("id"), (F.col("id") % 5000).cast("double").alias("x"))
    same = spark.range(9_000).select(F.lit(1).cast("long").alias("id"), F.lit(2.0).alias("x"))
    for df in (ids, ids.unionByName(same), same.unionByName(ids.limit(3))):
        model = fit_isolation_forest(df, ["x"], "id")
        assert len(model.trees) == 100 and {int(t[4][0]) for t in model.trees} == {256}
    again = fit_isolation_forest(df.repartition(7), ["x"], "id")
    assert [t[1].tolist() for t in again.trees] == [t[1].tolist() for t in model.trees]


def test_encode_many_levels(spark, monkeypatch):
    names = [f"n{i % 2500}" for i in range(4000)] + ["", "é", "Z", None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, c string")
    order = {v: i for i, v in enumerate(sorted({n for n in names if n is not None}))}
    other = spark.createDataFrame([(1, "n7"), (2, "unseen"), (3, None)], "id int, c string")
    for limit in (100_000, 10):
        monkeypatch.setattr(P, "MAX_BROADCAST_LEVELS", limit)
        label, ordinal = P.fit_encoder(df, "label", ["c"]), P.fit_encoder(df, "ordinal", ["c"])
        assert {r.id: r.c for r in label.transform(df).collect()} == {i: -1 if n is None else order[n] for i, n in enumerate(names)}
        assert {r.id: r.c for r in ordinal.transform(df).collect()} == {i: order.get(n) for i, n in enumerate(names)}
        assert [r.c for r in label.transform(other).orderBy("id").collect()] == [order["n7"], -1, -1]
        assert [r.c for r in ordinal.transform(other).orderBy("id").collect()] == [order["n7"], None, None]
    with pytest.raises(ValueError):
        P.fit_encoder(df, "one_hot", ["c"])


def test_preparation_with_knn_and_forest_saves_and_loads(spark):
    from tabstrata.operators.knn import distances
    from tabstrata.plans.pipeline import Preparation, PreparationModel

    rng = np.random.default_rng(2)
    X = np.round(rng.normal(size=(400, 2)) * 10, 2)
    X[rng.random(X.shape) < 0.1] = np.nan
    X[5] = [900.0, -900.0]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x], f"level{i}" if i % 9 else None, 1.0 * i) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, y double")
    train, test = df.where("id < 300"), df.where("id >= 300 or id = 5")
    config = {"missing_values": {"strategy": "knn", "knn_neighbors": 3}, "outliers": {"method": "isolation_forest", "treatment": "flag"}, "time_features": {"enabled": False}, "categorical": {"method": "label"}, "scaling": {"enabled": False}}
    model = Preparation(config).fit(train, "y", "id")
    got = {r.id: r for r in model.transform(test).collect()}
    T, dist = X[:300], distances(X, X[:300])
    for i in range(300, 400):
        for j, c in enumerate("ab"):
            want = X[i, j]
            if np.isnan(want):
                has = np.flatnonzero(~np.isnan(T[:, j]) & np.isfinite(dist[i]))
                near = has[np.lexsort((has, dist[i, has]))][:3]
                want = T[near, j].mean() if near.size else np.nanmean(T[:, j])
            assert got[i][c] == pytest.approx(want)
    assert got[5].is_outlier == 1 and sum(r.is_outlier for r in got.values()) < 20
    path = scratch_path(spark, "preparation-test")
    model.save(spark, path)
    again = PreparationModel.load(spark, path)
    assert sorted(again.transform(test).collect()) == sorted(got.values())
    full = Preparation({"time_features": {"enabled": False}}).fit(train.drop("c"), "y", "id")
    full.save(spark, path + "-b")
    assert sorted(PreparationModel.load(spark, path + "-b").transform(test.drop("c")).collect()) == sorted(full.transform(test.drop("c")).collect())
    for bad in ({"missing_values": {"strategy": "knn"}}, {"outliers": {"method": "isolation_forest"}}):
        with pytest.raises(ValueError):
            Preparation(bad).fit(train, "y")
    with pytest.raises(ValueError):
        Preparation({"outliers": {"method": "odd"}}).fit(train, "y", "id")
