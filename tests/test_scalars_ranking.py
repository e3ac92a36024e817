"""Hand-computed edge cases for column functions, ranks and segments."""

import math

import pytest
from pyspark.sql import functions as F

from tabstrata.functions import scalars as S
from tabstrata.operators import ranking as R


def test_time_of_day_and_peak_edges(spark):
    hours = [4.99, 5.0, 7.0, 9.0, 9.02, 11.99, 12.0, 17.0, 19.0, 19.02, 21.0, 23.98, None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "id int, h double")
    rows = df.select("id", S.time_of_day("h").alias("t"), S.is_peak_hour("h").alias("p")).orderBy("id").collect()
    assert [r["t"] for r in rows] == ["night", "morning", "morning", "morning", "morning", "morning", "afternoon",
                                      "evening", "evening", "evening", "night", "night", "unknown"]
    assert [r["p"] for r in rows] == [0, 0, 1, 1, 0, 0, 0, 1, 1, 0, 0, 0, 0]


def test_clip_keeps_null_and_pct_floor(spark):
    df = spark.createDataFrame([(None, 1.0), (5.0, 0.0), (-3.0, 2.0)], "y double, p double")
    out = df.select(S.clip("y", 0.0, 4.0).alias("c"), S.pct_error("y", "p").alias("e")).collect()
    assert out[0]["c"] is None and out[1]["c"] == 4.0 and out[2]["c"] == 0.0
    assert out[1]["e"] == pytest.approx(100.0)
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, p double").select(S.pct_error("y", "p")).first()[0]
    assert zero == pytest.approx(1.0 / 1e-7 * 100)


def test_fit_band(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.75,), (0.5,), (-1.0,)], "r2 double")
    assert [r[0] for r in df.select(S.fit_band("r2")).collect()] == ["excellent", "good", "good", "poor", "poor"]


def test_weighted_bucket_requires_unit_sum():
    with pytest.raises(ValueError):
        S.cumulative_thresholds([0.5, 0.4])
    assert S.cumulative_thresholds([0.5, 0.25], normalize=True) == [pytest.approx(2 / 3)]


def test_uniform_draw_is_partition_independent(spark):
    df = spark.range(1000)
    a = df.select("id", S.uniform("id", 42, "t").alias("u"))
    b = df.repartition(7).select("id", S.uniform("id", 42, "t").alias("u"))
    assert sorted(a.collect()) == sorted(b.collect())
    u = [r["u"] for r in a.collect()]
    assert 0.0 <= min(u) and max(u) < 1.0


@pytest.mark.parametrize("n,k,sizes", [(11, 3, [4, 3, 4]), (1, 3, [1]), (2, 3, [1, 1]), (10, 5, [2, 2, 2, 2, 2])])
def test_qcut_segment_sizes(spark, n, k, sizes):
    df = spark.range(n).select(R.qcut_segment(F.col("id"), F.lit(n), k).alias("s"))
    counts = [r["count"] for r in df.groupBy("s").count().orderBy("s").collect()]
    assert counts == sizes


def test_global_rank_matches_row_number_with_heavy_ties(spark):
    # a third of the rows share one key: they must still be split across buckets and ranked by id
    rows = [(i, 7.0 if i % 3 == 0 else float(i % 97)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k double").repartition(5)
    got = {r["id"]: r["rank"] for r in R.global_rank(df, "k", "id", n_buckets=16).collect()}
    want = {row[0]: i + 1 for i, row in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert got == want


def test_global_rank_descending_and_nulls_last(spark):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 5.0), (4, 3.0)], "id long, k double")
    got = {r["id"]: r["rank"] for r in R.global_rank(df, "k", "id", n_buckets=4).collect()}
    assert got == {1: 1, 4: 2, 3: 3, 2: 4}
    d = {r["id"]: r["rank"] for r in R.global_rank(df.where("k is not null"), "k", "id", descending=True).collect()}
    assert d == {3: 1, 1: 2, 4: 3}


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 10.0), (4, 30.0)], "id long, v double")
    got = {r["id"]: r["r"] for r in R.average_rank(df, "v", "r").collect()}
    assert got == {1: 1.5, 3: 1.5, 2: 3.0, 4: 4.0}


def test_norm_ppf_accuracy(spark):
    from tabstrata.operators.metrics import norm_ppf
    ps = [0.001, 0.02, 0.1, 0.5, 0.9, 0.975, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(norm_ppf(F.col("p"))).collect()]
    from statistics import NormalDist
    for p, g in zip(ps, got):
        assert g == pytest.approx(NormalDist().inv_cdf(p), abs=1e-8)
    assert not any(math.isnan(g) for g in got)


@pytest.mark.parametrize("k", [2, 3, 7])
def test_qcut_rows_and_folds_match_positions(spark, k):
    """Boundary cuts label rows exactly as positions in (key, id) order would:
    a key holding a third of the rows, null keys last, a repeated (key, id) run."""
    from tabstrata.operators import tuning as TU
    rows = [(i, 5.0 if i % 3 == 0 else (None if i % 17 == 0 else float(i % 11))) for i in range(1, 301)]
    rows += [(42, 5.0)] * 6                                   # a repeated (key, id) run
    df = spark.createDataFrame(rows, "id long, v double").repartition(4)
    order = sorted(range(len(rows)), key=lambda j: (rows[j][1] is None, rows[j][1] or 0.0, rows[j][0]))
    n = len(rows)
    seg = R.qcut_rows(df, "v", "id", k).groupBy("v", "id", "segment").count().collect()
    got_sizes = sorted((r["segment"], r["count"]) for r in seg)
    seg_of = {}
    for p0 in range(n):
        s = 1 if n <= 1 else max(1, (p0 * k + n - 2) // (n - 1))
        seg_of[s] = seg_of.get(s, 0) + 1
    sizes = {}
    for s, c in got_sizes:
        sizes[s] = sizes.get(s, 0) + c
    assert sizes == seg_of
    for r in seg:   # every (v, id) group lies in the segments its positions span
        ps = [p0 for p0, j in enumerate(order) if rows[j][0] == r["id"] and rows[j][1] == r["v"]]
        segs = {max(1, (p0 * k + n - 2) // (n - 1)) for p0 in ps}
        assert r["segment"] in segs
    folds = TU.assign_folds(df, "id", k).groupBy("fold").count().collect()
    small, big = n // k, n % k
    assert sorted((r["fold"], r["count"]) for r in folds) == [(j, small + (1 if j < big else 0)) for j in range(k)]


def test_rank_and_segments_of_keys_that_share_a_double(spark):
    from pyspark.sql import functions as F
    from tabstrata.operators.ranking import global_rank, qcut_rows
    big = 2**53
    df = spark.range(2000).select(F.col("id"), (F.lit(big) + F.col("id") % 2).alias("k")).repartition(5)
    rows = sorted(df.collect(), key=lambda r: (r["k"], r["id"]))
    want = {r["id"]: i + 1 for i, r in enumerate(rows)}
    assert {r["id"]: r["rank"] for r in global_rank(df, "k", "id", n_buckets=16).collect()} == want
    seg = qcut_rows(df, "k", "id", 2).groupBy("segment").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("segment").collect()
    assert [(r["n"], r["lo"], r["hi"]) for r in seg] == [(1000, big, big), (1000, big + 1, big + 1)]


def test_labels_of_repeated_ids_do_not_depend_on_layout(spark):
    from pyspark.sql import functions as F
    from tabstrata.operators.tuning import assign_folds
    df = spark.range(101).select((F.col("id") % 3).alias("i"), (F.col("id") * 7 % 50).alias("x"), F.col("id").alias("u"))
    a = {r["u"]: r["fold"] for r in assign_folds(df.repartition(7), "i", 5).collect()}
    b = {r["u"]: r["fold"] for r in assign_folds(df.coalesce(1), "i", 5).collect()}
    assert a == b


@pytest.mark.parametrize("by_key", [True, False])
def test_buckets_of_many_heavy_values_stay_few(spark, by_key):
    """Heavy values are split by their own ids, wherever these lie among all ids; buckets stay few and even."""
    n, values, nb = 12000, 60, 128
    rows = [(i, i * values // n if by_key else i % values) for i in range(n)] + [(n + i, 7) for i in range(n // 2)] + [(2 * n + i, None) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, k long").repartition(5)
    sizes = [r["count"] for r in R._bucket_columns(df, "k", "id", nb, False).groupBy("_maj", "_min").count().collect()]
    assert len(sizes) <= 3 * nb and max(sizes) <= 3 * len(rows) / nb
    want = {row[0]: i + 1 for i, row in enumerate(sorted(rows, key=lambda t: (t[1] is None, t[1] or 0, t[0])))}
    assert {r["id"]: r["rank"] for r in R.global_rank(df, "k", "id", n_buckets=nb).collect()} == want
