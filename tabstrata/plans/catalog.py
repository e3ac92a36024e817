"""
driver tables (spark, sf_dir) -> DataFrame. Names follow SURVEY §7.4.

Doubles are rounded (6 places unless the magnitude asks for fewer) so that
the DuckDB oracle can compare values across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import density as DEN
from ..operators import metrics as M
from ..operators import prepare as P
from ..operators import profile as PR
from ..operators import ranking as R
from ..operators import relations as REL
from ..session import table
from ..sources.posts import posts_with_missing

# The reference's image-count weights (0..10) and hashtag-count
# weights (0..30) as written; the latter sum to 0.625 and need normalize=True.
IMAGE_WEIGHTS = [0.20, 0.35, 0.25, 0.10, 0.05, 0.02, 0.01, 0.01, 0.005, 0.004, 0.001]
HASHTAG_WEIGHTS = [0.05] + [0.04] * 5 + [0.03] * 5 + [0.02] * 5 + [0.01] * 10 + [0.005] * 5

SEED = 42
MISSING_PCT = 0.05
LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
POST_NUM = ["post_hour", "post_day", "k", "user_id", "target"]


def r(c, d: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def round_doubles(df: DataFrame, d: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[r(f.name, d).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       and f.name not in skip else F.col(f.name) for f in df.schema.fields])


#: A unique id of a line item: order, line, part and supplier.
ROW_ID = "((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey"


def _posts_na(spark: SparkSession, d: str) -> DataFrame:
    return posts_with_missing(table(spark, d, "events"), MISSING_PCT, SEED)


def _line_pred(spark: SparkSession, d: str) -> DataFrame:
    """Predictions table used by the metric queries: actual l_extendedprice against a
    fixed-rate prediction from the quantity."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag"),
                     F.expr(ROW_ID).alias("row_id"),
                     F.col("l_extendedprice").alias("label"),
                     (F.col("l_quantity") * 1500.0).alias("prediction"),
                     (F.col("l_quantity") * 1000.0 + 10000.0).alias("prediction_b"))


# --------------------------------------------------------------------------------------
# Flagship: posts -> A6 nulls -> E1 mean -> E6 clip -> C5
# --------------------------------------------------------------------------------------
def mean_std_by_hour(spark: SparkSession, d: str) -> DataFrame:
    p = _posts_na(spark, d).select("post_id", "post_hour", "target")
    p = P.impute(p, "mean", ["post_hour"])
    bounds = PR.iqr_bounds_dict(p, ["target"])
    p = PR.apply_iqr_treatment(p, bounds, "clip")
    g = REL.group_mean_std(p, S.hour_bucket("post_hour"), "target", "hour")
    return round_doubles(g)


# --------------------------------------------------------------------------------------
# A: sources / sinks / draws
# --------------------------------------------------------------------------------------
def inject_missing(spark, d):
    return round_doubles(_posts_na(spark, d))


def weighted_bucket(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id",
                     S.weighted_bucket("event_id", IMAGE_WEIGHTS, SEED, "images").alias("images_count"),
                     S.weighted_bucket("event_id", HASHTAG_WEIGHTS, SEED, "hashtags", normalize=True)
                     .alias("hashtags_count"))


def csv_round_trip(spark, d):
    from ..session import scratch_path
    from ..sources.io import read_csv, write_table
    sup = table(spark, d, "supplier")
    path = write_table(sup, scratch_path(spark, "supplier_csv"), "csv")
    schema = ", ".join(f"{n} {t}" for n, t in sup.dtypes)
    return read_csv(spark, path, schema)


def metrics_sink(spark, d):
    from ..session import scratch_path
    from ..sources.io import read_csv, write_metrics
    m = M.regression_metrics(_line_pred(spark, d), group=["l_returnflag"])
    path = write_metrics(m, scratch_path(spark, "metrics_csv"))
    back = read_csv(spark, path, "l_returnflag string, mse double, rmse double, mae double, r2 double, "
                                 "mape double, n bigint")
    return round_doubles(back, 4)


# --------------------------------------------------------------------------------------
# B: scalar functions
# --------------------------------------------------------------------------------------
def engagement_score(spark, d):
    li = table(spark, d, "lineitem")
    pa = table(spark, d, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    score = S.engagement_score(F.col("l_quantity") * 10, F.col("l_linenumber"), F.col("p_size"),
                               F.col("p_retailprice"), F.col("l_discount") * 100 + F.col("l_tax") * 100,
                               S.day_of_week("l_shipdate"))
    return j.select("l_orderkey", "l_linenumber", r(score).alias("engagement_rate"))


def time_features(spark, d):
    p = _posts_na(spark, d).select("post_id", "post_hour", "post_day")
    t = S.engineer_time_features(p).withColumn("hour_bucket", S.hour_bucket("post_hour"))
    return round_doubles(t)


def clip(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", r(S.clip("value", 1.0, 100.0)).alias("value_clipped"))


def iqr_filter(spark, d):
    docs = table(spark, d, "documents")
    (lo, hi), = PR.iqr_bounds_dict(docs, ["n_chars"]).values()
    return docs.where(PR.is_outside("n_chars", lo, hi)).select("doc_id", "n_chars")


def iqr_flag(spark, d):
    p = _posts_na(spark, d).select("post_id", "k", "target")
    b = PR.iqr_bounds_dict(p, ["k", "target"])
    return PR.apply_iqr_treatment(p, b, "flag").select("post_id", "is_outlier")


def iqr_remove(spark, d):
    p = _posts_na(spark, d).select("post_id", "k", "target")
    b = PR.iqr_bounds_dict(p, ["k", "target"])
    return round_doubles(PR.apply_iqr_treatment(p, b, "remove"))


def outlier_summary(spark, d):
    p = _posts_na(spark, d)
    _, summary = PR.detect_and_handle_outliers(p, ["post_hour", "post_day", "k", "target"], treatment="clip")
    return round_doubles(summary)


def iqr_treat(spark, d):
    pa = table(spark, d, "part")
    b = PR.iqr_bounds_dict(pa, ["p_size", "p_retailprice"])
    return round_doubles(PR.apply_iqr_treatment(pa, b, "clip").select("p_partkey", "p_size", "p_retailprice"))


def select_numeric(spark, d):
    cu = table(spark, d, "customer")
    feats, target = PR.features_target(cu, "c_acctbal")
    cols = PR.numeric_columns(feats)
    return feats.select(*cols).where(F.col("c_nationkey").isNotNull())


def error_columns(spark, d):
    e = M.error_columns(_line_pred(spark, d))
    return round_doubles(e.select("row_id", "residual", "abs_error", "pct_error"), 4)


def fit_band(spark, d):
    m = M.with_fit_band(M.regression_metrics(_line_pred(spark, d), group=["l_returnflag"]))
    return round_doubles(m.select("l_returnflag", "r2", "fit"))


# --------------------------------------------------------------------------------------
# C: profiles and statistics
# --------------------------------------------------------------------------------------
def describe(spark, d):
    return round_doubles(PR.describe(_posts_na(spark, d), POST_NUM))


def shape(spark, d):
    return PR.shape(table(spark, d, "orders"))


def missing(spark, d):
    return round_doubles(PR.missing(_posts_na(spark, d)))


def value_counts(spark, d):
    return PR.value_counts(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def distinct(spark, d):
    return PR.n_unique(_posts_na(spark, d))


def quantiles(spark, d):
    return round_doubles(PR.iqr_bounds(table(spark, d, "lineitem"), LINE_COLS))


def corr_pearson(spark, d):
    return round_doubles(REL.pearson_matrix(table(spark, d, "lineitem"), LINE_COLS))


def corr_spearman(spark, d):
    return round_doubles(REL.spearman_matrix(table(spark, d, "lineitem"), LINE_COLS))


#: lineitem columns and the rows where the query with nulls leaves them out
NULL_WHERE = {"l_quantity": "l_linenumber = 2", "l_extendedprice": "l_returnflag = 'R'", "l_discount": "l_orderkey % 7 = 3", "l_tax": "false"}


def corr_spearman_nulls(spark, d):
    li = table(spark, d, "lineitem").select(*[F.expr(f"CASE WHEN NOT ({where}) THEN {c} END").alias(c) for c, where in NULL_WHERE.items()])
    return round_doubles(REL.spearman_matrix(li, LINE_COLS))


def corr_kendall(spark, d):
    return round_doubles(REL.kendall_matrix(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]))


def corr_kendall_wide(spark, d):
    """Kendall tau-b on high-cardinality columns (exact divide-and-conquer path)."""
    return round_doubles(REL.kendall_pair(table(spark, d, "orders"), "o_totalprice", "o_custkey"))


def corr_lower(spark, d):
    m = REL.pearson_matrix(table(spark, d, "lineitem"), LINE_COLS)
    return round_doubles(REL.lower_triangle(m, LINE_COLS))


def corr_target(spark, d):
    p = _posts_na(spark, d)
    return round_doubles(REL.target_correlations(p, "target", POST_NUM))


def ols_line(spark, d):
    return round_doubles(REL.regression_line(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"), 4)


def mean_std_by_type(spark, d):
    ev = table(spark, d, "events")
    return round_doubles(REL.group_mean_std(ev, "event_type", "value", "event_type"))


# --------------------------------------------------------------------------------------
# evaluation
# --------------------------------------------------------------------------------------
def metrics(spark, d):
    return round_doubles(M.regression_metrics(_line_pred(spark, d)), 4)


def residual_stats(spark, d):
    return round_doubles(M.residual_stats(_line_pred(spark, d)), 4)


def actual_pred(spark, d):
    return round_doubles(M.actual_vs_predicted(_line_pred(spark, d), bins=10), 4)


def resid_bins(spark, d):
    return round_doubles(M.residual_bins(_line_pred(spark, d), bins=10), 4)


def segments(spark, d):
    return round_doubles(M.segments(_line_pred(spark, d), "label", "prediction", "row_id", 5), 4)


def compare_models(spark, d):
    lp = _line_pred(spark, d)
    u = (lp.select("label", "prediction", F.lit("rate_1500").alias("model"))
         .unionByName(lp.select("label", F.col("prediction_b").alias("prediction"), F.lit("affine").alias("model"))))
    return round_doubles(M.compare_models(u, metric="rmse"), 4)


def best_model(spark, d):
    lp = _line_pred(spark, d)
    u = (lp.select("label", "prediction", F.lit("rate_1500").alias("model"))
         .unionByName(lp.select("label", F.col("prediction_b").alias("prediction"), F.lit("affine").alias("model"))))
    return round_doubles(R.best_by(M.compare_models(u), "mse").select("model", "mse"), 2)


# --------------------------------------------------------------------------------------
# D: sorts, top-k, ranks
# --------------------------------------------------------------------------------------
def top_corr(spark, d):
    t = REL.target_correlations(_posts_na(spark, d), "target", POST_NUM)
    return round_doubles(R.top_n_abs(t, "corr", 3, "feature"))


def sample_rows(spark, d):
    return round_doubles(R.sample_rows(table(spark, d, "events"), 5, SEED, "event_id"))


def global_rank(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return R.global_rank(ev, "value", "event_id", "rank")


def qcut(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return R.qcut_rows(ev, "value", "event_id", 7).select("event_id", "segment")


# --------------------------------------------------------------------------------------
# E: preparation
# --------------------------------------------------------------------------------------
def _impute(strategy):
    def q(spark, d):
        p = _posts_na(spark, d)
        return round_doubles(P.impute(p, strategy, ["post_hour", "post_day", "k", "user_id", "category"]))
    q.__name__ = f"impute_{strategy}"
    return q


def _scale(method):
    def q(spark, d):
        p = _posts_na(spark, d)
        out, _ = P.scale(p, method, ["post_hour", "post_day", "k", "target"])
        return round_doubles(out)
    q.__name__ = f"scale_{method}"
    return q


def _encode(method):
    def q(spark, d):
        p = _posts_na(spark, d).select("post_id", "category")
        p = S.engineer_time_features(_posts_na(spark, d).select("post_id", "post_hour")).select("post_id", "time_of_day") \
            .join(p, "post_id")
        return P.encode(p, method, ["category", "time_of_day"])
    q.__name__ = f"encode_{method}"
    return q


def _encode_many(method):
    """Codes of a column with a level a part and order (null in every 97th row)."""
    def q(spark, d):
        li = table(spark, d, "lineitem").select(F.expr(ROW_ID).alias("row_id"), F.when(F.col("l_partkey") % 97 != 0, F.concat_ws("-", "l_partkey", "l_orderkey")).alias("item"))
        return P.encode(li, method, ["item"])
    q.__name__ = f"encode_many_{method}"
    return q


def split(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return P.split_labels(ev, "event_id", 0.2, 0.1, SEED).select("event_id", "split")


def split_stratified(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    return P.split_labels_stratified(ev, "event_id", "event_type", 0.2, 0.0, SEED).select("event_id", "split")


QUERIES = {
    "mean_std_by_hour": mean_std_by_hour,
    "inject_missing": inject_missing,
    "weighted_bucket": weighted_bucket,
    "csv_round_trip": csv_round_trip,
    "metrics_sink": metrics_sink,
    "engagement_score": engagement_score,
    "time_features": time_features,
    "clip": clip,
    "iqr_filter": iqr_filter,
    "iqr_flag": iqr_flag,
    "iqr_remove": iqr_remove,
    "outlier_summary": outlier_summary,
    "iqr_treat": iqr_treat,
    "select_numeric": select_numeric,
    "error_columns": error_columns,
    "fit_band": fit_band,
    "describe": describe,
    "shape": shape,
    "missing": missing,
    "value_counts": value_counts,
    "distinct": distinct,
    "quantiles": quantiles,
    "corr_pearson": corr_pearson,
    "corr_spearman": corr_spearman,
    "corr_spearman_nulls": corr_spearman_nulls,
    "corr_kendall": corr_kendall,
    "corr_kendall_wide": corr_kendall_wide,
    "corr_lower": corr_lower,
    "corr_target": corr_target,
    "ols_line": ols_line,
    "mean_std_by_type": mean_std_by_type,
    "metrics": metrics,
    "residual_stats": residual_stats,
    "actual_pred": actual_pred,
    "resid_bins": resid_bins,
    "segments": segments,
    "compare_models": compare_models,
    "best_model": best_model,
    "top_corr": top_corr,
    "sample_rows": sample_rows,
    "global_rank": global_rank,
    "qcut": qcut,
    "impute_mean": _impute("mean"),
    "impute_median": _impute("median"),
    "impute_most_frequent": _impute("most_frequent"),
    "impute_constant": _impute("constant"),
    "scale_standard": _scale("standard"),
    "scale_minmax": _scale("minmax"),
    "scale_robust": _scale("robust"),
    "encode_onehot": _encode("one_hot"),
    "encode_label": _encode("label"),
    "encode_ordinal": _encode("ordinal"),
    "encode_many_label": _encode_many("label"),
    "encode_many_ordinal": _encode_many("ordinal"),
    "split": split,
    "split_stratified": split_stratified,
}


# --------------------------------------------------------------------------------------
# distributions
# --------------------------------------------------------------------------------------
def histogram(spark, d):
    return round_doubles(DEN.histogram(table(spark, d, "events"), "value", 30))


def histogram_auto(spark, d):
    return round_doubles(DEN.histogram(table(spark, d, "lineitem"), "l_extendedprice", "auto"), 4)


def kde(spark, d):
    return round_doubles(DEN.kde(table(spark, d, "events"), "value", grid_size=200))


def box_stats(spark, d):
    return round_doubles(DEN.box_stats(table(spark, d, "events"), "value", "event_type"))


def violin(spark, d):
    return round_doubles(DEN.violin(table(spark, d, "events"), "value", "event_type", grid_size=50))


def group_ci(spark, d):
    return round_doubles(DEN.group_ci(table(spark, d, "events"), "value", "event_type"))


def bootstrap_ci(spark, d):
    return round_doubles(DEN.bootstrap_mean_ci(table(spark, d, "events"), "value", "event_id", "event_type",
                                               replicates=1000, seed=SEED))


def ols_band(spark, d):
    li = table(spark, d, "lineitem").select(F.expr(ROW_ID).alias("row_id"),
                                            "l_quantity", "l_extendedprice")
    return round_doubles(DEN.regression_band(li, "l_quantity", "l_extendedprice", "row_id", replicates=1000,
                                             seed=SEED), 2)


def pair_density(spark, d):
    li = table(spark, d, "lineitem")
    return DEN.pair_density(li, LINE_COLS, bins=20)


def before_after(spark, d):
    li = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    b = PR.iqr_bounds_dict(li, ["l_quantity", "l_extendedprice"])
    after = PR.apply_iqr_treatment(li, b, "clip")
    return round_doubles(DEN.before_after(li, after, ["l_quantity", "l_extendedprice"], bins=30), 4)


QUERIES.update({
    "histogram": histogram,
    "histogram_auto": histogram_auto,
    "kde": kde,
    "box_stats": box_stats,
    "violin": violin,
    "group_ci": group_ci,
    "bootstrap_ci": bootstrap_ci,
    "ols_band": ols_band,
    "pair_density": pair_density,
    "before_after": before_after,
})


# --------------------------------------------------------------------------------------
# E2 / E7 / E9 / C25
# --------------------------------------------------------------------------------------
KNN_COLS = ["x_nation", "x_balance", "x_segment"]


def _customer_na(spark, d):
    cu = table(spark, d, "customer")
    base = cu.select("c_custkey", F.col("c_nationkey").cast("double").alias("x_nation"),
                     (F.col("c_acctbal") / 1000.0).alias("x_balance"),
                     F.length("c_mktsegment").cast("double").alias("x_segment"))
    return S.inject_missing(base, KNN_COLS, 0.1, SEED, "c_custkey")


def impute_knn(spark, d):
    from ..operators.knn import knn_impute
    return round_doubles(knn_impute(_customer_na(spark, d), KNN_COLS, "c_custkey", k=5))


def isolation_forest(spark, d):
    p = P.impute(_posts_na(spark, d), "mean", ["post_hour", "post_day", "k"])
    out, _ = PR.detect_and_handle_outliers(p, ["post_hour", "post_day", "k", "target"], method="isolation_forest",
                                           treatment="flag", id_col="post_id", seed=SEED)
    return out.select("post_id", "is_outlier")


def preprocess(spark, d):
    from .pipeline import preprocess as prep
    p = _posts_na(spark, d)
    train, _, test, _ = prep(p, "target", "post_id", test_size=0.2, seed=SEED)
    return round_doubles(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))))


def preprocess_knn(spark, d):
    """Fitted KNN imputation and isolation forest: training rows are searched for both parts."""
    from .pipeline import preprocess as prep
    p = _posts_na(spark, d)
    config = {"missing_values": {"strategy": "knn"}, "outliers": {"method": "isolation_forest", "treatment": "flag"}}
    train, _, test, _ = prep(p, "target", "post_id", config, test_size=0.2, seed=SEED)
    return round_doubles(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))))


def qq(spark, d):
    line, _ = M.qq(_line_pred(spark, d), "label", "prediction", "row_id")
    return round_doubles(line, 4)


def qq_points(spark, d):
    _, pts = M.qq(_line_pred(spark, d), "label", "prediction", "row_id", points=100)
    return round_doubles(pts, 4)


# --------------------------------------------------------------------------------------
# F: models, tuning, reports
# --------------------------------------------------------------------------------------
LINE_FEATS = ["l_quantity", "l_discount", "l_tax"]
POST_FEATS = ["post_hour", "post_day", "k", "user_id"]


def _lineitem_ml(spark, d):
    return table(spark, d, "lineitem").select(
        F.expr(ROW_ID).alias("row_id"), *LINE_FEATS, "l_extendedprice")


def _split_lines(spark, d):
    """Training and test line items, labelled once: every job of a fit or a report reads them, and a filter on the label draws each row's md5 again for every comparison."""
    from ..session import scratch_path
    path = scratch_path(spark, "split-lines")
    P.split_labels(_lineitem_ml(spark, d), "row_id", 0.2, 0.0, SEED).write.parquet(path)
    lab = spark.read.parquet(path)
    return lab.where(F.col("split") == "train"), lab.where(F.col("split") == "test")


def _posts_ml(spark, d):
    return P.impute(_posts_na(spark, d), "mean", POST_FEATS).drop("category")


def linear(spark, d):
    from ..operators import models as MD
    li = _lineitem_ml(spark, d)
    m = MD.train(li, ["l_quantity"], "l_extendedprice", "linear")
    return round_doubles(MD.coefficients(m, ["l_quantity"]), 4)


def _penalized(kind, **kw):
    def q(spark, d):
        from ..operators import models as MD
        li = _lineitem_ml(spark, d)
        m = MD.train(li, LINE_FEATS, "l_extendedprice", kind, **kw)
        return round_doubles(MD.coefficients(m, LINE_FEATS), 4)
    q.__name__ = kind
    return q


def _tree_model(kind, **kw):
    def q(spark, d):
        from ..operators import models as MD
        p = _posts_ml(spark, d)
        m = MD.train(p, POST_FEATS, "target", kind, **kw)
        return round_doubles(MD.predict(m, p.select("post_id", *POST_FEATS)).select("post_id", "prediction"), 4)
    q.__name__ = kind
    return q


def svr(spark, d):
    from ..operators import models as MD
    p = _posts_ml(spark, d)
    m = MD.train(p, POST_FEATS, "target", "svr")
    return round_doubles(m.transform(p.select("post_id", *POST_FEATS)).select("post_id", "prediction"), 4)


def svr_exact(spark, d):
    """Exact RBF SVR of customers' balances, with the rows that violate its conditions (none)."""
    from ..operators import models as MD
    cu = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("nation"), F.length("c_mktsegment").cast("double").alias("segment"),
                                            (F.col("c_custkey") % 100).cast("double").alias("key"), (F.col("c_acctbal") / 1000).alias("balance"))
    m = MD.train(cu, ["nation", "segment", "key"], "balance", "svr", exact=True)
    return round_doubles(m.transform(cu).select("c_custkey", "prediction"), 1).withColumn("violators", F.lit(m.violators))


def predict(spark, d):
    from ..operators import models as MD
    li = _lineitem_ml(spark, d)
    m = MD.train(li, LINE_FEATS, "l_extendedprice", "linear")
    return round_doubles(MD.predict(m, li).select("row_id", "prediction"), 2)


def importance(spark, d):
    from ..operators import models as MD
    p = _posts_ml(spark, d)
    m = MD.train(p, POST_FEATS, "target", "random_forest")
    return round_doubles(MD.feature_importances(m, POST_FEATS), 4)


def grid(spark, d):
    from ..operators import tuning as TU
    li = _lineitem_ml(spark, d)
    _, _, _, res = TU.search(li, LINE_FEATS, "l_extendedprice", "row_id", "ridge", cv=5)
    return round_doubles(res, 2)


def random_search(spark, d):
    from ..operators import tuning as TU
    li = _lineitem_ml(spark, d)
    _, _, _, res = TU.search(li, LINE_FEATS, "l_extendedprice", "row_id", "lasso", cv=5, search_method="random",
                             n_iter=10, seed=SEED)
    return round_doubles(res, 2)


def cv_folds(spark, d):
    from ..operators import tuning as TU
    ev = table(spark, d, "events").select("event_id", "value")
    return TU.assign_folds(ev, "event_id", 5).select("event_id", "fold")


def cv_scores(spark, d):
    from ..operators import tuning as TU
    li = _lineitem_ml(spark, d)
    per_fold, _ = TU.cross_validate(li, LINE_FEATS, "l_extendedprice", "row_id", "linear", 5)
    return round_doubles(per_fold, 2)


def _odd_lines(spark, d):
    """Line items with nulls in a feature and the label, an offset label, and a column that is the sum of two others."""
    li = _lineitem_ml(spark, d)
    gap = lambda c, k: F.when(F.col("row_id") % k != 0, F.col(c)).alias(c)
    return li.select("row_id", gap("l_quantity", 7), "l_discount", "l_tax", (F.col("l_discount") + F.col("l_tax")).alias("both"),
                     F.lit(1.0).alias("one"), (gap("l_extendedprice", 11) + 1e5).alias("price"))


def cv_nulls(spark, d):
    from ..operators import tuning as TU
    per_fold, _ = TU.cross_validate(_odd_lines(spark, d), LINE_FEATS, "price", "row_id", "linear", 5)
    return round_doubles(per_fold, 2)


def cv_collinear(spark, d):
    from ..operators import tuning as TU
    per_fold, _ = TU.cross_validate(_odd_lines(spark, d), [*LINE_FEATS, "both", "one"], "price", "row_id", "linear", 5)
    return round_doubles(per_fold, 2)


def learning_curve_uneven(spark, d):
    from ..operators import tuning as TU
    c = TU.learning_curve(_odd_lines(spark, d), LINE_FEATS, "price", "row_id", "linear", cv=7, train_sizes=[0.1, 0.37, 1.0])
    return round_doubles(c, 2)


def learning_curve(spark, d):
    from ..operators import tuning as TU
    li = _lineitem_ml(spark, d)
    c = TU.learning_curve(li, LINE_FEATS, "l_extendedprice", "row_id", "linear")
    return round_doubles(TU.diagnose(c), 4)


def model_save_load(spark, d):
    from ..operators import models as MD
    from ..session import scratch_path
    from ..sources.io import load_model, save_model
    li = _lineitem_ml(spark, d)
    m = MD.train(li, LINE_FEATS, "l_extendedprice", "linear")
    path = save_model(m, scratch_path(spark, "models"), "linear")
    back = load_model(path)
    return round_doubles(MD.predict(back, li).select("row_id", "prediction"), 2)


def _digits(f) -> Column:
    """A double at nine digits, so that the order of sums doesn't show."""
    c = F.col(f"`{f.name}`")
    return F.format_string("%.9g", c).cast("double").alias(f.name) if f.dataType.typeName() in ("double", "float") else c


def _bundle_parts(bundle: dict) -> DataFrame:
    """One row a part: its name, its number of rows and all of them, sorted, as JSON."""
    parts = []
    for name, df in bundle.items():
        rows = F.array_sort(F.collect_list(F.struct(*[_digits(f) for f in df.schema.fields])))
        told = df.agg(F.count(F.lit(1)).alias("n_rows"), F.to_json(rows, {"ignoreNullFields": "false"}).alias("rows"))
        parts.append(told.select(F.lit(name).alias("part"), "n_rows", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def eda_report(spark, d):
    from .report import eda_report as eda
    p = _posts_na(spark, d)
    return _bundle_parts(eda(p, "target", "post_id"))


def evaluation_report(spark, d):
    from ..operators import models as MD
    from .report import evaluation_report as ev
    train, test = _split_lines(spark, d)
    m = MD.train(train, LINE_FEATS, "l_extendedprice", "linear")
    return _bundle_parts(ev(m, test, LINE_FEATS, "l_extendedprice", "row_id", "linear", train=train))


def train_models(spark, d):
    from ..operators import models as MD
    from .report import train_models as tm
    train, test = _split_lines(spark, d)
    models, _ = tm(train, LINE_FEATS, "l_extendedprice", "row_id", ["linear", "ridge", "gradient_boosting"])
    preds = None
    for name, m in models.items():
        p = MD.predict(m, test).select(F.lit(name).alias("model"), "l_extendedprice", "prediction")
        preds = p if preds is None else preds.unionByName(p)
    return round_doubles(M.compare_models(preds, "l_extendedprice", "prediction"), 2)


def run(spark, d):
    from .report import run as run_all
    p = _posts_na(spark, d)
    res = run_all(p, "target", "post_id", model_types=["linear", "random_forest"])
    return round_doubles(res["comparison"], 4)


QUERIES.update({
    "impute_knn": impute_knn,
    "isolation_forest": isolation_forest,
    "preprocess_knn": preprocess_knn,
    "preprocess": preprocess,
    "qq": qq,
    "qq_points": qq_points,
    "linear": linear,
    "ridge": _penalized("ridge", alpha=1.0),
    "lasso": _penalized("lasso", alpha=1.0),
    "enet": _penalized("elasticnet", alpha=1.0, l1_ratio=0.5),
    "forest": _tree_model("random_forest"),
    "boosting": _tree_model("gradient_boosting"),
    "svr": svr,
    "svr_exact": svr_exact,
    "predict": predict,
    "importance": importance,
    "grid": grid,
    "random": random_search,
    "cv_folds": cv_folds,
    "cv_scores": cv_scores,
    "cv_nulls": cv_nulls,
    "cv_collinear": cv_collinear,
    "learning_curve_uneven": learning_curve_uneven,
    "learning_curve": learning_curve,
    "model_save_load": model_save_load,
    "eda_report": eda_report,
    "evaluation_report": evaluation_report,
    "train_models": train_models,
    "run": run,
})
