"""Plan checks: no Python in JVM-only queries, no whole-table single-partition
step over data rows, and column pruning down to the scan."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")
JVM_ONLY = ["mean_std_by_hour", "describe", "missing", "value_counts", "distinct", "quantiles", "corr_pearson",
            "corr_spearman", "histogram", "kde", "box_stats", "group_ci", "pair_density", "metrics", "segments",
            "compare_models", "global_rank", "qcut", "impute_most_frequent", "scale_robust", "encode_onehot",
            "split", "split_stratified", "preprocess", "outlier_summary", "time_features", "cv_folds"]
RANKED = ["global_rank", "qcut", "segments", "split", "split_stratified", "corr_spearman", "cv_folds", "preprocess"]


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_python_nodes(spark, name):
    plan = _plan(spark, name)
    assert not [n for n in PYTHON_NODES if n in plan]


def _subtrees(plan: str, marker: str):
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if marker in line:
            indent = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                    break
                sub.append(nxt)
            yield sub


def _single_partition_over_rows(plan: str) -> bool:
    """True if some single-partition exchange reads data rows without an aggregate in between."""
    for sub in _subtrees(plan, "Exchange SinglePartition"):
        first_agg = next((k for k, s in enumerate(sub) if "HashAggregate" in s or "ObjectHashAggregate" in s
                          or "SortAggregate" in s or "LocalTableScan" in s or "LocalRelation" in s), None)
        first_scan = next((k for k, s in enumerate(sub) if "FileScan" in s), None)
        if first_agg is None or (first_scan is not None and first_scan < first_agg):
            return True
    return False


@pytest.mark.parametrize("name", RANKED)
def test_single_partition_only_over_aggregates(spark, name):
    assert not _single_partition_over_rows(_plan(spark, name))


def test_check_catches_a_whole_table_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF}/events.parquet")
    bad = ev.withColumn("rn", F.row_number().over(Window.orderBy("value")))
    assert _single_partition_over_rows(bad._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name,schema", [
    ("mean_std_by_hour", "struct<event_id:bigint,ts:timestamp_ntz,value:double>"),
    ("value_counts", "struct<o_orderstatus:string,o_orderpriority:string>"),
    ("global_rank", "struct<event_id:bigint,value:double>"),
])
def test_scan_reads_only_needed_columns(spark, name, schema):
    plan = _plan(spark, name)
    schemas = {part.split("ReadSchema: ")[1].split()[0] for part in plan.splitlines() if "ReadSchema: " in part}
    assert schemas == {schema}


@pytest.mark.parametrize("name", ["qcut", "split", "cv_folds", "split_stratified"])
def test_position_labels_do_not_shuffle_rows(spark, name):
    """Segments, splits and folds label rows by comparing with boundary rows: the
    final plan is a scan and projections (plus a broadcast of the per-stratum cut table)."""
    plan = _plan(spark, name)
    shuffles = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert not shuffles, shuffles


def test_split_lines_are_labelled_once(spark):
    """No job of a report draws the rows' md5 again, and the parts are those of ``split_labels``."""
    from tabstrata.operators import prepare as P
    from tabstrata.plans import catalog

    train, test = catalog._split_lines(spark, SF)
    for part in (train, test):
        assert "md5" not in part._jdf.queryExecution().optimizedPlan().toString()
    lab = P.split_labels(catalog._lineitem_ml(spark, SF), "row_id", 0.2, 0.0, catalog.SEED)
    for part, name in ((train, "train"), (test, "test")):
        want = lab.where(f"split = '{name}'")
        assert part.count() == want.count() and not part.exceptAll(want).count()


def test_run_computes_its_input_and_split_once(spark):
    """The parts of a run read the stored rows and labels, not the md5 draws that made them."""
    from tabstrata.plans import catalog
    from tabstrata.plans.report import run

    res = run(catalog._posts_na(spark, SF), "target", "post_id", model_types=["linear"])
    assert res["comparison"].count() == 1
    for part in (res["comparison"], *res["eda"].values()):
        assert "md5" not in part._jdf.queryExecution().optimizedPlan().toString()


def test_bundles_hold_what_their_parts_compute(spark):
    import json

    from tabstrata.operators import metrics as M
    from tabstrata.operators import models as MD
    from tabstrata.plans import catalog as C

    train, test = C._split_lines(spark, SF)
    pred = MD.predict(MD.train(train, C.LINE_FEATS, "l_extendedprice", "linear"), test)
    want = M.regression_metrics(pred, "l_extendedprice", "prediction").first()
    got = {r.part: r for r in C.evaluation_report(spark, SF).collect()}
    one, = json.loads(got["metrics"].rows)
    assert all(one[k] == pytest.approx(want[k]) for k in ("mse", "rmse", "mae", "r2", "mape"))
    assert all(len(json.loads(r.rows)) == r.n_rows > 0 for r in got.values())
    assert sum(x["count"] for x in json.loads(got["segments"].rows)) == sum(x["count"] for x in json.loads(got["residual_bins"].rows)) == test.count()
