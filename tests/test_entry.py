"""Driver contract: entry smoke, every query has a name, oracle keys are registered."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["hour", "count", "mean", "std", "lower", "upper"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_reserved_names():
    for name in E.catalog.QUERIES:
        assert name != "pipeline" and not name.startswith("op")
