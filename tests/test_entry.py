import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)
import __spark_entry__ as E  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) >= {"Rank", "model", "WMAPE", "MAPE", "SMAPE", "MAE", "RMSE", "R2"}
    assert len(rows) >= 1


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 60


def test_oracle_parity_small(spark):
    """Spark vs DuckDB, exact after rounding, on the smallest tables."""
    from oracle_check import compare, duck
    con = duck("/root/testdata/sf0.001")
    qs, sqls = E.queries(), E.oracle_sql()
    failures = {}
    for name in ("load_panel", "engineer_features_split", "all_metrics", "validate_panel",
                 "ewma_features", "store_size_bins", "holiday_distance", "seasonal_ar_forecast",
                 "residual_histogram", "wmape_store_model", "ensemble_weights"):
        msgs, _, _ = compare(spark, con, name, qs[name], sqls[name], "/root/testdata/sf0.001")
        if msgs:
            failures[name] = msgs
    assert not failures, failures
