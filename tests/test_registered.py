"""Registered queries against their SQL counterparts on the smallest tables (all of them with LOTWISE_ALL=1)."""

import os

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
FAST = (
    "ag01_daily_fail_rate ag05_daily_feature_stats ag15_missing_patterns pf06_fixed_size_sample pf08_stratified_split fe07_winsorize "
    "fe09_engineer_log fe11_encode dr01_quantile_psi dr02_width_psi dr04_ks_two_sample lc02_staleness_gate lc06_champion_at_day "
    "me07_evaluate_at_val_threshold st07_request_rate_streamed st12_gate_per_tester st12_streamed_gate io11_batch_labels io13_report_files fe04_knn_impute "
    "fe14_smote so05_row_concatenation ml08_dbscan_parts ml11_iqr_outliers fe18_fit_and_transform"
).split()
# All of them: without the training-data operators, which have tests of their own.
NAMES = sorted(n for n in entry_points.queries() if n != "pipeline" and not n.startswith("op")) if os.environ.get("LOTWISE_ALL") else FAST


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    r = compare(spark, connect(SF), SF, name, entry_points.queries()[name], entry_points.oracle_sql().get(name))
    assert r["rows"] > 0 and r["status"].startswith("match" if name in entry_points.oracle_sql() else "rows-only"), r


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 40
