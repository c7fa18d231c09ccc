"""Queries that take every day, against their SQL and for the days they hold."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,days", [("lc06_champion_history", 40), ("lc06_champion_at_day", 40), ("lc13_version_steps", None)])
def test_registry_of_all_days(spark, name, days):
    r = compare(spark, connect(SF), SF, name, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert r["status"].startswith("match") and r["rows"] > 0, r
    assert entry_points.oracle_sql()[f"{name}_daily"] == entry_points.oracle_sql()[name]
    got = {x.day_number for x in entry_points.queries()[name](spark, SF).collect()}
    assert days is None or len(got) == days
    assert any(day % 3 for day in got)


def test_distances_of_all_days_after_the_reference(spark):
    name = "dr04_ks_two_sample_all_days"
    r = compare(spark, connect(SF), SF, name, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert r["status"].startswith("match") and r["rows"] == 9, r
    got = entry_points.queries()["dr04_ks_against_stored_normal"](spark, SF).collect()
    assert {x.day_number for x in got} == set(range(9, 41)) and len({x.feature for x in got}) == 9
    assert all(0 < x.ks_statistic <= 1 and 0 <= x.ks_pvalue <= 1 for x in got)
