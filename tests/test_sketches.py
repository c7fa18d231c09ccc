"""Stored sketches and moving references, and the one-pass test against a normal curve."""

import math

import numpy as np
import pytest
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.functions.columns import normal_cdf
from lotwise.operators import drift, sketches
from lotwise.session import settings


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(8)
    rows = [(d, float(rng.normal(0.1 * max(0, d - 6), 1)), float(rng.integers(0, 4)) if i % 9 else None) for d in range(1, 13) for i in range(3000)]
    return spark.createDataFrame(rows, "day_number int, a double, b double").cache()


def test_only_new_days_are_read_and_days_can_be_replaced(spark, days, tmp_path):
    path = str(tmp_path / "t")
    assert sketches.update(days.where("day_number <= 5"), path, ["a", "b"]) == [1, 2, 3, 4, 5]
    before = {(r.day_number, r.feature): bytes(r.sketch) for r in sketches.read(spark, path).collect()}
    assert sketches.update(days, path, ["a", "b"]) == [6, 7, 8, 9, 10, 11, 12]
    assert sketches.update(days, path, ["a", "b"]) == []
    after = {(r.day_number, r.feature): bytes(r.sketch) for r in sketches.read(spark, path).collect()}
    assert len(after) == 24 and all(after[k] == v for k, v in before.items())
    assert sketches.update(days.where("day_number = 3 AND a > 0"), path, ["a", "b"], again=[3]) == [3]
    again = sketches.read(spark, path).where("day_number = 3 AND feature = 'a'").first()
    assert again.low > 0 and again.n == days.where("day_number = 3 AND a > 0").count()


def test_windows_equal_their_rows(spark, days):
    moving = {(r.day_number, r.feature): r for r in sketches.sliding(sketches.day_sketches(days, ["a", "b"]), 4).collect()}
    assert set(moving) == {(d, f) for d in range(2, 13) for f in "ab"}  # the first day has nothing before it
    for d in (2, 4, 12):
        rows = days.where(F.col("day_number").between(d - 4, d - 1)).toPandas()
        for f in "ab":
            x, r = rows[f].dropna(), moving[d, f]
            assert (r.n, r.low, r.high) == (len(x), x.min(), x.max())
            assert (r.mean, r.std) == pytest.approx((x.mean(), x.std(ddof=0)))


def test_quantiles_stay_within_the_rank_error(spark, days):
    moving = sketches.sliding(sketches.day_sketches(days, ["a", "b"]), 4)
    found = sketches.rank_check(days, moving, [0.1, 0.5, 0.9], 4, 0.01).collect()
    assert len(found) == 66 and all(r.within for r in found)
    wrong = moving.withColumn("sketch", F.first("sketch").over(Window.partitionBy("feature").orderBy("day_number")))
    assert not all(r.within for r in sketches.rank_check(days, wrong, [0.1, 0.5, 0.9], 4, 0.01).collect())


def test_sketched_references_report_as_exact_ones(spark, days):
    stored = sketches.day_sketches(days, ["a", "b"])
    ref, exact = sketches.fixed_reference(stored, 1, 6), drift.fit_reference(days.where("day_number <= 6"), ["a", "b"])
    assert ref.names == exact.names and [f.n for f in ref.features] == [f.n for f in exact.features]
    a, b = ref.features[0], exact.features[0]
    assert a.mean == pytest.approx(b.mean) and a.edges == pytest.approx(b.edges, abs=0.03) and a.proportions == pytest.approx(b.proportions, abs=0.01)
    psi = {(r.day_number, r.feature): r.psi for r in drift.psi_report(days, exact, ["day_number"]).collect()}
    for r in drift.psi_report(days, ref, ["day_number"]).collect():
        assert r.psi == pytest.approx(psi[r.day_number, r.feature], abs=0.02, rel=0.08)
    for r in sketches.sliding_psi(stored, 6).where("day_number = 7").collect():
        assert r.psi == pytest.approx(psi[7, r.feature], abs=0.02)
        assert r.n_reference == ref.features["ab".index(r.feature)].n
    late = {r.day_number: r.psi for r in sketches.sliding_psi(stored, 3).where("feature = 'a'").collect()}
    assert max(late[d] for d in range(4, 7)) < 0.02 < late[12]


def test_normal_curve(spark):
    z = [x / 8 for x in range(-80, 81)] + [-40.0, 40.0, 7.1, -7.05]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(normal_cdf(F.col("z"))).collect()]
    assert got == pytest.approx([0.5 * math.erfc(-v / math.sqrt(2)) for v in z], rel=1e-7, abs=1e-14)


def test_every_day_and_feature_equals_the_single_test(spark, days):
    ref = drift.fit_reference(days.where("day_number <= 6"), ["a", "b"])
    found = {(r.day_number, r.feature): r for r in drift.ks_normal(days, ref, ["day_number"]).collect()}
    assert len(found) == 24
    for d, f in ((1, "a"), (12, "a"), (5, "b")):
        at = ref.features["ab".index(f)]
        values = days.where((F.col("day_number") == d) & F.col(f).isNotNull()).select(F.col(f).alias("v"))
        want = KolmogorovSmirnovTest.test(values, "v", "norm", at.mean, at.std).first()
        assert found[d, f].ks_statistic == pytest.approx(want.statistic, abs=1e-9)
        assert found[d, f].ks_pvalue == pytest.approx(want.pValue, abs=0.01)
    whole = drift.ks_normal(days, ref).collect()
    assert {r.feature: r.n for r in whole} == {"a": 36000, "b": days.where("b is not null").count()}


def test_rank_check_counts_rows_where_they_are_read(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sketches.update(days, path, ["a", "b"])
    window = sketches.sliding(sketches.read(spark, path), 3).where("day_number > 3")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = sketches.rank_check(days, window, [0.5], 3, 0.01)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "rightHint=(strategy=broadcast)" in plan
        rows = found.collect()
    assert len(rows) == 18 and all(r.within for r in rows)
