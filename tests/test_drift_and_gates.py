"""Drift, gates and lifecycle: published behaviour, golden replay and hand-made traps."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import drift, lifecycle, running
from lotwise.spec import DriftThresholds, RetrainPolicy

# Critical and warning counts of days 9 to 40 of the published run.
CRITICAL = [2, 0, 0, 0, 0, 1, 1, 1, 3, 3, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5, 5, 5, 5, 4, 4, 4, 4, 4, 4, 5, 5, 5]
WARNING = [0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 1, 2, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0]


def _normal(spark, n, shift=0.0, seed=0):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([tuple(float(v) for v in r) for r in rng.normal(shift, 1, (n, 3))], "a double, b double, c double").withColumn("day_number", F.lit(1))


@pytest.mark.parametrize("kind", [drift.QUANTILE, drift.WIDTH])
def test_same_distribution_is_quiet_and_a_shift_is_not(spark, kind):
    ref = drift.fit_reference(_normal(spark, 4000), ["a", "b", "c"], kind)
    report = drift.psi_report if kind == drift.QUANTILE else drift.divergence_report
    level = "severity" if kind == drift.QUANTILE else "status"
    for shift, expected in ((0.0, 0), (3.0, 3)):
        s = drift.drift_summary(report(_normal(spark, 3000, shift, 1), ref, ["day_number"]), ["day_number"], 3, level=level).first()
        assert s["features_critical"] == expected and s["should_retrain"] == (expected >= 3)


def test_psi_against_numpy_and_identity(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=900), rng.normal(0.3, 1.2, 700)
    frame = lambda x: spark.createDataFrame([(float(v),) for v in x], "x double").withColumn("day_number", F.lit(1))
    ref = drift.fit_reference(frame(a), ["x"])
    edges = np.percentile(a, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    p, q = (np.histogram(v, edges)[0] / len(v) + 1e-6 for v in (a, b))
    assert drift.psi_report(frame(b), ref, ["day_number"]).first()["psi"] == pytest.approx(np.sum((q - p) * np.log(q / p)), rel=1e-9)
    assert drift.psi_report(frame(a).repartition(5), ref, ["day_number"]).first()["psi"] == pytest.approx(0.0, abs=1e-12)


def test_repeated_edges(spark):
    values = [0.0, 0.0, 0.0, 0.0, 1.0]
    ref = drift.fit_reference(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], bins=4)
    edges = np.percentile(values, [0, 25, 50, 75, 100])
    edges[0], edges[-1] = -np.inf, np.inf
    assert list(edges[1:-1]) == list(ref.features[0].edges) == [0.0, 0.0, 0.0]
    assert [round(5 * p) for p in ref.features[0].proportions] == list(np.histogram(values, edges)[0]) == [0, 0, 0, 5]


def test_nothing_in_range_is_critical(spark):
    ref = drift.fit_reference(spark.createDataFrame([(float(i) / 10,) for i in range(11)], "x double"), ["x"], drift.WIDTH)
    r = drift.divergence_report(spark.createDataFrame([(9.0, 1), (9.0, 1)], "x double, day_number int"), ref, ["day_number"]).first()
    assert r["status"] == "critical" and r["n_out_of_range"] == 2


def test_reference_round_trip(spark, tmp_path):
    ref = drift.fit_reference(_normal(spark, 500), ["a", "b"], drift.WIDTH)
    ref.to_frame(spark).write.parquet(str(tmp_path / "ref"))
    again = drift.DriftReference.from_frame(spark.read.parquet(str(tmp_path / "ref")))
    assert again.features == ref.features


def test_two_sample_statistic(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(size=400), 1), np.round(rng.normal(0.4, 1, 300), 1)
    make = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double")
    r = drift.ks_two_sample(make(a), make(b), ["x"]).first()
    grid = np.unique(np.concatenate([a, b]))
    d = np.abs(np.searchsorted(np.sort(a), grid, "right") / 400 - np.searchsorted(np.sort(b), grid, "right") / 300).max()
    assert r["ks_statistic"] == pytest.approx(d) and 0 <= r["ks_pvalue"] < 0.01


def test_low_data_never_recommends(spark):
    ref = drift.fit_reference(_normal(spark, 500), ["a", "b", "c"])
    r = drift.light_check(_normal(spark, 400, 3.0), ref, t=DriftThresholds(min_reliable_rows=10_000)).first()
    assert r["features_critical"] == 3 and not r["should_retrain"] and not r["drift_reliable"] and r["low_data_warning"]


def test_features_with_few_values_are_reported(spark):
    ref = drift.fit_reference(_normal(spark, 500), ["a", "b", "c"])
    r = drift.light_check(_normal(spark, 40, 3.0), ref, t=DriftThresholds(min_reliable_rows=10)).first()
    assert (r["features_insufficient"], r["features_critical"], r["should_retrain"]) == (3, 0, False)


def _replay(spark):
    rows = [(d, c, w, True) for d, c, w in zip(range(9, 41), CRITICAL, WARNING)]
    return spark.createDataFrame(rows, "day_number int, features_critical int, features_warning int, drift_reliable boolean")


def test_published_run_retrains_once_on_day_30(spark):
    days = _replay(spark)
    gate = lifecycle.staleness_gate(days)
    assert [r["day_number"] for r in gate.where("retrain").collect()] == [30]
    tags = {r["day_number"]: r["events"] for r in lifecycle.day_event_tags(gate.join(days.select("day_number", "features_warning"), "day_number")).collect()}
    assert tags[9] == ["drift_clean"] and tags[13] == ["drift_warning_1_features"]
    assert tags[30] == ["drift_critical_5_features", "RETRAIN_TRIGGERED"]
    assert tags[39] == ["drift_critical_5_features", "retrain_blocked_staleness_9d", "BAD_MODEL_DEPLOYED", "CANARY_FAILED", "ROLLBACK_TO_v2"]


def test_failed_training_does_not_move_the_clock(spark):
    days = _replay(spark).withColumn("trained", F.col("day_number") != 30)
    gate = lifecycle.staleness_gate(days, trained="trained")
    assert [(r["day_number"], r["retrain_succeeded"]) for r in gate.where("retrain").orderBy("day_number").collect()] == [(30, False), (31, True)]


def test_three_criteria(spark):
    today = datetime.date(2026, 4, 1)
    rows = [
        ("few", 1, -0.03, datetime.date(2026, 1, 1), today), ("met", 5, -0.03, datetime.date(2026, 1, 1), today),
        ("fresh", 5, -0.03, datetime.date(2026, 3, 25), today), ("unknown", 5, None, None, today),
    ]
    df = spark.createDataFrame(rows, "k string, features_critical int, current_aucpr double, last_retrain_date date, report_date date")
    got = {r["k"]: r for r in lifecycle.three_criteria_gate(df, RetrainPolicy()).collect()}
    assert {k: r["should_retrain"] for k, r in got.items()} == {"few": False, "met": True, "fresh": False, "unknown": True}
    assert got["fresh"]["reasoning"] == "HOLD (drift=YES, performance=YES, staleness=NO)"


def test_early_stop_and_window(spark):
    values = [0.1, 0.3, 0.3] + [0.2] * 11 + [0.9]
    df = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(values)], "run string, epoch int, val_auc_pr double")
    r = lifecycle.best_epoch(df, ["run"]).first()
    assert (r["best_epoch"], r["best_value"], r["stop_epoch"]) == (2, 0.3, 14)
    w = lifecycle.training_windows(spark.createDataFrame([(5,), (30,)], "day_number int")).orderBy("retrain_day").collect()
    assert [(x["start_day"], x["end_day"]) for x in w] == [(1, 5), (16, 30)]


def test_grouped_ks_reads_each_side_once(spark, monkeypatch):
    """Against the empirical distributions, with ties, infinities, features that a side lacks and ranges without reference values."""
    rng = np.random.default_rng(4)
    sides = {}
    for side, n in (("ref", 300), ("cur", 400)):
        x = np.round(rng.normal(size=(n, 4)) + (side == "cur") * 0.3, 1)
        x[rng.random(x.shape) < 0.1] = np.nan
        x[:3, 0] = np.inf, -np.inf, 0.0
        x[:, 2 if side == "ref" else 3] = np.nan
        x[:, 1] += 9 * (side == "cur") * (rng.random(n) < 0.5)
        sides[side] = [(int(i % 3) if i % 7 else None, *[None if math.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)]
    reference, current = (spark.createDataFrame(sides[s], "day int, a double, b double, c double, d double") for s in ("ref", "cur"))
    want = {}
    for day in (0, 1, 2, None):
        for i, f in enumerate("abcd", 1):
            r, c = (np.sort([x[i] for x in sides[s] if x[i] is not None and (s == "ref" or x[0] == day)]) for s in ("ref", "cur"))
            if len(r) and len(c):
                at = np.concatenate([r, c])
                want[day, f] = len(r), len(c), float(np.abs(np.searchsorted(r, at, "right") / len(r) - np.searchsorted(c, at, "right") / len(c)).max())
    for most in (500_000, 20):
        monkeypatch.setattr(running.cut_into_ranges, "__defaults__", (most,))
        out = drift.ks_by_group(reference, current, list("abcd"), ["day"])
        got = {(x.day, x.feature): (x.n_reference, x.n_current, x.ks_statistic) for x in out.collect()}
        assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
        assert all(got[k][2] == pytest.approx(want[k][2]) for k in want)
        assert "ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()  # the counts alone are read
