"""Quantiles, running totals, ranks and profiles on hand-made rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lotwise.functions.columns import clip, right_closed_bin, stable_key, width_bin
from lotwise.operators import features, neighbors, profile, quantiles, running
from lotwise.session import settings


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    hot = [("hot", 7.0)] * 700  # one value of one group holds a third of all rows
    rest = [("hot", float(x)) for x in rng.normal(0, 50, 700)] + [("cold", float(x)) for x in rng.lognormal(0, 3, 700)]
    gaps = [("cold", None), ("hot", float("nan")), ("hot", 1e300), ("hot", -1e300)]
    return spark.createDataFrame(hot + rest + gaps, "g string, x double")


@pytest.mark.parametrize("limit", [10_000, 100, 5])
def test_quantiles_do_not_depend_on_the_path(skewed, limit):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in quantiles.exact_quantiles(skewed, ["x"], probs, ["g"], group_limit=limit).collect()}
    for g in ("hot", "cold"):
        values = [r["x"] for r in skewed.where(F.col("g") == g).collect() if r["x"] is not None and r["x"] == r["x"]]
        assert got[g]["n"] == len(values)
        assert got[g]["q"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-9)


def test_quantile_of_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in [-inf, 1.0, 2.0, 3.0, inf]], "x double")
    q = quantiles.quantile_table(df, ["x"], [0.25, 0.5, 0.75], group_limit=1)["x"]
    assert q == [1.0, 2.0, 3.0]


def test_hand_made_percentiles_and_skew(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 3, 10)], "x double")
    assert quantiles.quantile_table(df, ["x"], [0.1, 0.25, 0.9])["x"] == pytest.approx([1.4, 2.0, 7.2])
    m = profile.feature_moments(df, ["x"]).first()
    assert m["skew"] == pytest.approx(2.0286991, abs=1e-6)
    assert (m["std_samp"], m["std_pop"]) == pytest.approx((3.6469165, 3.2619013))


@pytest.mark.parametrize("per_bucket", [1_000_000, 20])
def test_running_totals(spark, per_bucket):
    rng = np.random.default_rng(1)
    rows = [(k, float(v), int(n)) for k in ("a", "b") for v, n in zip(np.unique(rng.normal(size=300)), rng.integers(1, 9, 300))]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = {(r["k"], r["v"]): r["c"] for r in running.running_totals(df, "v", {"c": "n"}, ["k"], per_bucket).collect()}
    for k in ("a", "b"):
        total = 0
        for _, v, n in sorted(r for r in rows if r[0] == k):
            total += n
            assert got[k, v] == total


def test_hash_rank_and_exact_sample(spark):
    df = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, "rare").otherwise("hot"))
    ranks = running.hash_ranked(df, stable_key(["id"]), ["k"])
    for row in ranks.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m")).collect():
        assert row["n"] == row["d"] == row["m"]
    one = {r[0] for r in running.sample_exact(df, 777, ["id"]).select("id").collect()}
    two = {r[0] for r in running.sample_exact(df.repartition(7), 777, ["id"]).select("id").collect()}
    assert len(one) == 777 and one == two


def test_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.05, 1.0)], "x double")
    assert [r[0] for r in df.select(right_closed_bin(F.col("x"), 0.0, 1.0, 20)).collect()] == [None, 1, 20]
    edges = np.linspace(0.1, 0.7, 21)
    values = [float(e) for e in edges] + [0.05, 0.71]
    w = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in w.select(width_bin(F.col("x"), F.lit(0.1), F.lit(0.7), 20)).collect()]
    assert got[-2:] == [None, None] and got[0] == 0 and got[20] == 19
    assert np.abs(np.array(got[1:20]) - np.arange(1, 20)).max() <= 1


def test_null_survives_clip(spark):
    assert spark.range(1).select(clip(F.lit(None).cast("double"), 0.001)).first()[0] is None


def test_patterns_and_stage_rates(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (1, 2)], "a int, b int")
    assert {r["pattern"]: r["n"] for r in profile.missing_patterns(df, ["a", "b"]).collect()} == {"10": 1, "11": 1, "00": 1}
    stages = spark.createDataFrame([("x", 100, 2.0), ("y", 50, 0.0)], "stage string, n_rows long, seconds double")
    assert {r["stage"]: r["rows_per_sec"] for r in profile.stage_rates(stages).collect()} == {"x": 50.0, "y": 0.0}


def test_density_does_not_depend_on_the_number_of_groups(spark, monkeypatch):
    rows = [(1, "a", 1.0, 2.0), (1, "a", 3.0, None), (None, "b", 5.0, float("nan")), (2, None, 7.0, 7.0), (2, None, 7.0, 9.0)]
    df = spark.createDataFrame(rows, "k int, t string, x double, y double")
    key = lambda r: str(tuple(r))
    literal = sorted(map(key, profile.density_histogram(df, ["x", "y"], ["k", "t"], 4).collect()))
    monkeypatch.setattr(profile, "GROUPS_IN_PLAN", 0)
    assert literal == sorted(map(key, profile.density_histogram(df, ["x", "y"], ["k", "t"], 4).collect())) and len(literal) == 7


@pytest.mark.parametrize("sorted_rows", [50_000, 40, 1])
def test_samples_are_cut_digit_by_digit(spark, sorted_rows):
    df = spark.range(20_000).withColumn("part", F.col("id") % 5)
    ordered = [r[0] for r in df.orderBy(stable_key(["id"], 42)).select("id").collect()]
    for n in (0, 1, 6000, 19_999):
        assert {r[0] for r in running.sample_exact(df, n, ["id"], sorted_rows=sorted_rows).select("id").collect()} == set(ordered[:n])
    assert running.sample_exact(df, 20_000, ["id"], sorted_rows=sorted_rows).count() == 20_000
    assert running.sample_exact(df, 30_000, ["id"]).columns == df.columns
    assert running.sample_exact(df, 4001, ["part"], sorted_rows=sorted_rows).count() == 4001  # five keys for all rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_groups_are_ranked_without_bringing_a_column_to_one_task(spark):
    rows = [(float(i % 997) * 1.5, None if i % 7 == 0 else float(i * i % 1009)) for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = quantiles.exact_quantiles(df, ["a", "b"], [0.25, 0.5], group_limit=100)
        assert "SortMergeJoin" not in _plan(found)
        got = {r["feature"]: list(r["q"]) for r in found.collect()}
    for i, c in enumerate("ab"):
        values = np.array([r[i] for r in rows if r[i] is not None])
        assert np.allclose(got[c], np.quantile(values, [0.25, 0.5]))


def test_buckets_are_narrowed_until_few_values_are_sorted(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") + F.when(F.col("id") == 3999, 1e6).otherwise(0.0)).alias("a"))  # one far value: all others in few buckets
    sorted_rows, ranked = [], quantiles._ranked
    monkeypatch.setattr(quantiles, "RANKED_LIMIT", 50)
    monkeypatch.setattr(quantiles, "_ranked", lambda inside, keys: (sorted_rows.extend(r["count"] for r in inside.groupBy(*keys, "lo").count().collect()), ranked(inside, keys))[1])
    found = quantiles.quantile_table(df, ["a"], [0.25, 0.5], group_limit=3999)["a"]
    assert found == pytest.approx([999.75, 1999.5]) and max(sorted_rows, default=0) <= 50


def test_small_dictionaries_do_not_move_the_encoded_rows(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3), ("z", 4)], "name string, id int")
    codes = features.category_codes(df.where("id < 4"), ["name"])
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = features.encode(df, codes, ["name"])
        assert "SortMergeJoin" not in _plan(found)
        assert {r["id"]: r["name"] for r in found.collect()} == {1: 0, 2: 1, 3: -1, 4: -1}


def test_visits_leave_a_task_in_bounded_parts():
    centres = np.zeros((300, 2))
    rings = [Row(cell=i, radius=1.0, reach=2.0) for i in range(300)]
    batch = pd.DataFrame({"vid": [str(i) for i in range(100)], "v": [[0.1, 0.2]] * 100})
    parts = list(neighbors._cells_to_visit(centres, rings)(iter([batch])))
    assert sum(map(len, parts)) == 300 * 100 and max(map(len, parts)) <= neighbors.SENT_ROWS
    placed = list(neighbors._to_nearest_cell(centres)(iter([pd.concat([batch] * 30)])))
    assert sum(map(len, placed)) == 3000 and max(map(len, placed)) <= neighbors.MEASURED_ROWS
