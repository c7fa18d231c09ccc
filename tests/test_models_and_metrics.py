"""Losses, metrics, preparation, neighbours, rebalancing, clustering and forests against small brute force."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lotwise.functions.losses import focal_loss
from lotwise.operators import balance, boosting, clean, dbscan, features, metrics, ml, neighbors, running
from lotwise.plans import learning, prepare
from lotwise.spec import FeatureSpec, FocalParams


def _mean_loss(spark, rows, **kw):
    df = spark.createDataFrame(rows, "y int, p double")
    return df.agg(F.avg(focal_loss(F.col("y"), F.col("p"), FocalParams(**kw)))).first()[0]


def test_focal_loss_behaviour(spark):
    assert 0 < _mean_loss(spark, [(1, 0.9), (0, 0.1), (1, 0.8), (0, 0.2)], alpha=0.5, gamma=0.0) < 1
    easy = [(1, 0.99), (0, 0.01), (1, 0.98), (0, 0.02)]
    assert _mean_loss(spark, easy, gamma=2.0) < _mean_loss(spark, easy, gamma=0.0)
    assert _mean_loss(spark, [(1, 0.999), (0, 0.001)]) < 0.01


def test_average_precision_is_stepwise(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6), (0, 0.5)], "label int, score double").withColumn("split", F.lit("val"))
    m = metrics.ranking_metrics(metrics.precision_recall_curve(df, ["split"]), ["split"]).first()
    assert m["auc_pr"] == pytest.approx(0.833333, abs=1e-6) and m["auc_roc"] == pytest.approx(5 / 6)


def test_one_class_and_published_counts(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.1)], "label int, score double").withColumn("split", F.lit("val"))
    m = metrics.ranking_metrics(metrics.precision_recall_curve(df, ["split"]), ["split"]).first()
    assert (m["auc_pr"], m["auc_roc"]) == (0.0, 0.0)
    r = metrics.rates(spark.createDataFrame([(2278, 22328, 10873, 1964521)], "tp long, fp long, fn long, tn long")).first()
    assert (r["precision"], r["recall"], r["f1"]) == pytest.approx((0.092579, 0.173219, 0.120666), abs=1e-6)


def test_evaluate_by_model_uses_each_models_own_threshold(spark):
    rows = [(m, s, y, p) for m, ps in (("a", (0.9, 0.2)), ("b", (0.5, 0.4))) for s in ("val", "test") for y, p in zip((1, 0), ps)]
    df = spark.createDataFrame(rows, "model string, split string, label int, score double")
    got = {(r["model"], r["split"]): r for r in metrics.evaluate(df, by=["model"]).collect()}
    assert {k: r["threshold"] for k, r in got.items()} == {("a", "val"): 0.9, ("a", "test"): 0.9, ("b", "val"): 0.5, ("b", "test"): 0.5}
    assert all(r["f1"] == 1.0 and r["auc_roc"] == 1.0 for r in got.values())


def test_too_many_bad_scores_fail_the_job(spark):
    df = spark.createDataFrame([("val", 0.1), ("val", float("nan"))], "split string, score double")
    with pytest.raises(Exception, match="non-finite"):
        metrics.require_valid_scores(metrics.guard_scores(df)).collect()


def test_preparation_fits_on_train_only_and_survives_storage(spark, tmp_path):
    spec = FeatureSpec(numeric=("a", "flag"), categorical=("c",), spatial=(), engineered=(), log_scaled=())
    train = spark.createDataFrame([(1.0, 0.0, "x"), (2.0, 0.0, "y"), (3.0, 0.0, "x"), (None, 1.0, None), (2.0, 0.0, "x")], "a double, flag double, c string")
    p = prepare.fit(train, spec)
    assert p.medians["a"] == 2.0 and p.modes["c"] == "x" and "flag" not in p.bounds
    p.to_frame(spark).write.parquet(str(tmp_path / "p"))
    again = prepare.Preparation.from_frame(spark.read.parquet(str(tmp_path / "p")), spec)
    fresh = spark.createDataFrame([(1000.0, 0.0, "new")], "a double, flag double, c string")
    assert p.transform(fresh).collect() == again.transform(fresh).collect()
    assert again.transform(fresh, scale=False).first()["c"] == -1
    constant = features.standardize(spark.createDataFrame([(5.0,), (5.0,)], "k double"), {"k": (5.0, 0.0)})
    assert [r["k"] for r in constant.collect()] == [0.0, 0.0]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert clean.fit_modes(df, ["c"]) == {"c": "a"}


def _knn(rows, donors, k):
    out = []
    for key, *cells in rows:
        filled = list(cells)
        for j, cell in enumerate(cells):
            if cell is not None:
                continue
            near = []
            for d_key, *d in donors:
                both = [(a - b) ** 2 for a, b in zip(cells, d) if a is not None and b is not None]
                if d[j] is not None and both:
                    near.append(((sum(both) * len(cells) / len(both)) ** 0.5, d_key, d[j]))
            near = sorted(near)[:k]
            zero = [v for dist, _, v in near if dist == 0]
            known = [d[1 + j] for d in donors if d[1 + j] is not None]
            filled[j] = sum(zero) / len(zero) if zero else sum(v / x for x, _, v in near) / sum(1 / x for x, _, v in near) if near else sum(known) / len(known) if known else 0.0
        out.append((key, *filled))
    return out


@pytest.mark.parametrize("block,query", [(8000, 512), (7, 3)])
def test_knn_imputation_equals_brute_force(spark, block, query):
    rng = np.random.default_rng(8)
    cells = [[None if rng.random() < 0.25 else float(round(v, 1)) for v in row] for row in rng.normal(size=(60, 3))]
    rows = [(f"k{i:02d}", *c) for i, c in enumerate(cells)] + [("z", None, None, None)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double").repartition(4)
    train = df.where("id < 'k40'")
    got = {r["id"]: (r["a"], r["b"], r["c"]) for r in clean.knn_impute(train, df, ["a", "b", "c"], "id", 3, block, query).collect()}
    for key, *want in _knn(rows, [r for r in rows if r[0] < "k40"], 3):
        assert got[key] == pytest.approx(tuple(want))


def test_gaps_search_only_the_donors_that_can_be_near(spark):
    rng = np.random.default_rng(3)
    cells = [[None if rng.random() < 0.15 else float(v) for v in row] for row in np.round(rng.uniform(0, 100, (1500, 3)), 1)]
    rows = [(f"k{i:04d}", *c) for i, c in enumerate(cells)] + [(None, 1.0, None, 2.0), ("far", None, -900.0, 5.0)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double").repartition(4)
    found = clean.nearest_values(df, df, ["a", "b", "c"], "id", 3, 25, 40).toPandas()
    gaps = [(r[0], j) for r in rows for j in range(3) if r[0] and r[1 + j] is None and any(x is not None for x in r[1:])]
    assert len(found) < 60 * len(gaps)  # 3 from each of 60 blocks and more if all were searched
    best = found.sort_values(["distance", "donor"], na_position="first").groupby(["row_key", "place"]).head(3)
    got = {g: list(zip(t["donor"], t["distance"])) for g, t in best.groupby(["row_key", "place"])}
    values = {r[0]: r[1:] for r in rows}
    assert set(got) == set(gaps)
    for key, j in [*gaps[::9], ("far", 0)]:
        near = []
        for d_key, *d in rows:
            both = [(x - y) ** 2 for x, y in zip(values[key], d) if x is not None and y is not None]
            if d[j] is not None and both:
                near.append(((sum(both) * 3 / len(both)) ** 0.5, d_key or "", d_key))
        want = sorted(near)[:3]
        assert [d or None for d, _ in got[key, j]] == [d for _, _, d in want]
        assert [x for _, x in got[key, j]] == pytest.approx([x for x, _, _ in want])


def test_knn_imputation_has_no_donor_limit(spark):
    df = spark.range(210_000).select("id", (F.col("id") % 1000).cast("double").alias("a"), F.when(F.col("id") % 30_000 != 7, F.col("id") % 1000 * 2.0).alias("b"))
    filled = clean.knn_impute(df, df, ["a", "b"], "id").where("id % 30000 = 7")
    assert filled.rdd.getNumPartitions() >= 1 and [(r["a"], r["b"]) for r in filled.collect()] == [(7.0, 14.0)] * 7


def test_nan_scores_do_not_depend_on_size(spark):
    rows = [(0.1, 0), (0.4, 1), (float("nan"), 1), (None, 0), (0.9, 1), (0.4, 0), (0.7, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    curve = metrics.precision_recall_curve(df, [])
    assert curve.agg(F.max("tp"), F.max("fp")).first()[:] == (2, 3)
    counted = df.groupBy("score").agg(F.count("*").alias("n"))
    small = running.running_totals(counted, "score", {"upto": "n"})
    large = running.running_totals(counted, "score", {"upto": "n"}, rows_per_bucket=2)
    key = lambda r: (str(r["score"]), r["upto"])
    assert sorted(map(key, small.collect())) == sorted(map(key, large.collect()))


def test_undersampling_asks_no_size(spark):
    df = spark.range(100).withColumn("y", (F.col("id") < 4).cast("int"))
    assert balance.undersample(df, "y", ["id"]).groupBy("y").count().orderBy("y").collect() == [(0, 40), (1, 4)]


@pytest.mark.parametrize("pivots,block", [(1, 8000), (7, 8000), (5, 20)])
def test_nearest_equals_brute_force(spark, pivots, block):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(150, 3)), np.zeros((80, 3)), rng.normal(4, 0.2, (50, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in neighbors.nearest(df, df, "id", "v", 4, exclude_self=True, pivots=pivots, block_rows=block).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["donor_id"]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(len(x)):
        order = [j for j in sorted(range(len(x)), key=lambda j: (d[i, j], j)) if j != i][:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == order


def test_smote_reaches_the_ratio_on_segments(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=2).tolist(), 0) for i in range(200)] + [(1000 + i, rng.normal(5, 1, 2).tolist(), 1) for i in range(11)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    out = balance.smote(df, "v", "y", "id", ratio=0.3, k=3)
    assert out.where("y = 1").count() == 60 and out.where("NOT synthetic").count() == 211
    real = np.array([r[1] for r in rows if r[2] == 1])
    made = np.array([r["v"] for r in out.where("synthetic").collect()])
    assert (made >= real.min(0) - 1e-9).all() and (made <= real.max(0) + 1e-9).all()


def test_stratified_split_shares(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    got = {(r["y"], r["split"]): r["count"] for r in balance.stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert got[1, "train"] == 60 and got[0, "val"] == 135 and got[1, "unseen"] == 10


@pytest.mark.parametrize("limit", [4096, 4])
def test_density_clusters_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(dbscan, "PAIR_LIMIT", limit)
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 0.3, (60, 2)), rng.normal(3, 0.3, (60, 2)), rng.uniform(-2, 5, (30, 2)), np.zeros((40, 2))])
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= 0.4
    core = near.sum(1) >= 6
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min(label[near[i] & core]) if core[i] else label[i] for i in range(len(x))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    for r in dbscan.dbscan(df, "id", "v", 0.4, 6, 2).collect():
        reach = near[r["id"]] & core
        assert r["is_core"] == core[r["id"]]
        assert r["cluster"] == (min(label[reach]) if reach.any() else None)


def test_isolation_forest_finds_the_far_points(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, v)) for i, v in enumerate(np.vstack([rng.normal(size=(490, 2)), rng.normal(12, 1, (10, 2))]))]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    found = ml.isolation_forest(df, ["a", "b"], ["id"], trees=20, sample=64).where("is_outlier").collect()
    assert len(found) == 10 and all(r["id"] >= 490 for r in found)


@pytest.mark.parametrize("name", ["ml02_boosted_trees", "ml03_boosted_trees_wide", "ml04_top_importances", "ml05_stored_model_scores", "ml03_leaf_wise_scores"])
def test_boosted_queries_ask_for_the_whole_model(spark, monkeypatch, name):
    """The defaults of the operator, stopped by the validation rows; every row not trained on is scored."""
    asked, fit = [], boosting.fit

    def small(*args):
        asked.append(args)
        return fit(*args[:5], replace(args[5], trees=2, depth=2))

    monkeypatch.setattr(boosting, "fit", small)
    got = entry_points.queries()[name](spark, "/root/testdata/sf0.001")
    p = asked[0][5]
    assert p.trees == 300 and p.depth == 6 and p.patience == 20 and asked[0][4] is not None
    assert p.growth == ("leaf" if name.startswith("ml03") else "level")
    unseen = learning._rows(spark, "/root/testdata/sf0.001").where("split <> 'train'").count()
    if name == "ml04_top_importances":
        assert got.count() == len(learning.COLS)
    else:
        assert unseen == (got.agg({"n": "sum"}).first()[0] if "n" in got.columns else got.count())
