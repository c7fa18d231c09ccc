"""Histogram boosting against a plain implementation, its stop rule, stored models and missing values."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.functions import losses as columns
from lotwise.operators import boosting as B
from lotwise.operators import quantiles


def rows_of(n=400, seed=1, features=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 2)
    x[rng.random((n, features)) < 0.1] = np.nan
    chance = 1 / (1 + np.exp(-(2 * np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1], nan=1.0) - 1.5)))
    return x, (rng.random(n) < chance).astype(int)


def frame(spark, x, y, **more):
    rows = [(i, int(y[i]), *[None if math.isnan(v) else float(v) for v in x[i]], *[c[i] for c in more.values()]) for i in range(len(y))]
    kinds = "".join(f", {k} boolean" for k in more)
    return spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"f{i} double" for i in range(x.shape[1])) + kinds)


def plain_trees(x, y, p, trees):
    """The same algorithm on a list of rows: every cut of every feature is tried by summing rows."""
    edges = [np.unique(np.quantile(c[~np.isnan(c)], [i / p.bins for i in range(1, p.bins)])) for c in x.T]
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0) if p.balanced else np.ones(len(y))
    margin = np.full(len(y), math.log((weight * y).sum() / (weight * (1 - y)).sum()) if p.loss == "log" else 0.0)
    out = []

    def score(rows, g, h):
        shrunk = np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - p.l1, 0)
        return shrunk ** 2 / (h[rows].sum() + p.l2), -p.step * shrunk / (h[rows].sum() + p.l2)

    def split(rows, g, h, depth):
        best = None
        if depth < p.depth:
            for f in range(x.shape[1]):
                for cut in edges[f]:
                    for side in (False, True):
                        gone = np.isnan(x[rows, f])
                        if side and not gone.any():
                            continue
                        left = np.where(gone, side, x[rows, f] < cut)
                        a, b = rows[left], rows[~left]
                        if min(len(a), len(b)) < max(p.min_rows, 1) or min(h[a].sum(), h[b].sum()) < p.min_weight:
                            continue
                        gain = score(a, g, h)[0] + score(b, g, h)[0] - score(rows, g, h)[0]
                        if gain > 1e-9 and (best is None or gain > best["gain"] + 1e-9):
                            best = {"gain": gain, "f": f, "cut": cut, "side": side, "a": a, "b": b}
        node = {"rows": rows, "value": score(rows, g, h)[1], "best": best}
        if best:
            node["below"], node["above"] = split(best["a"], g, h, depth + 1), split(best["b"], g, h, depth + 1)
        return node

    def cut_back(node):
        if node["best"]:
            cut_back(node["below"]), cut_back(node["above"])
            if not node["below"]["best"] and not node["above"]["best"] and node["best"]["gain"] < p.min_gain:
                node["best"] = None

    def best_first(root):
        opened, kept, leaves = [root], set(), 1
        while leaves < p.max_leaves:
            opened = [n for n in opened if n["best"] and n["best"]["gain"] >= p.min_gain]
            if not opened:
                break
            top = max(opened, key=lambda n: n["best"]["gain"])
            opened = [n for n in opened if n is not top]
            kept.add(id(top))
            leaves += 1
            opened += [top["below"], top["above"]]

        def close(n):
            if n["best"] and id(n) not in kept:
                n["best"] = None
            if n["best"]:
                close(n["below"]), close(n["above"])

        close(root)

    for _ in range(trees):
        g, h = B.derivatives(y.astype(float), margin, p)
        g, h = g * weight, h * weight
        root = split(np.arange(len(y)), g, h, 0)
        (cut_back if p.growth == "level" else best_first)(root)
        leaves = []

        def walk(n):
            if n["best"]:
                walk(n["below"]), walk(n["above"])
            else:
                leaves.append((len(n["rows"]), round(n["value"], 5)))
                margin[n["rows"]] += n["value"]

        walk(root)
        out.append(sorted(leaves))
    return margin, out


CASES = {
    "level": B.BoostParams(bins=16, rows=1.0, features=1.0, depth=3, min_weight=2.0),
    "leaf": B.BoostParams(bins=16, rows=1.0, features=1.0, depth=4, growth="leaf", max_leaves=5, min_weight=1e-3, min_rows=10, min_gain=0.0),
    "focal": B.BoostParams(bins=8, rows=1.0, features=1.0, depth=3, loss="focal", balanced=False, min_weight=0.5, l1=0.0, min_gain=0.0),
}


@pytest.mark.parametrize("case", CASES)
def test_trees_equal_plain_boosting(spark, case):
    p, (x, y) = CASES[case], rows_of()
    model = B.fit(frame(spark, x, y).repartition(3), ["f0", "f1", "f2"], "y", ["id"], p=B.BoostParams(**{**p.__dict__, "trees": 3}))
    margin, leaves = plain_trees(x, y, p, 3)
    assert [sorted((int(n), round(v, 5)) for f, n, v in zip(t.feature, t.n, t.value) if f == B.LEAF) for t in model.trees] == leaves
    assert model.margins(x) == pytest.approx(margin, abs=1e-4)


def test_leaf_wise_differs_from_level_wise(spark):
    x, y = rows_of()
    df = frame(spark, x, y)
    level = B.fit(df, ["f0", "f1", "f2"], "y", ["id"], p=B.BoostParams(trees=1, bins=16, depth=4, rows=1.0, features=1.0, min_gain=0.0, min_weight=1.0))
    leaf = B.fit(df, ["f0", "f1", "f2"], "y", ["id"], p=B.BoostParams(trees=1, bins=16, depth=4, rows=1.0, features=1.0, min_gain=0.0, min_weight=1.0, growth="leaf", max_leaves=4))
    assert (leaf.trees[0].feature == B.LEAF).sum() == 4 < (level.trees[0].feature == B.LEAF).sum()


def test_partitions_and_order_do_not_matter(spark):
    x, y = rows_of()
    p = B.BoostParams(trees=10, bins=16, depth=3)
    a, b = (B.fit(frame(spark, x, y).repartition(n, "f1"), ["f0", "f1", "f2"], "y", ["id"], p=p) for n in (1, 7))
    for s, t in zip(a.trees, b.trees, strict=True):
        assert s.feature.tolist() == t.feature.tolist() and s.cut.tolist() == t.cut.tolist() and s.value.tolist() == t.value.tolist()


@pytest.mark.parametrize("metric", ["average_precision", "loss"])
def test_the_fit_ends_after_patience(spark, metric):
    x, y = rows_of(600, 3)
    rng = np.random.default_rng(0)
    checked = [bool(v) for v in rng.random(600) < 0.3]
    p = B.BoostParams(trees=300, bins=16, depth=3, patience=4, metric=metric, step=0.5)
    model = B.fit(frame(spark, x, y, checked=checked), ["f0", "f1", "f2"], "y", ["id"], F.col("checked"), p)
    assert len(model.history) < 300 and len(model.history) == len(model.trees) + 4
    best = max(model.history) if metric == "average_precision" else min(model.history)
    assert model.history[len(model.trees) - 1] == best
    mine = np.array(checked)
    z = model.margins(x[mine])
    if metric == "loss":
        weight = np.where(y[mine] == 1, (y[~mine] == 0).sum() / (y[~mine] == 1).sum(), 1.0)
        assert best == pytest.approx(float((B.losses(y[mine], z, p) * weight).mean()), abs=1e-5)
    else:
        step = (1 / (1 + np.exp(-z)) * B.SCORE_STEPS).astype(int)
        want = sum(((y[mine] == 1) & (step == s)).sum() / y[mine].sum() * y[mine][step >= s].mean() for s in set(step.tolist()))
        assert best == pytest.approx(want)


def test_a_stored_model_scores_alike(spark, tmp_path):
    x, y = rows_of()
    df = frame(spark, x, y)
    model = B.fit(df, ["f0", "f1", "f2"], "y", ["id"], p=B.BoostParams(trees=12, bins=32, depth=4))
    model.save(spark, str(tmp_path))
    again = B.Boosted.load(spark, str(tmp_path))
    want = {r.id: r.score for r in B.score(model, df, ["id"]).collect()}
    assert want == {r.id: r.score for r in B.score(again, df, ["id"]).collect()}
    assert [want[i] for i in range(len(y))] == pytest.approx((1 / (1 + np.exp(-model.margins(x)))).tolist())
    assert again.columns == model.columns and again.importances() == model.importances()
    top = B.top_importances(model, spark, 2).collect()
    assert len(top) == 2 and top[0].importance >= top[1].importance and sum(model.importances().values()) == pytest.approx(1)


def test_focal_derivatives_equal_the_column_expressions(spark):
    rows = [(int(i % 2), float(z)) for i, z in enumerate(np.linspace(-12, 12, 60))]
    df = spark.createDataFrame(rows, "y int, z double")
    g, h = columns.focal_objective(F.col("y"), F.col("z"))
    got = df.select(g.alias("g"), h.alias("h")).collect()
    y, z = (np.array(c) for c in zip(*rows, strict=True))
    want = B.derivatives(y.astype(float), z, B.BoostParams(loss="focal"))
    assert [r.g for r in got] == pytest.approx(want[0].tolist()) and [r.h for r in got] == pytest.approx(want[1].tolist())


def test_thin_inputs(spark):
    x = np.full((20, 2), np.nan)
    model = B.fit(frame(spark, x, np.arange(20) % 2), ["f0", "f1"], "y", ["id"], p=B.BoostParams(trees=4, rows=1.0, features=1.0))
    assert len(model.trees) == 1 and len(model.trees[0].feature) == 1
    one = B.fit(frame(spark, rows_of(30)[0], np.zeros(30, dtype=int)), ["f0"], "y", ["id"], p=B.BoostParams(trees=2))
    assert one.start == 0.0
    empty = B.fit(frame(spark, np.zeros((0, 2)), np.zeros(0)), ["f0", "f1"], "y", ["id"], p=B.BoostParams(trees=2))
    assert B.score(empty, frame(spark, x, np.zeros(20)), ["id"]).count() == 20
    with pytest.raises(ValueError):
        B.fit(frame(spark, x, np.zeros(20)), ["f0"], "y", ["id"], p=B.BoostParams(bins=100))


def test_passes_count_the_smaller_child_and_walk_bins_by_table():
    random = np.random.default_rng(3)
    p = replace(B.LEVEL_WISE, min_weight=0.0, min_rows=1)
    edges = [np.arange(1.0, 8.0)] * 2
    grower = B._Grower([0, 1], edges, p, 1.0)
    x = random.integers(0, 8, (500, 2)).astype(np.uint8)
    x[::11, 0] = p.bins
    g = random.integers(-50, 50, 500) + 40 * (x[:, 0] > 3) - 30 * (x[:, 1] > 5)

    def counted(rows):
        out = np.zeros((3, 2, p.bins + 1), dtype=np.int64)
        for f in range(2):
            for i, w in enumerate((g, np.full(500, 7), np.ones(500, dtype=np.int64))):
                np.add.at(out[i, f], x[rows, f], w[rows])
        return out

    everything = counted(np.arange(500))
    opened = grower.searched(0, everything)
    assert len(opened) == 2
    asked = grower.to_count(opened)
    assert len(asked) == 1 and grower.sums[asked[0]][2] <= 250
    at = grower.tree().binned_nodes(x, p.bins)
    number = grower.numbers()
    parts = {i: counted(np.flatnonzero(at == number[i])) for i in opened}
    whole = grower.completed({asked[0]: parts[asked[0]]}, opened, {0: everything})
    assert all((whole[i] == parts[i]).all() for i in opened)


def test_a_pass_is_one_job_of_one_stage(spark):
    """Levels of a tree neither plan a query nor exchange rows."""
    x, y = rows_of(300, 5)
    df, context, jobs = frame(spark, x, y), spark.sparkContext, {}
    for trees in (2, 5):
        context.setJobGroup(f"boosted-{trees}", "")
        assert len(B.fit(df, ["f0", "f1", "f2"], "y", ["id"], p=B.BoostParams(trees=trees, bins=16, depth=3)).trees) == trees
        jobs[trees] = context.statusTracker().getJobIdsForGroup(f"boosted-{trees}")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs[5]) - len(jobs[2]) <= 3 * 3


def test_edges_of_large_columns_equal_the_quantiles(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=9000), np.round(rng.exponential(size=9000), 1), rng.integers(0, 2, 9000), np.full(9000, np.nan), np.where(rng.random(9000) < 0.01, np.inf, -0.0)])
    x[rng.random(x.shape) < 0.1] = np.nan
    df = frame(spark, np.sort(x, axis=0), np.zeros(9000, dtype=int))
    columns = [f"f{i}" for i in range(5)]
    few, many = (quantiles.quantile_table(df, columns, [i / 64 for i in range(1, 64)], group_limit=n) for n in (10, 10_000))
    got = quantiles.large_quantiles(df, columns, [i / 64 for i in range(1, 64)], 500)
    assert sorted(got) == sorted(few) == ["f0", "f1", "f2", "f4"]
    for c in got:
        assert got[c] == few[c] == pytest.approx(many[c], nan_ok=True)
