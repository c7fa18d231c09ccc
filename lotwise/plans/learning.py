"""Registered queries: models, projections, clusters and outliers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from lotwise.operators import boosting, metrics, ml, neighbors
from lotwise.operators import dbscan as density
from lotwise.plans.bindings import dies, on_dies, query, rounded, table
from lotwise.plans.scratch import folder

COLS = ["test_temp_c", "rh_susceptibility", "trp_ns", "tras_ns", "rw_latency_ns", "idd2p_standby_ma", "idd5_refresh_ma", "edge_distance"]
KEY = ["die_key"]


def _rows(spark, d):
    return dies(spark, d).select("die_key", "split", "is_fail", "die_x", "die_y", *COLS)


@query("ml01_logistic_regression")
def _(spark, d):
    df = ml.assemble(ml.scaled(_rows(spark, d), COLS), COLS)
    model = ml.fit_logistic(df.where("split = 'train'"), "is_fail")
    scored = ml.score_rows(model, df.where("split <> 'train'"), ["die_key", "split", "is_fail"])
    return metrics.evaluate(scored.withColumnRenamed("is_fail", "label"))


def _boosted(spark, d, p=boosting.LEVEL_WISE):
    """All rows, and the model fitted on the training days, stopped by the validation rows."""
    df = _rows(spark, d)
    return df, boosting.fit(df.where("split IN ('train', 'val')"), COLS, "is_fail", KEY, F.col("split") == "val", p)


@query("ml02_boosted_trees")
def _(spark, d):
    df, model = _boosted(spark, d)
    return boosting.score(model, df.where("split <> 'train'"), ["die_key", "is_fail"])


@query("ml03_boosted_trees_wide")
def _(spark, d):
    df, model = _boosted(spark, d, boosting.LEAF_WISE)
    return boosting.score(model, df.where("split <> 'train'"), ["die_key", "is_fail"])


@query("ml04_top_importances")
def _(spark, d):
    return boosting.top_importances(_boosted(spark, d)[1], spark)


# --- one split, found in SQL -------------------------------------------------------------------------

GAPPY = [*COLS, "cell_leakage_fa", "vt_shift_mv"]


def _split_sql(loss: str) -> str:
    """The best first split of all training rows: every cut of every column, missing values on either side."""
    shrunk = "(sign({0}) * greatest(abs({0}) - 0.1e0, 0e0))".format
    purity = lambda g, h: f"({shrunk(g)} * {shrunk(g)} / ({h} + 1e0))"
    slope = {
        "log": ("p - y", "p * (1 - p)"),
        "focal": ("CASE WHEN y = 1 THEN 0.75e0 ELSE 0.25e0 END * (2 * (1 - t) * ln(t) * p * (1 - p) + (1 - t) * (1 - t) * (p - y))", "greatest(abs(g0) * (1 - abs(g0)), 1e-7)"),
    }[loss]
    weight = "CASE WHEN y = 1 THEN n0 / n1 ELSE 1e0 END" if loss == "log" else "1e0"
    columns = ", ".join(f"({i}, '{c}')" for i, c in enumerate(GAPPY))
    return on_dies(
        f"SELECT c.name AS feature, s.cut, round(gain, 6) AS gain, missing_left, n_below, n_above, round(-0.1e0 * {shrunk('gl')} / (hl + 1e0), 6) AS below_value, round(-0.1e0 * {shrunk('gr')} / (hr + 1e0), 6) AS above_value "
        "FROM s JOIN c ON c.name = s.feature WHERE hl >= 5 AND hr >= 5 AND n_below >= 1 AND n_above >= 1 ORDER BY s.gain DESC, c.i, s.cut, missing_left LIMIT 1",
        f"c AS (SELECT * FROM (VALUES {columns}) AS v(i, name))",
        "k AS (SELECT cast(count(*) FILTER (WHERE is_fail = 1) as double) AS n1, cast(count(*) FILTER (WHERE is_fail = 0) as double) AS n0 FROM dies WHERE split = 'train')",
        f"m AS (SELECT dies.*, cast(is_fail as double) AS y, {weight.replace('y = 1', 'is_fail = 1')} AS w, 0.5e0 AS p FROM dies, k WHERE split = 'train')",
        f"d0 AS (SELECT *, CASE WHEN y = 1 THEN p ELSE 1 - p END AS t FROM m)",
        f"d1 AS (SELECT *, {slope[0]} AS g0 FROM d0)",
        f"r AS (SELECT *, round_even(g0 * w * 16777216, 0) AS g, round_even(({slope[1]}) * w * 16777216, 0) AS h FROM d1)",
        "v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, cast({c} as double) AS value, g, h FROM r" for c in GAPPY) + ")",
        "e AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [" + ", ".join(f"{i / 64!r}e0" for i in range(1, 64)) + "]))) AS e FROM v WHERE value IS NOT NULL GROUP BY feature)",
        "u AS (SELECT feature, unnest(e) AS cut FROM e)",
        "b AS (SELECT feature, value, sum(g) AS g, sum(h) AS h, count(*) AS n FROM v GROUP BY ALL)",
        "a AS (SELECT feature, sum(g) AS g, sum(h) AS h, sum(n) AS n, coalesce(sum(g) FILTER (WHERE value IS NULL), 0) AS gm, coalesce(sum(h) FILTER (WHERE value IS NULL), 0) AS hm, coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS nm FROM b GROUP BY feature)",
        "l AS (SELECT u.feature, u.cut, coalesce(sum(b.g), 0) AS g, coalesce(sum(b.h), 0) AS h, coalesce(sum(b.n), 0) AS n FROM u LEFT JOIN b ON b.feature = u.feature AND b.value < u.cut GROUP BY ALL)",
        "o AS (SELECT feature, cut, missing_left, CASE WHEN missing_left THEN l.g + gm ELSE l.g END / 16777216 AS gl, CASE WHEN missing_left THEN l.h + hm ELSE l.h END / 16777216 AS hl, "
        "cast(CASE WHEN missing_left THEN l.n + nm ELSE l.n END as bigint) AS n_below, a.g / 16777216 AS g, a.h / 16777216 AS h, cast(a.n as bigint) AS n "
        "FROM l JOIN a USING (feature), (VALUES (false), (true)) AS z(missing_left) WHERE nm > 0 OR NOT missing_left)",
        f"s AS (SELECT *, n - n_below AS n_above, {purity('gl', 'hl')} + {purity('gr', 'hr')} - {purity('g', 'h')} AS gain FROM (SELECT *, g - gl AS gr, h - hl AS hr FROM o))",
    )


def _first_split(spark, d, **given):
    df = dies(spark, d).select("die_key", "split", "is_fail", *GAPPY)
    p = replace(boosting.LEVEL_WISE, trees=1, depth=1, rows=1.0, features=1.0, min_gain=0.0, **given)
    tree = boosting.fit(df.where("split = 'train'"), GAPPY, "is_fail", KEY, p=p).trees[0]
    below, above = int(tree.below[0]), int(tree.above[0])
    row = (GAPPY[tree.feature[0]], float(tree.cut[0]), float(tree.gain[0]), bool(tree.missing_left[0]), int(tree.n[below]), int(tree.n[above]), float(tree.value[below]), float(tree.value[above]))
    names = "feature string, cut double, gain double, missing_left boolean, n_below long, n_above long, below_value double, above_value double"
    return rounded(spark.createDataFrame([row], names), cut=12)


@query("ml02_first_split", _split_sql("log"))
def _(spark, d):
    return _first_split(spark, d)


@query("me11_focal_first_split", _split_sql("focal"))
def _(spark, d):
    """The same search on the gradients of the focal loss, as a booster with that objective starts."""
    return _first_split(spark, d, loss="focal", balanced=False)


_REPORT = on_dies("SELECT split, count(*) AS n, cast(sum(is_fail) as bigint) AS n_fail, true AS above_base_rate, true AS same_scores FROM dies WHERE split <> 'train' GROUP BY split")


@query("ml05_stored_model_scores", _REPORT)
def _(spark, d):
    """A fitted model written to the shared folder, loaded again and applied to every row that it was not fitted on: scores
    as before, and a ranking better than chance."""
    df, model = _boosted(spark, d)
    path = folder(spark, "boosted")
    model.save(spark, path)
    unseen = df.where("split <> 'train'")
    scored = boosting.score(boosting.Boosted.load(spark, path), unseen, ["split", "is_fail", *COLS])
    both = boosting.score(model, scored, ["split", F.col("is_fail").alias("label"), "score"], "direct")
    return _against_chance(both, F.bool_and(F.col("score") == F.col("direct")))


@query("ml03_leaf_wise_scores", _REPORT)
def _(spark, d):
    df, model = _boosted(spark, d, boosting.LEAF_WISE)
    small = all((t.feature == boosting.LEAF).sum() <= boosting.LEAF_WISE.max_leaves for t in model.trees)
    scored = boosting.score(model, df.where("split <> 'train'"), ["split", F.col("is_fail").alias("label")])
    return _against_chance(scored, F.lit(small))


def _against_chance(scored, same):
    """Per split: rows, fails, whether average precision is above the share of fails, and a further test."""
    path = folder(scored.sparkSession, "scored")
    scored.write.parquet(path)
    scored = scored.sparkSession.read.parquet(path)
    found = scored.groupBy("split").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("n_fail"), same.alias("same_scores"))
    quality = metrics.ranking_metrics(metrics.precision_recall_curve(scored, ["split"], "label", "score"), ["split"])
    return found.join(quality.select("split", (F.col("auc_pr") > F.col("baseline_ap")).alias("above_base_rate")), "split").select(
        "split", "n", "n_fail", "above_base_rate", "same_scores")


@query("ml05_score_foreign", on_dies("SELECT die_key, round(1 / (1 + exp(-(0.1e0 * (test_temp_c - 85) + 2e0 * rh_susceptibility - 1e0))), 6) AS score FROM dies"))
def _(spark, d):
    def load():
        import numpy as np

        return lambda x: 1.0 / (1.0 + np.exp(-(0.1 * (x[:, 0] - 85.0) + 2.0 * x[:, 1] - 1.0)))

    return rounded(ml.score_foreign(_rows(spark, d), ["test_temp_c", "rh_susceptibility"], load).select("die_key", "score"))


@query("ml06_explained_variance")
def _(spark, d):
    df = ml.assemble(ml.scaled(_rows(spark, d), COLS), COLS)
    return ml.explained_variance(ml.fit_pca(df, len(COLS)), df)


@query("ml06_components_to_90")
def _(spark, d):
    df = ml.assemble(ml.scaled(_rows(spark, d), COLS), COLS)
    return ml.components_for(ml.explained_variance(ml.fit_pca(df, len(COLS)), df))


@query("ml06_top_loadings")
def _(spark, d):
    df = ml.assemble(ml.scaled(_rows(spark, d), COLS), COLS)
    return ml.top_loadings(ml.fit_pca(df, 4), COLS, df)


def _pcs(spark, d, k=4):
    df = ml.assemble(ml.scaled(_rows(spark, d), COLS), COLS)
    return ml.project(ml.fit_pca(df, k), df, ["die_key", "is_fail"])


@query("ml07_kmeans_fail_rate")
def _(spark, d):
    return ml.cluster_fail_rate(ml.kmeans(_pcs(spark, d)), "is_fail")


_GRID = "(SELECT l_partkey, avg(l_extendedprice) / 10000e0 AS x, avg(l_discount) * 100 AS y FROM lineitem GROUP BY l_partkey)"


@query("ml08_dbscan_parts",
    f"WITH p AS (SELECT a.l_partkey AS id, a.x, a.y FROM {_GRID} a), nb AS (SELECT a.id, b.id AS other FROM p a JOIN p b ON b.x BETWEEN a.x - 0.12e0 AND a.x + 0.12e0 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.12e0 * 0.12e0), "
    "core AS (SELECT id FROM nb GROUP BY id HAVING count(*) >= 12) SELECT p.id AS part, p.id IN (SELECT id FROM core) AS is_core, p.id NOT IN (SELECT nb.id FROM nb JOIN core ON core.id = nb.other) AS is_noise FROM p")
def _(spark, d):
    pts = table(spark, d, "lineitem").groupBy("l_partkey").agg(
        (F.avg("l_extendedprice") / 10000.0).alias("x"), (F.avg("l_discount") * 100).alias("y"))
    arr = pts.select(F.col("l_partkey").alias("part"), F.array("x", "y").alias("v"))
    found = density.dbscan(arr, "part", "v", 0.12, 12, 2)
    return found.select("part", "is_core", F.col("cluster").isNull().alias("is_noise"))


@query("ml08_dbscan_components")
def _(spark, d):
    df = ml.from_array(table(spark, d, "embeddings").select("vec_id", "label", "embedding"), "embedding")
    pcs = ml.project(ml.fit_pca(df, 4), df, ["vec_id", "label"])
    return density.cluster_summary(density.dbscan(pcs, "vec_id", "pcs", 0.12, 5, 4))


@query("ml09_isolation_forest")
def _(spark, d):
    found = ml.isolation_forest(_rows(spark, d), COLS, KEY)
    return found.select("die_key", "anomaly", "is_outlier")


_Z = "z AS (SELECT die_key, is_fail, " + " OR ".join(f"abs(({c} - (SELECT avg({c}) FROM dies)) / (SELECT stddev_pop({c}) FROM dies)) > 2.2" for c in COLS) + " AS z_outlier, " + " OR ".join(
    f"({c} > (SELECT quantile_cont({c}, 0.75) + 0.6e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM dies) OR {c} < (SELECT quantile_cont({c}, 0.25) - 0.6e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM dies))" for c in COLS
) + " AS iqr_outlier FROM dies)"


@query("ml10_zscore_outliers", on_dies("SELECT die_key, z_outlier FROM z", _Z))
def _(spark, d):
    return ml.zscore_outliers(_rows(spark, d), COLS, 2.2).select("die_key", "z_outlier")


@query("ml11_iqr_outliers", on_dies("SELECT die_key, iqr_outlier FROM z", _Z))
def _(spark, d):
    return ml.iqr_outliers(_rows(spark, d), COLS, 0.6).select("die_key", "iqr_outlier")


@query("ml11_upper_threshold", on_dies("SELECT count(*) AS n, count(*) FILTER (WHERE cell_leakage_fa > (SELECT quantile_cont(cell_leakage_fa, 0.75) + 1.5e0 * (quantile_cont(cell_leakage_fa, 0.75) - quantile_cont(cell_leakage_fa, 0.25)) FROM dies)) AS n_outliers FROM dies"))
def _(spark, d):
    found = ml.iqr_outliers(dies(spark, d), ["cell_leakage_fa"], upper_only=True)
    return found.agg(F.count("*").alias("n"), F.count_if("iqr_outlier").alias("n_outliers"))


@query("ml12_detector_agreement", on_dies(
    "SELECT kind, count(*) AS n, count(*) FILTER (WHERE is_fail = 1) AS n_fail, round(count(*) FILTER (WHERE is_fail = 1) / (SELECT count(*) FROM dies WHERE is_fail = 1)::double, 6) AS caught_share FROM ("
    "SELECT is_fail, CASE WHEN z_outlier AND iqr_outlier THEN 'both' WHEN z_outlier THEN 'only_a' WHEN iqr_outlier THEN 'only_b' ELSE 'neither' END AS kind FROM z) GROUP BY kind", _Z))
def _(spark, d):
    df = ml.iqr_outliers(ml.zscore_outliers(_rows(spark, d), COLS, 2.2), COLS, 0.6)
    return rounded(ml.detector_agreement(df, "z_outlier", "iqr_outlier", "is_fail"))


@query("fe14_nearest_neighbours",
    "WITH pts AS (SELECT vec_id, cast(embedding as double[]) AS e FROM embeddings) SELECT query_id, donor_id, round(dist, 6) AS distance, cast(r as int) AS rank FROM (SELECT p.vec_id AS query_id, q.vec_id AS donor_id, list_distance(p.e, q.e) AS dist, "
    "row_number() OVER (PARTITION BY p.vec_id ORDER BY list_distance(p.e, q.e), q.vec_id) AS r FROM pts p JOIN pts q ON p.vec_id <> q.vec_id) WHERE r <= 5")
def _(spark, d):
    pts = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return rounded(neighbors.nearest(pts, pts, "vec_id", "v", 5, exclude_self=True, pivots=8))
