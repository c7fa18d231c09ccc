"""Density clustering without enumerating neighbour pairs inside crowded regions.

Points fall into grid cells whose diagonal is eps, so a cell with enough points consists of core points that all
reach each other and needs no distances. Distances are evaluated only for the few points of thin cells. Whether
two cells of core points touch is settled by halving both until their bounding boxes decide or hold so few points
that these can be compared directly. The cell graph is then reduced to components.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import cut_lineage


PAIR_LIMIT = 4096


def dbscan(df: DataFrame, key: str, features: str, eps: float, min_samples: int, dims: int) -> DataFrame:
    """(key, cluster, is_core): ``cluster`` is the smallest key of the cluster, null for noise. A border point
    within reach of several clusters joins the one with the smallest key."""
    side = eps / math.sqrt(dims)
    v = F.transform(F.col(features).cast("array<double>"), lambda x: x + 0.0)
    named = df.select(F.col(key).alias("id"), v.alias("v")).withColumn("vid", F.md5(F.to_json(F.struct("v"))))
    points = cut_lineage(
        named.groupBy("vid")
        .agg(F.first("v").alias("v"), F.count("*").alias("w"), F.min("id").alias("first_id"))
        .withColumn("cell", _cell("v", side))
    )
    cells = points.groupBy("cell").agg(F.sum("w").alias("n"), *_box(dims))
    near = cut_lineage(_adjacent(cells, eps, side, dims))
    dense = cells.where(F.col("n") >= min_samples).select("cell")
    thin = points.join(dense, "cell", "left_anti")
    counts = _reach_counts(thin, points, cells, near, eps, dims)
    thin_core = counts.where(F.col("reach") >= min_samples).select("vid")
    core = cut_lineage(
        points.join(dense, "cell", "left_semi").unionByName(thin.join(thin_core, "vid", "left_semi"))
    )
    links = _touching(core, near, eps, side, dims)
    labels = _components(core.groupBy("cell").agg(F.min("first_id").alias("label")), links)
    core_labels = core.join(labels, "cell").select("vid", "label", F.lit(True).alias("is_core"))
    border = _border(thin.join(thin_core, "vid", "left_anti"), core, labels, near, eps, dims)
    both = core_labels.unionByName(border.withColumn("is_core", F.lit(False)))
    return named.join(both, "vid", "left").select(
        F.col("id").alias(key), F.col("label").alias("cluster"), F.coalesce("is_core", F.lit(False)).alias("is_core")
    )


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """One row: clusters, noise points and points."""
    return clustered.agg(
        F.count_distinct("cluster").alias("n_clusters"),
        F.count_if(F.col("cluster").isNull()).alias("n_noise"),
        F.count("*").alias("n_points"),
    )


def _cell(v: str, side: float) -> Column:
    return F.array_join(F.transform(F.col(v), lambda x: F.floor(x / side).cast("string")), ",")


def _box(dims: int) -> list[Column]:
    low = F.array(*[F.min(F.col("v")[i]) for i in range(dims)]).alias("lo")
    high = F.array(*[F.max(F.col("v")[i]) for i in range(dims)]).alias("hi")
    return [low, high]


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _squared(a: str, b: str, dims: int) -> Column:
    return _total([(F.col(a)[i] - F.col(b)[i]) * (F.col(a)[i] - F.col(b)[i]) for i in range(dims)])


def _gap(alo: str, ahi: str, blo: str, bhi: str, dims: int) -> tuple[Column, Column]:
    """Squared smallest and largest distance between points of two boxes."""
    near, far = [], []
    for i in range(dims):
        a0, a1, b0, b1 = (F.col(c)[i] for c in (alo, ahi, blo, bhi))
        apart = F.greatest(F.lit(0.0), b0 - a1, a0 - b1)
        span = F.greatest(F.abs(b1 - a0), F.abs(a1 - b0))
        near.append(apart * apart)
        far.append(span * span)
    return _total(near), _total(far)


def _adjacent(cells: DataFrame, eps: float, side: float, dims: int) -> DataFrame:
    """(a, b): cells whose boxes come within eps, both directions, a = b included.

    Cells meet through blocks of edge eps: a block holds a bounded number of cells and has 3^dims neighbours.
    """
    block = F.transform(F.col("lo"), lambda x: F.floor(x / eps))
    placed = cells.select("cell", "lo", "hi", block.alias("block"))
    # A cell can straddle two blocks per axis; it is filed under every block its box touches.
    top = F.transform(F.col("hi"), lambda x: F.floor(x / eps))
    spread = cells.select(F.col("cell").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), block.alias("b0"), top.alias("b1"))
    filed = spread
    for i in range(dims):
        filed = filed.withColumn(f"x{i}", F.explode(F.sequence(F.col("b0")[i], F.col("b1")[i])))
    filed = filed.withColumn("slot", F.concat_ws(",", *[F.col(f"x{i}") for i in range(dims)])).select("b", "blo", "bhi", "slot")
    around = placed.select("cell", "lo", "hi", "block", F.transform(F.col("hi"), lambda x: F.floor(x / eps)).alias("top"))
    for i in range(dims):
        around = around.withColumn(f"x{i}", F.explode(F.sequence(F.col("block")[i] - 1, F.col("top")[i] + 1)))
    around = around.withColumn("slot", F.concat_ws(",", *[F.col(f"x{i}") for i in range(dims)])).select(
        F.col("cell").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), "slot"
    )
    least, _ = _gap("alo", "ahi", "blo", "bhi", dims)
    return around.join(filed, "slot").where(least <= eps * eps).select("a", "b").distinct()


def _reach_counts(thin: DataFrame, points: DataFrame, cells: DataFrame, near: DataFrame, eps: float, dims: int) -> DataFrame:
    """(vid, reach): points within eps of each point of a thin cell, itself included."""
    asks = (
        thin.select("vid", F.col("v").alias("p"), F.col("cell").alias("a"))
        .join(near, "a")
        .join(cells.select(F.col("cell").alias("b"), "n", "lo", "hi"), "b")
    )
    least, most = _gap("p", "p", "lo", "hi", dims)
    ranged = asks.withColumns({"least": least, "most": most}).where(F.col("least") <= eps * eps)
    whole = ranged.where(F.col("most") <= eps * eps).select("vid", F.col("n").alias("k"))
    part = ranged.where(F.col("most") > eps * eps).select("vid", "p", "b")
    others = points.select(F.col("cell").alias("b"), F.col("v").alias("q"), "w")
    counted = (
        part.join(others, "b").where(_squared("p", "q", dims) <= eps * eps).select("vid", F.col("w").alias("k"))
    )
    return whole.unionByName(counted).groupBy("vid").agg(F.sum("k").alias("reach"))


def _touching(core: DataFrame, near: DataFrame, eps: float, side: float, dims: int) -> DataFrame:
    """(a, b), a < b: cells with core points within eps of each other, by halving boxes until they decide."""
    members = core.select("cell").distinct()
    pairs = (
        near.where(F.col("a") < F.col("b"))
        .join(members.select(F.col("cell").alias("a")), "a", "left_semi")
        .join(members.select(F.col("cell").alias("b")), "b", "left_semi")
    )
    found = None
    open_pairs = pairs.select("a", "b", F.col("a").alias("sa"), F.col("b").alias("sb"))
    level = 0
    while True:
        used = open_pairs.select(F.col("a").alias("cell")).unionByName(open_pairs.select(F.col("b").alias("cell"))).distinct()
        width = side / 2**level
        inside = core.join(used, "cell", "left_semi").withColumn("sub", _cell("v", width) if level else F.col("cell"))
        boxes = inside.groupBy("cell", "sub").agg(F.count("*").alias("m"), *_box(dims))
        left = boxes.select(F.col("cell").alias("a"), F.col("sub").alias("sa"), F.col("m").alias("am"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        right = boxes.select(F.col("cell").alias("b"), F.col("sub").alias("sb"), F.col("m").alias("bm"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        least, most = _gap("alo", "ahi", "blo", "bhi", dims)
        judged = cut_lineage(
            open_pairs.join(left, ["a", "sa"]).join(right, ["b", "sb"]).withColumns({"least": least, "most": most})
            .where(F.col("least") <= eps * eps)
            .select(
                "a", "b", "sa", "sb", (F.col("most") <= eps * eps).alias("sure"),
                (F.col("am") * F.col("bm") <= PAIR_LIMIT).alias("few"),
            )
        )
        sure = judged.where("sure").select("a", "b").distinct()
        open_now = judged.join(sure, ["a", "b"], "left_anti")
        pa = inside.select(F.col("cell").alias("a"), F.col("sub").alias("sa"), F.col("v").alias("p"))
        pb = inside.select(F.col("cell").alias("b"), F.col("sub").alias("sb"), F.col("v").alias("q"))
        compared = (
            open_now.where("few").join(pa, ["a", "sa"]).join(pb, ["b", "sb"])
            .where(_squared("p", "q", dims) <= eps * eps).select("a", "b").distinct()
        )
        settled = cut_lineage(sure.unionByName(compared))
        found = settled if found is None else found.unionByName(settled)
        rest = open_now.where(~F.col("few")).join(settled, ["a", "b"], "left_anti").select("a", "b", "sa", "sb")
        if rest.isEmpty():
            return found
        level += 1
        # Children of a box: the half-width cells of its points. Few, whatever the number of points.
        width = side / 2**level
        previous = _cell("v", side / 2 ** (level - 1)) if level > 1 else F.col("cell")
        kids = core.withColumns({"old": previous, "new": _cell("v", width)}).select("cell", "old", "new").distinct()
        la = kids.select(F.col("cell").alias("a"), F.col("old").alias("sa"), F.col("new").alias("na"))
        lb = kids.select(F.col("cell").alias("b"), F.col("old").alias("sb"), F.col("new").alias("nb"))
        open_pairs = cut_lineage(
            rest.join(la, ["a", "sa"]).join(lb, ["b", "sb"]).select("a", "b", F.col("na").alias("sa"), F.col("nb").alias("sb"))
        )


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(cell, label): smallest label over each component; labels travel along links and then jump to the label
    of their label's holder, so rounds grow with the logarithm of the diameter."""
    edges = cut_lineage(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    current = cut_lineage(nodes.select("cell", F.col("label").alias("own"), "label"))
    while True:
        offers = edges.join(current.select(F.col("cell").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("offer"))
        met = current.join(offers, current["cell"] == offers["a"], "left").select(
            "cell", "own", F.least("label", "offer").alias("next"), F.col("label").alias("was")
        )
        holders = met.select(F.col("own").alias("next"), F.col("next").alias("jump"))
        moved = cut_lineage(
            met.join(holders, "next", "left").select("cell", "own", F.least("next", "jump").alias("label"), "was")
        )
        if moved.where(F.col("label") != F.col("was")).isEmpty():
            return moved.select("cell", "label")
        current = moved.select("cell", "own", "label")


def _border(rest: DataFrame, core: DataFrame, labels: DataFrame, near: DataFrame, eps: float, dims: int) -> DataFrame:
    """(vid, label) of points that are not core but within eps of one."""
    boxes = core.groupBy("cell").agg(*_box(dims)).join(labels, "cell").withColumnRenamed("cell", "b")
    asks = rest.select("vid", F.col("v").alias("p"), F.col("cell").alias("a")).join(near, "a").join(boxes, "b")
    least, most = _gap("p", "p", "lo", "hi", dims)
    ranged = asks.withColumns({"least": least, "most": most}).where(F.col("least") <= eps * eps)
    sure = ranged.where(F.col("most") <= eps * eps).select("vid", "label")
    part = ranged.where(F.col("most") > eps * eps).select("vid", "p", "b", "label")
    others = core.select(F.col("cell").alias("b"), F.col("v").alias("q"))
    seen = part.join(others, "b").where(_squared("p", "q", dims) <= eps * eps).select("vid", "label")
    return sure.unionByName(seen).groupBy("vid").agg(F.min("label").alias("label"))

