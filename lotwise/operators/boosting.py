"""Boosted trees by histograms of gradients.

Features are cut into quantile bins once and the binned rows are written to the shared folder: a byte a feature. The rows that a
tree is fitted on are kept with their gradients and second derivatives while it grows (in memory, else on disk). A level of the tree is one
pass over them, a job of one stage: tasks find the open node of each row and add up both and the
rows by (node, feature, bin), for the smaller one of two children, the other is the difference from their parent. A task returns nodes x
features x bins sums, whatever its number of rows; those of many tasks are added up by tasks first.
The driver holds the model and those sums alone. Sums are of integers (gradients in fixed steps), so a model depends
neither on partitions nor on the order of rows.

Growth: ``level`` opens all nodes of a depth and then takes back splits that gain less than ``min_gain``; ``leaf`` takes the
best split first until ``max_leaves`` (a node's best split does not depend on other nodes, so the passes still go by depth).
Missing values have a bin of their own, and each split sends them to the side that gains more.

The first pass of a tree also measures the trees before it on the validation rows, so a fit ends by itself after
``patience`` trees without a better one. Margins are written every ``KEPT_TREES`` trees; a tree walks only the trees since then.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lotwise.operators.quantiles import GROUP_LIMIT, large_quantiles, quantile_table
from lotwise.session import settings, shared_folder
from lotwise.spec import FocalParams

KEPT_TREES = 8
ARROW_ROWS = 50_000  # a batch: few calls a pass, and its columns still fit a core's cache
DRIVER_PARTS = 64  # sums that the driver adds up itself
SMALL = 1e-6  # a margin that changes no score
SCORE_STEPS = 4096  # of the scores that validation counts
LEAF = -1
NODE_SCHEMA = (
    "tree int, node int, feature int, cut double, cut_bin int, missing_left boolean, below int, above int, "
    "value double, gain double, n bigint"
)


@dataclass(frozen=True)
class BoostParams:
    """``loss``: log, which starts at the log-odds of the weighted labels, or focal, which starts at 0;
    ``metric`` on the validation rows: average_precision or loss."""

    trees: int = 300
    depth: int = 6
    step: float = 0.1
    bins: int = 64
    rows: float = 0.8
    features: float = 0.8
    min_weight: float = 5.0
    min_rows: int = 1
    min_gain: float = 1.0
    l1: float = 0.1
    l2: float = 1.0
    growth: str = "level"
    max_leaves: int = 31
    patience: int = 20
    loss: str = "log"
    metric: str = "average_precision"
    balanced: bool = True
    focal: FocalParams = FocalParams()
    seed: int = 42


LEVEL_WISE = BoostParams()
LEAF_WISE = BoostParams(growth="leaf", rows=1.0, min_weight=1e-3, min_rows=20, min_gain=0.0, l1=0.1, l2=1.0)


@dataclass
class Tree:
    """Flat arrays by node; a leaf has feature -1. Rows with a value below ``cut`` go ``below``. Children come after their parent."""

    feature: np.ndarray
    cut: np.ndarray
    cut_bin: np.ndarray
    missing_left: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    n: np.ndarray

    def binned_nodes(self, x: np.ndarray, bins: int) -> np.ndarray:
        """Node in which each row of bins ends; `bins` itself stands for a missing value. One table holds the next node by
        node and bin, so a level is three lookups a row."""
        inner = self.feature != LEAF
        left = np.arange(bins + 1) <= self.cut_bin[:, None]
        left[:, bins] = self.missing_left
        after = np.where(inner[:, None], np.where(left, self.below[:, None], self.above[:, None]), np.arange(len(inner))[:, None]).ravel()
        feature, flat = np.where(inner, self.feature, 0).astype(np.int64), x.ravel()
        at, start = np.zeros(len(x), dtype=np.int64), np.arange(len(x)) * x.shape[1]
        for _ in range(self._depth()):
            at = after[at * (bins + 1) + flat[start + feature[at]]]
        return at

    def _depth(self) -> int:
        depth = np.zeros(len(self.feature), dtype=np.int64)
        for i in np.flatnonzero(self.feature != LEAF).tolist():
            depth[[self.below[i], self.above[i]]] = depth[i] + 1
        return int(depth.max())

    def nodes(self, x: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """Node in which each row of x ends."""
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            feature = self.feature[at]
            inner = feature != LEAF
            if not inner.any():
                return at
            f = np.where(inner, feature, 0)
            value, gone = x[rows, f], missing[rows, f]
            with np.errstate(invalid="ignore"):
                left = np.where(gone, self.missing_left[at], value < self.cut[at])
            at = np.where(inner, np.where(left, self.below[at], self.above[at]), at)


@dataclass
class Boosted:
    """A fitted model: its columns, starting margin and trees, and the validation metric after each tree."""

    columns: list[str]
    start: float
    trees: list[Tree]
    history: list[float] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        missing = np.isnan(x)
        return self.start + sum((t.value[t.nodes(x, missing)] for t in self.trees), np.zeros(len(x)))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        parts = [pd.DataFrame({
            "tree": i, "node": np.arange(len(t.feature)), "feature": t.feature, "cut": t.cut, "cut_bin": t.cut_bin, "missing_left": t.missing_left,
            "below": t.below, "above": t.above, "value": t.value, "gain": t.gain, "n": t.n}) for i, t in enumerate(self.trees)]
        return spark.createDataFrame(pd.concat(parts), NODE_SCHEMA) if parts else spark.createDataFrame([], NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as Parquet below ``path``, which executors can reach, and one row with the rest."""
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(self.columns, self.start, self.history)]
        spark.createDataFrame(head, "columns array<string>, start double, history array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        head = spark.read.parquet(f"{path}/head").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        trees = [Tree(*(t[c].to_numpy() for c in ("feature", "cut", "cut_bin", "missing_left", "below", "above", "value", "gain", "n")))
                 for _, t in nodes.groupby("tree")]
        return cls(list(head["columns"]), head["start"], trees, list(head["history"]))

    def importances(self) -> dict[str, float]:
        """Each column's share of the gain of all splits."""
        total = np.zeros(len(self.columns))
        for t in self.trees:
            inner = t.feature != LEAF
            np.add.at(total, t.feature[inner], t.gain[inner])
        whole = total.sum()
        return dict(zip(self.columns, (total / whole if whole else total).tolist(), strict=True))


# --- losses ----------------------------------------------------------------------------------------

def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def derivatives(y: np.ndarray, z: np.ndarray, p: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and second derivative of the loss by the margin; the focal ones are those of ``losses.focal_objective``."""
    s = _sigmoid(z)
    if p.loss == "log":
        return s - y, s * (1 - s)
    f = p.focal
    s = np.clip(s, f.epsilon, 1 - f.epsilon)
    hit, weight = np.where(y == 1, s, 1 - s), np.where(y == 1, f.alpha, 1 - f.alpha)
    miss = 1 - hit
    gradient = weight * (f.gamma * miss ** (f.gamma - 1) * np.log(hit) * s * (1 - s) + miss ** f.gamma * (s - y))
    return gradient, np.maximum(np.abs(gradient) * (1 - np.abs(gradient)), f.epsilon)


def losses(y: np.ndarray, z: np.ndarray, p: BoostParams) -> np.ndarray:
    if p.loss == "log":
        return np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))
    f = p.focal
    s = np.clip(_sigmoid(z), f.epsilon, 1 - f.epsilon)
    hit, weight = np.where(y == 1, s, 1 - s), np.where(y == 1, f.alpha, 1 - f.alpha)
    return -weight * (1 - hit) ** f.gamma * np.log(hit)


# --- passes over the rows ----------------------------------------------------------------------------

def drawn(pick: np.ndarray, tree: int, share: float) -> np.ndarray:
    """True for the rows that a tree is fitted on: a hash of the row's key and the tree decides."""
    if share >= 1:
        return np.ones(len(pick), dtype=bool)
    x = pick.astype(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * (1 << 53)


def _binned(edges: list[np.ndarray], bins: int):
    """Rows with one byte a feature: the number of edges at or below the value, `bins` if it is missing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, len(edges)), dtype=np.uint8)
            for i, e in enumerate(edges):
                x = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(np.float64)
                out[:, i] = np.where(np.isnan(x), bins, np.searchsorted(e, x, side="right"))
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(edges)), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], rows, pa.array(np.zeros(len(out)))], names=["y", "checked", "pick", "x", "margin"])

    return run


BINNED = "y int, checked boolean, pick long, x binary, margin double"


def _first_byte(rows: pa.Array) -> int:
    kind = np.int64 if pa.types.is_large_binary(rows.type) else np.int32
    return int(np.frombuffer(rows.buffers()[1], dtype=kind, count=1, offset=rows.offset * kind().itemsize)[0])


def _read(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    rows = batch.column(3)  # of one width and never null, so they lie behind each other
    x = np.frombuffer(rows.buffers()[2], dtype=np.uint8, count=len(rows) * width, offset=_first_byte(rows)).reshape(-1, width)
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), x, batch.column(4).to_numpy()


def _with_margins(trees: list[Tree], width: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                *_, x, margin = _read(batch, width)
                for t in trees:
                    margin = margin + t.value[t.binned_nodes(x, bins)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], names=batch.schema.names)

    return run


PACKED = "n int, y binary, checked binary, pick binary, x binary, margin binary"


def _packed(width: int):
    """A row a batch, as it is kept between passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y, checked, *rest = _read(batch, width)
                columns = [pa.array([c.tobytes()], pa.binary()) for c in (y.astype(np.int8), checked.astype(bool), *rest)]
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *columns], names=["n", "y", "checked", "pick", "x", "margin"])

    return run


def _gradients(number: int, since: list[Tree], checking: bool, p: BoostParams, width: int, scale: float, positive: float):
    """Of each batch the rows that a tree is fitted on, with their gradients in fixed steps. If ``checking``, a part without
    rows tells a task's validation rows: positives and all by step of the score, then their loss and number."""
    def run(parts: Iterator) -> Iterator[tuple]:
        steps, rest = np.zeros((2, SCORE_STEPS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for n, *packed in parts:
            y, checked, pick, x, margin = (np.frombuffer(c, dtype=kind) for c, kind in zip(packed, (np.int8, bool, np.int64, np.uint8, np.float64), strict=True))
            x = x.reshape(n, width)
            used = ~checked & drawn(pick, number, p.rows)
            if not checking and not used.all():
                y, x, margin, used = y[used], x[used], margin[used], used[used]
            for t in since:
                margin = margin + t.value[t.binned_nodes(x, p.bins)]
            weight = np.where(y == 1, positive, 1.0)
            if checking and checked.any():
                step = np.minimum((_sigmoid(margin[checked]) * SCORE_STEPS).astype(np.int64), SCORE_STEPS - 1)
                steps[0] += np.bincount(step, weights=y[checked], minlength=SCORE_STEPS).astype(np.int64)
                steps[1] += np.bincount(step, minlength=SCORE_STEPS)
                rest += np.rint(losses(y[checked], margin[checked], p) * weight[checked] * scale).astype(np.int64).sum(), checked.sum()
            yield (x[used], *(np.rint(d * weight[used] * scale) for d in derivatives(y[used], margin[used], p)))
        if checking:
            yield (np.concatenate([steps.ravel(), rest]),)

    return run


def _sums(tree: Tree | None, open_nodes: list[int], features: list[int], checking: bool, p: BoostParams):
    """One array a task: gradients, second derivatives and rows by feature, open node and bin, then the validation rows if ``checking``."""
    def run(rows: Iterator) -> Iterator[np.ndarray]:
        cells = p.bins + 1
        total = np.zeros((3, len(features), len(open_nodes) * cells), dtype=np.int64)
        checks = np.zeros(2 * SCORE_STEPS + 2 if checking else 0, dtype=np.int64)
        slot = np.full(len(tree.feature) if tree else 1, -1)
        slot[open_nodes] = np.arange(len(open_nodes))
        for part in rows:
            if len(part) == 1:
                checks += part[0] if checking else 0
                continue
            if not open_nodes:
                continue
            x, g, h = part
            first = np.zeros(len(x), dtype=np.int64)
            if tree is not None:
                place = slot[tree.binned_nodes(x, p.bins)]
                mine = np.flatnonzero(place >= 0)
                x, g, h, first = x[mine], g[mine], h[mine], place[mine] * cells
            for i, f in enumerate(features):
                cell = first + x[:, f]
                for row, weights in zip(total[:, i], (g, h, None), strict=True):
                    row += np.bincount(cell, weights=weights, minlength=total.shape[2]).astype(np.int64)
        yield np.concatenate([total.ravel(), checks])

    return run


def _kept(parts: RDD) -> RDD:
    """In memory, else on disk; what is lost is made again from the shared folder."""
    return parts.persist(StorageLevel.MEMORY_AND_DISK)


def _added_up(sums: RDD) -> np.ndarray:
    return sums.treeReduce(np.add) if sums.getNumPartitions() > DRIVER_PARTS else sum(sums.collect())


# --- splits ------------------------------------------------------------------------------------------

def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def purity(g: np.ndarray, h: np.ndarray, p: BoostParams) -> np.ndarray:
    return _shrunk(g, p.l1) ** 2 / (h + p.l2)


def leaf_value(g: float, h: float, p: BoostParams) -> float:
    return float(-p.step * _shrunk(np.float64(g), p.l1) / (h + p.l2))


def best_split(sums: np.ndarray, cuts: list[int], p: BoostParams, scale: float) -> tuple | None:
    """(gain, feature slot, bin, missing left, left sums) of the best split of a node, or none that gains.

    ``sums`` is (g h n, feature, bin) with the missing values in the last bin. Ties: first feature, first cut, missing right."""
    inner = sums[:, :, :-1].cumsum(axis=2)[:, :, :-1]
    gone = sums[:, :, -1:]
    left = np.stack([inner, inner + gone], axis=-1)  # (3, feature, cut, missing right or left)
    whole = sums.sum(axis=2)[:, :, None, None]
    right = whole - left
    (gl, hl, nl), (gr, hr, nr) = ((s[0] / scale, s[1] / scale, s[2]) for s in (left, right))
    (g, h) = (whole[0] / scale, whole[1] / scale)
    gain = purity(gl, hl, p) + purity(gr, hr, p) - purity(g, h, p)
    allowed = (np.arange(inner.shape[2]) < np.array(cuts)[:, None])[:, :, None] & (hl >= p.min_weight) & (hr >= p.min_weight)
    allowed &= (nl >= max(p.min_rows, 1)) & (nr >= max(p.min_rows, 1))
    allowed[:, :, 1] &= sums[2, :, -1:] > 0
    gain = np.where(allowed, gain, -np.inf)
    at = int(gain.argmax()) if gain.size else 0
    if not gain.size or not gain.flat[at] > 1e-9:
        return None
    f, cut, side = np.unravel_index(at, gain.shape)
    return float(gain.flat[at]), int(f), int(cut), bool(side), left[:, f, cut, side]


class _Grower:
    """A tree under way: nodes with their sums and, once searched, their best split."""

    def __init__(self, columns: list[int], edges: list[np.ndarray], p: BoostParams, scale: float):
        self.features, self.edges, self.p, self.scale = columns, edges, p, scale
        self.sums: list[np.ndarray] = []
        self.split: list[tuple | None] = []
        self.children: list[tuple[int, int] | None] = []

    def add(self, sums: np.ndarray) -> int:
        self.sums.append(sums)
        self.split.append(None)
        self.children.append(None)
        return len(self.sums) - 1

    def searched(self, node: int, sums: np.ndarray) -> list[int]:
        """Takes the node's histogram and returns the children that its best split opens."""
        if not self.sums:
            self.add(sums[:, 0].sum(axis=1))
        found = best_split(sums, [len(self.edges[f]) for f in self.features], self.p, self.scale)
        if found is None:
            return []
        gain, f, cut, side, left = found
        self.split[node] = (gain, self.features[f], cut, side)
        self.children[node] = (self.add(left), self.add(self.sums[node] - left))
        return list(self.children[node])

    def to_count(self, nodes: list[int]) -> list[int]:
        """Nodes whose rows have to be counted: of two open children the smaller one, the other is what it leaves of their parent."""
        wanted = set(nodes)
        for pair in self.children:
            if pair and wanted.issuperset(pair):
                wanted.discard(max(pair, key=lambda i: self.sums[i][2]))
        return [i for i in nodes if i in wanted]

    def completed(self, counted: dict[int, np.ndarray], nodes: list[int], above: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Histograms of all open nodes from the counted ones and those of the level above; sums are integers, so they are exact."""
        out = dict(counted)
        for parent, pair in enumerate(self.children):
            for mine, other in (pair, pair[::-1]) if pair else ():
                if mine in nodes and mine not in out:
                    out[mine] = above[parent] - counted[other]
        return out

    def worth_searching(self, node: int) -> bool:
        _, h, n = self.sums[node]
        return n >= 2 * max(self.p.min_rows, 1) and h / self.scale >= 2 * self.p.min_weight

    def pruned(self) -> set[int]:
        """Nodes that stay split."""
        if not self.sums or self.split[0] is None:
            return set()
        if self.p.growth == "leaf":
            kept, open_nodes, leaves = set(), [0], 1
            while open_nodes and leaves < self.p.max_leaves:
                best = max(open_nodes, key=lambda i: (self.split[i][0], -i))
                open_nodes.remove(best)
                if self.split[best][0] < self.p.min_gain:
                    break
                kept.add(best)
                leaves += 1
                open_nodes += [c for c in self.children[best] if self.split[c] is not None]
            return kept
        kept = {i for i, s in enumerate(self.split) if s is not None}
        for i in sorted(kept, reverse=True):  # children come after their parent
            if not any(c in kept for c in self.children[i]) and self.split[i][0] < self.p.min_gain:
                kept.discard(i)
        return kept

    def tree(self, kept: set[int] | None = None) -> Tree:
        """The tree of the kept splits; all splits while it grows."""
        kept = {i for i, s in enumerate(self.split) if s is not None} if kept is None else kept
        number, order = {0: 0}, [0]
        for i in order:
            if i in kept:
                for c in self.children[i]:
                    number[c] = len(order)
                    order.append(c)
        rows = []
        for i in order:
            g, h, n = self.sums[i]
            value = leaf_value(g / self.scale, h / self.scale, self.p)
            if i in kept:
                gain, f, cut, side = self.split[i]
                below, above = (number[c] for c in self.children[i])
                rows.append((f, self.edges[f][cut], cut, side, below, above, value, gain, n))
            else:
                rows.append((LEAF, 0.0, 0, False, number[i], number[i], value, 0.0, n))
        kinds = (np.int32, float, np.int32, bool, np.int32, np.int32, float, float, np.int64)
        return Tree(*(np.array(c, dtype=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)))

    def numbers(self) -> dict[int, int]:
        """Place of each node in ``tree()``."""
        number, order = {0: 0}, [0]
        for i in order:
            for c in self.children[i] or ():
                number[c] = len(order)
                order.append(c)
        return number


# --- fitting -----------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each column at multiples of 1 / bins; a value's bin is the number of edges at or below it."""
    probs = [i / bins for i in range(1, bins)]
    points = (quantile_table if df.count() <= GROUP_LIMIT else large_quantiles)(df, columns, probs)
    return [np.unique(np.array(points.get(c, []), dtype=float)) for c in columns]


def binned_average_precision(positives: np.ndarray, rows: np.ndarray) -> float:
    """Average precision over score steps, highest first; rows of one step count as ties."""
    p, n = np.cumsum(positives[::-1]), np.cumsum(rows[::-1])
    if not len(p) or not p[-1]:
        return 0.0
    return float((np.diff(p, prepend=0) / p[-1] * p / np.maximum(n, 1)).sum())


def fit(
    df: DataFrame, columns: Sequence[str], label: str, key: Sequence[str], validation: Column | None = None, p: BoostParams = LEVEL_WISE,
) -> Boosted:
    """Fits on the rows with a label where ``validation`` is not true; it marks the rows that decide when to stop.
    ``key`` names the columns whose hash draws the rows of each tree."""
    with settings(df.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS)}):
        return _fit(df, columns, label, key, validation, p)


def _fit(df: DataFrame, columns: Sequence[str], label: str, key: Sequence[str], validation: Column | None, p: BoostParams) -> Boosted:
    spark, columns = df.sparkSession, list(columns)
    if p.bins > 128 or p.bins & (p.bins - 1):
        raise ValueError("bins must be a power of two up to 128")
    checked = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    narrow = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("_y"), checked.alias("_checked"), F.xxhash64(*key, F.lit(p.seed)).alias("_pick"), *[F.col(c).cast("double").alias(c) for c in columns])
    trained = narrow.where("not _checked")
    edges = bin_edges(trained, columns, p.bins)
    rows = _stored(narrow.mapInArrow(_binned(edges, p.bins), BINNED))
    counts = rows.agg(F.count_if(F.expr("y = 1 and not checked")), F.count_if(F.expr("y = 0 and not checked")), F.count_if("checked")).first()
    checking = counts[2] > 0
    positive = counts[1] / max(counts[0], 1) if p.balanced and counts[0] else 1.0
    weights = (counts[0] * positive, counts[1])
    start = math.log(weights[0] / weights[1]) if p.loss == "log" and min(weights) > 0 else 0.0
    # Fixed steps: batches stay exact as doubles, sums of all rows within 64 bits.
    scale = 2.0 ** min(24, 38 - math.ceil(math.log2(max(positive, 1.0))), 61 - math.ceil(math.log2(max(sum(weights), 1.0))))
    model = Boosted(columns, start, [])
    rows = _stored(rows.withColumn("margin", F.lit(start)))
    packed = _kept(rows.mapInArrow(_packed(len(columns)), PACKED).rdd.map(tuple))
    since: list[Tree] = []
    random = np.random.default_rng(p.seed)
    for number in range(p.trees + 1):
        chosen = sorted(random.choice(len(columns), max(1, round(p.features * len(columns))), replace=False).tolist())
        last = number == p.trees
        measured = checking and number > 0
        if last and not measured:
            break
        drawn_rows = _kept(packed.mapPartitions(_gradients(number, since, measured, p, len(columns), scale, positive)))
        grower = _Grower(chosen, edges, p, scale)
        open_nodes, counted, partial = [0], [0], None
        histograms: dict[int, np.ndarray] = {}
        for depth in range(1 if last else p.depth):
            numbers = grower.numbers() if grower.sums else {0: 0}
            asked = [] if last else [numbers[i] for i in counted]
            sums = _added_up(drawn_rows.mapPartitions(_sums(partial, asked, chosen, measured and depth == 0, p)))
            cells = 3 * len(chosen) * len(asked) * (p.bins + 1)
            if measured and depth == 0:
                model.history.append(_measure(sums[cells:], p, scale))
                last = last or len(model.history) >= kept_trees(model.history, p) + p.patience
            if last:
                break
            by_node = sums[:cells].reshape(3, len(chosen), len(asked), p.bins + 1)
            histograms = grower.completed({i: by_node[:, :, at] for at, i in enumerate(counted)}, open_nodes, histograms)
            open_nodes = [c for i in open_nodes for c in grower.searched(i, histograms[i]) if grower.worth_searching(c)]
            counted = grower.to_count(open_nodes)
            if not open_nodes:
                break
            partial = grower.tree()
        drawn_rows.unpersist()
        if last:
            break
        tree = grower.tree(grower.pruned())
        model.trees.append(tree)
        if len(tree.feature) == 1 and abs(tree.value[0]) < SMALL and p.rows >= 1 and p.features >= 1:
            break  # every further tree would be the same
        since.append(tree)
        if len(since) == KEPT_TREES:
            rows, since = _stored(rows.mapInArrow(_with_margins(since, len(columns), p.bins), BINNED)), []
            packed.unpersist()
            packed = _kept(rows.mapInArrow(_packed(len(columns)), PACKED).rdd.map(tuple))
    packed.unpersist()
    if model.history:
        model.trees = model.trees[:kept_trees(model.history, p)]
    return model


def kept_trees(history: Sequence[float], p: BoostParams) -> int:
    """Number of trees up to the best value of the metric, the first one of ties."""
    best = max(history) if p.metric == "average_precision" else min(history)
    return list(history).index(best) + 1


def _measure(checks: np.ndarray, p: BoostParams, scale: float) -> float:
    steps, (loss, n) = checks[:-2].reshape(2, -1), checks[-2:].tolist()
    if p.metric == "loss":
        return loss / scale / max(n, 1)
    return binned_average_precision(*steps[:, steps[1] > 0])


def _stored(df: DataFrame) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/boosting-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- scoring -------------------------------------------------------------------------------------------

def score(model: Boosted, df: DataFrame, keep: Sequence[str | Column], name: str = "score") -> DataFrame:
    """Probability of the positive class. The flat arrays travel with the function and are unpacked once per worker."""
    missing = F.lit(float("nan"))
    given = F.array(*[F.coalesce(F.col(c).cast("double"), missing) for c in model.columns])

    def load() -> Callable[[np.ndarray], np.ndarray]:
        return lambda x: _sigmoid(model.margins(x))

    scored = predict_batch_udf(load, return_type=DoubleType(), batch_size=8192, input_tensor_shapes=[[len(model.columns)]])
    return df.select(*keep, scored(given).alias(name))


def top_importances(model: Boosted, spark: SparkSession, k: int = 15) -> DataFrame:
    """(feature, importance): the k columns with the largest share of all gain."""
    rows = sorted(model.importances().items(), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")
