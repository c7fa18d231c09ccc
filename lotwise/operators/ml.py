"""Models, projections and outlier detectors on feature rows."""

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import ratio, stable_key
from lotwise.operators.features import fit_moments, standardize, with_class_weight
from lotwise.operators.quantiles import quantile_table
from lotwise.operators.running import hash_ranked, sample_exact


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def from_array(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


# --- classifiers ---------------------------------------------------------------------------------

def fit_logistic(df: DataFrame, label: str, c: float = 1.0, iterations: int = 1000) -> Model:
    """Balanced class weights; the penalty equals inverse strength ``c`` on the summed loss."""
    weighted = with_class_weight(df, label)
    total = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        labelCol=label, weightCol="weight", maxIter=iterations, regParam=1.0 / (c * total), standardization=False
    ).fit(weighted)


def score_rows(model: Model, df: DataFrame, keep: Sequence[str], name: str = "score") -> DataFrame:
    """Probability of the positive class."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(name))


def score_foreign(
    df: DataFrame, columns: Sequence[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]], name: str = "score"
) -> DataFrame:
    """Score with a model Spark does not know. ``load`` runs once per task and returns a function on matrices."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        predict = load()
        for parts in batches:
            yield pd.Series(np.asarray(predict(np.column_stack([p.to_numpy(float) for p in parts])), dtype=float))

    return df.withColumn(name, scored(*[F.col(c).cast("double") for c in columns]))


# --- projections and clusters ----------------------------------------------------------------------

def fit_pca(df: DataFrame, k: int = 10, features: str = "features") -> Model:
    return PCA(k=k, inputCol=features, outputCol="components").fit(df)


def explained_variance(model: Model, df: DataFrame) -> DataFrame:
    """(component, share, cumulative)."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    shares = df.sparkSession.createDataFrame(rows, "component int, share double")
    w = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return shares.withColumn("cumulative", F.sum("share").over(w))


def components_for(variance: DataFrame, share: float = 0.9) -> DataFrame:
    """Fewest components that reach ``share``."""
    return variance.where(F.col("cumulative") >= share).agg(F.min("component").alias("components"))


def top_loadings(model: Model, columns: Sequence[str], df: DataFrame, k: int = 5) -> DataFrame:
    """(component, place, feature, loading): largest absolute loadings of each component."""
    matrix = model.pc.toArray()
    rows = [(j + 1, columns[i], float(matrix[i, j])) for i in range(matrix.shape[0]) for j in range(matrix.shape[1])]
    loads = df.sparkSession.createDataFrame(rows, "component int, feature string, loading double")
    w = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    return loads.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def project(model: Model, df: DataFrame, keep: Sequence[str], first: int | None = None) -> DataFrame:
    """Rows with ``pcs``, an array of their leading components."""
    pcs = vector_to_array("components")
    return model.transform(df).select(*keep, (F.slice(pcs, 1, first) if first else pcs).alias("pcs"))


def kmeans(df: DataFrame, array: str = "pcs", k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``cluster``."""
    vectors = from_array(df, array, "_v")
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(vectors)
    return model.transform(vectors).drop("_v")


def cluster_fail_rate(df: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("fail_rate"))


# --- outliers --------------------------------------------------------------------------------------

def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0, name: str = "z_outlier") -> DataFrame:
    """Rows with any value beyond ``limit`` population deviations."""
    moments = fit_moments(df, columns)
    hit = F.lit(False)
    for c, (m, s) in moments.items():
        hit = hit | (F.coalesce(F.abs((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)), F.lit(0.0)) > limit)
    return df.withColumn(name, hit)


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, upper_only: bool = False, name: str = "iqr_outlier"
) -> DataFrame:
    hit = F.lit(False)
    for c, (q1, q3) in quantile_table(df, columns, [0.25, 0.75]).items():
        reach = factor * (q3 - q1)
        test = F.col(c) > q3 + reach
        if not upper_only:
            test = test | (F.col(c) < q1 - reach)
        hit = hit | F.coalesce(test, F.lit(False))
    return df.withColumn(name, hit)


def detector_agreement(df: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(kind, n, n_fail, caught_share) for both / only a / only b / neither."""
    kind = (
        F.when(F.col(a) & F.col(b), "both").when(F.col(a), "only_a").when(F.col(b), "only_b").otherwise("neither")
    )
    counts = df.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("n_fail"))
    whole = Window.partitionBy(F.lit(0))
    return counts.withColumn("caught_share", ratio(F.col("n_fail"), F.sum("n_fail").over(whole).cast("double")))


_LEAF = -1


def isolation_forest(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], contamination: float = 0.02, trees: int = 100,
    sample: int = 256, seed: int = 42,
) -> DataFrame:
    """Adds ``anomaly`` (lower is more unusual) and ``is_outlier`` (the lowest ``contamination`` share).

    Each tree grows from its own ``sample`` rows in its own task; the forest is trees x sample nodes at most,
    so it travels to the scoring tasks whatever the size of the table.
    """
    columns = list(columns)
    chosen = sample_exact(df.select(*columns, *key), trees * sample, key, seed)
    numbered = hash_ranked(chosen, stable_key(key, f"{seed}-tree"), rank="_r").withColumn(
        "tree", F.pmod(F.col("_r"), F.lit(trees)).cast("int")
    )
    schema = "tree int, node int, feature int, cut double, below int, above int, depth double"

    def grow(batch: pd.DataFrame) -> pd.DataFrame:
        tree = int(batch["tree"].iloc[0])
        x = batch.sort_values("_r")[columns].to_numpy(float)
        return pd.DataFrame(_grow(x, np.random.default_rng(seed * 100_003 + tree), tree), columns=[c.split()[0] for c in schema.split(", ")])

    nodes = numbered.groupBy("tree").applyInPandas(grow, schema).toPandas()
    size = min(sample, max(2, int(round(chosen.count() / trees))))
    forest = [
        (t["feature"].to_numpy(), t["cut"].to_numpy(), t["below"].to_numpy(), t["above"].to_numpy(), t["depth"].to_numpy())
        for _, t in nodes.sort_values(["tree", "node"]).groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(forest)
    norm = _average_path(size)

    @F.pandas_udf("double")
    def anomaly(*parts: pd.Series) -> pd.Series:
        x = np.column_stack([p.to_numpy(float) for p in parts])
        total = sum((_path(x, t) for t in shared.value), np.zeros(len(x)))
        return pd.Series(-np.power(2.0, -total / len(shared.value) / norm))

    scored = df.withColumn("anomaly", anomaly(*[F.col(c).cast("double") for c in columns]))
    cut = quantile_table(scored, ["anomaly"], [contamination])["anomaly"][0]
    return scored.withColumn("is_outlier", F.col("anomaly") < F.lit(cut))


def _average_path(n: int) -> float:
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, tree: int) -> list[tuple]:
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[tuple] = []
    pending = [(np.arange(len(x)), 0, None, None)]
    while pending:
        rows, depth, parent, side = pending.pop()
        me = len(nodes)
        if parent is not None:
            old = nodes[parent]
            nodes[parent] = (*old[:4], me, old[5], old[6]) if side == "below" else (*old[:5], me, old[6])
        low, high = x[rows].min(0), x[rows].max(0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_features):
            nodes.append((tree, me, _LEAF, 0.0, me, me, depth + _average_path(len(rows))))
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        nodes.append((tree, me, f, cut, me, me, 0.0))
        left = x[rows, f] < cut
        pending += [(rows[~left], depth + 1, me, "above"), (rows[left], depth + 1, me, "below")]
    return nodes


def _path(x: np.ndarray, tree: tuple) -> np.ndarray:
    feature, cut, below, above, depth = tree
    at = np.zeros(len(x), dtype=int)
    rows = np.arange(len(x))
    while True:
        f = feature[at]
        inner = f != _LEAF
        if not inner.any():
            return depth[at]
        value = x[rows, np.where(inner, f, 0)]
        step = np.where(value < cut[at], below[at], above[at])
        at = np.where(inner, step, at)


def scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardised copy of the columns, for projections and distances."""
    return standardize(df, fit_moments(df, columns))
