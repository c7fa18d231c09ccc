"""Imputation, winsorising and log scaling. Fitted values are small dictionaries; applying them is one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import clip, nan_to_null
from lotwise.operators.gap_neighbors import nearest_values
from lotwise.operators.quantiles import approx_quantiles, quantile_table


def fit_medians(df: DataFrame, columns: Sequence[str], method: str = "exact", accuracy: int = 10_000) -> dict[str, float]:
    """Median per column, missing values ignored; ``approx`` uses sketches with rank error n / accuracy."""
    if method == "approx":
        rows = approx_quantiles(df, columns, [0.5], accuracy=accuracy).collect()
        found = {r["feature"]: r["q"][0] for r in rows}
    else:
        found = {c: q[0] for c, q in quantile_table(df, columns, [0.5]).items()}
    return {c: found.get(c, 0.0) for c in columns}


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def mode_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n): most frequent value per column; ties go to the smallest value."""
    counted = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    return (
        counted.groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("top"))
        .select("feature", F.col("top.value").alias("value"), (-F.col("top.rank")).alias("n"))
    )


def fit_modes(df: DataFrame, columns: Sequence[str], default: str = "unknown") -> dict[str, str]:
    found = {r["feature"]: r["value"] for r in mode_table(df, columns).collect()}
    return {c: found.get(c, default) for c in columns}


def impute(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Replace missing values by the fitted (or constant) value of each column."""
    present = {c: v for c, v in fill.items() if c in df.columns}
    typed = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(nan_to_null(c) if typed[c] in ("double", "float") else F.col(c), F.lit(v))
            for c, v in present.items()
        }
    )


def clean(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], method: str = "exact") -> DataFrame:
    """Fill columns that have gaps: median for numbers, most frequent value for categories. Three jobs at most."""
    gaps = columns_with_nulls(df, [*numeric, *categorical])
    numbers = [c for c in numeric if c in gaps]
    names = [c for c in categorical if c in gaps]
    fill: dict[str, object] = {}
    if numbers:
        fill.update(fit_medians(df, numbers, method))
    if names:
        fill.update(fit_modes(df, names, "UNKNOWN"))
    return impute(df, fill) if fill else df


def remaining_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: missing cells left over all columns, in one aggregation."""
    return df.agg(
        sum((F.sum(F.col(c).isNull().cast("long")) for c in columns), F.lit(0).cast("long")).alias("remaining_nulls")
    )


def fit_winsor_bounds(
    df: DataFrame, columns: Sequence[str], factor: float = 3.0, strict: bool = False
) -> dict[str, tuple[float, float]]:
    """[Q1 - k IQR, Q3 + k IQR] per column. A column without spread is left alone unless ``strict``:
    clipping a rare 0/1 flag to its quartiles would erase it."""
    bounds = {}
    for c, (q1, q3) in quantile_table(df, columns, [0.25, 0.75]).items():
        spread = q3 - q1
        if spread > 0 or strict:
            bounds[c] = (q1 - factor * spread, q3 + factor * spread)
    return bounds


def winsorize(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items() if c in df.columns})


def clipped_counts(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(feature, lower, upper, n_clipped)."""
    wide = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()])
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(lo).alias("lower"), F.lit(hi).alias("upper"), F.col(c).alias("n_clipped")
        )
        for c, (lo, hi) in bounds.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def log_scale(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """log1p of the value floored at zero."""
    return df.withColumns({c: F.log1p(clip(c, 0.0)) for c in columns if c in df.columns})


def knn_impute(
    train: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    key: str,
    k: int = 5,
    block_rows: int = 8_000,
    query_rows: int = 20_000,
) -> DataFrame:
    """Distance-weighted mean of the k nearest donors that have the value; distances skip missing cells.

    Donors are all training rows; see ``nearest_values`` for how they are searched. Equal distances go
    to the smaller key. A gap without any usable donor gets the training mean (0 without values).
    """
    columns = list(columns)
    found = nearest_values(train, target.where(_any_missing(columns)), columns, key, k, block_rows, query_rows)
    best = Window.partitionBy("row_key", "place").orderBy("distance", "donor")
    near = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    exact = F.max(F.col("distance") == 0)
    weighted = F.sum(F.when(F.col("distance") > 0, F.col("value") / F.col("distance"))) / F.sum(F.when(F.col("distance") > 0, 1 / F.col("distance")))
    filled = near.groupBy("row_key", "place").agg(
        F.when(exact, F.avg(F.when(F.col("distance") == 0, F.col("value")))).otherwise(weighted).alias("value"))
    wide = filled.groupBy("row_key").agg(*[F.max(F.when(F.col("place") == i, F.col("value"))).alias(f"_fill_{i}") for i in range(len(columns))])
    means = train.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in columns]).first()
    joined = target.join(wide, F.col(key).cast("string") == F.col("row_key"), "left")
    values = {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.col(f"_fill_{i}"), F.lit(float(means[c] or 0.0))) for i, c in enumerate(columns)}
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])


def _any_missing(columns: Sequence[str]):
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull() | F.isnan(c)
    return test
