"""Input validation, defaults, row filters and reliability flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.spec import INPUT_BOUNDS, MAX_REQUEST_ROWS, Bound, DriftThresholds


def _violations(bounds: Sequence[Bound], columns: Sequence[str]) -> Column:
    tests = []
    for b in bounds:
        if b.column not in columns:
            if b.default is None:
                tests.append(F.lit(f"{b.column}:missing"))
            continue
        c = F.col(b.column)
        if b.default is None:
            tests.append(F.when(c.isNull(), f"{b.column}:missing"))
        if b.low is not None:
            tests.append(F.when(c < b.low, f"{b.column}:low"))
        if b.high is not None:
            tests.append(F.when(c > b.high, f"{b.column}:high"))
    return F.array_compact(F.array(*tests))


def check_bounds(df: DataFrame, bounds: Sequence[Bound] = INPUT_BOUNDS) -> DataFrame:
    """Add ``violations``, the list of broken rules of each row."""
    return df.withColumn("violations", _violations(bounds, df.columns))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0).drop("violations")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") > 0)


def violation_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def check_request_sizes(df: DataFrame, request: Sequence[str], limit: int = MAX_REQUEST_ROWS) -> DataFrame:
    """(request, n_rows, accepted) with 1 to ``limit`` rows accepted."""
    sizes = df.groupBy(*request).agg(F.count("*").alias("n_rows"))
    return sizes.withColumn("accepted", F.col("n_rows").between(1, limit))


def with_defaults(df: DataFrame, bounds: Sequence[Bound] = INPUT_BOUNDS) -> DataFrame:
    """Fill optional fields, adding those that are absent."""
    out = {}
    for b in bounds:
        if b.default is not None:
            out[b.column] = F.coalesce(F.col(b.column), F.lit(b.default)) if b.column in df.columns else F.lit(b.default)
    return df.withColumns(out)


def only_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_meta(df: DataFrame, meta: Sequence[str]) -> DataFrame:
    return df.drop(*meta)


def columns_of_type(df: DataFrame, kinds: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """Column names by type, from the schema alone."""
    return [n for n, t in df.dtypes if t in kinds and n not in exclude]


def reliability(
    counts: DataFrame, reference_rows: str, current_rows: str, t: DriftThresholds = DriftThresholds()
) -> DataFrame:
    """Flag pairs of samples in which either side is short."""
    smaller = F.least(reference_rows, current_rows)
    return counts.withColumns(
        {"drift_reliable": smaller >= t.min_reliable_rows, "low_data_warning": smaller < t.min_reliable_rows}
    )
