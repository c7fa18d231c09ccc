"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; null stays null (``greatest`` alone would return the bound)."""
    c = as_column(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(c.isNotNull(), out)


def ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """Quotient, or ``otherwise`` where the denominator is zero or missing."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(otherwise))


def nan_to_null(c: Column | str) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def is_finite(c: Column | str) -> Column:
    c = as_column(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def edge_bin(value: Column, inner_edges: Sequence[float | Column]) -> Column:
    """Number of inner edges at or below the value: bins [a, b), open outer ends, repeated edges allowed."""
    return reduce(lambda a, b: a + b, [(value >= e).cast("int") for e in inner_edges], F.lit(0))


def width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of an equal-width histogram on [low, high], last bin closed, null outside.

    The quotient can land one bin off an edge in floating point, so it is corrected against the edges.
    """
    step = (high - low) / F.lit(bins)
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    moved = (
        F.when(value < low + guess * step, guess - 1)
        .when((guess < bins - 1) & (value >= low + (guess + 1) * step), guess + 1)
        .otherwise(guess)
    )
    return F.when((value >= low) & (value <= high), moved)


def right_closed_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """1-based bin of (a, b] intervals; the lower end itself and anything outside is null."""
    index = F.ceil((value - F.lit(low)) / F.lit(high - low) * bins).cast("int")
    return F.when((value > low) & (value <= high), index)


def weighted_class(*rules: tuple[Column, str], otherwise: str) -> Column:
    """First matching rule names the class."""
    out = None
    for test, name in rules:
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def stable_key(columns: Sequence[Column | str], seed: int | str = 42) -> Column:
    """Seeded pseudo-random order that does not depend on partitioning or engine."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def key_fraction(key: Column) -> Column:
    """First 32 bits of an md5 text as a number in [0, 1)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def long_form(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), name: str = "feature", value: str = "value"
) -> DataFrame:
    """One row per row and column, as doubles, missing values dropped. Reads only the named columns."""
    narrow = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = narrow.unpivot(list(by), list(columns), name, value)
    return long.where(F.col(value).isNotNull() & ~F.isnan(value))


def struct_rows(df: DataFrame, keep: Sequence[str], rows: Sequence[Column]) -> DataFrame:
    """Turn several structs of one wide row into rows."""
    return df.select(*keep, F.inline(F.array(*rows)))


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    tests = [left[k].eqNullSafe(right[k]) for k in keys]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join on equal names that keeps the left keys. The right keys are renamed first, so it is safe
    when ``right`` was derived from ``left``."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    tests = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, tests, F.lit(True)), how)
    return joined.drop(*[f"_right_{k}" for k in keys])


# Coefficients of the rational approximation of the normal distribution (Hart 1968, as given by West 2005).
NORMAL_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
NORMAL_BOTTOM = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, exact to about 1e-14."""
    a = F.abs(z)
    top, bottom = (reduce(lambda total, c: total * a + c, given[1:], F.lit(given[0])) for given in (NORMAL_TOP, NORMAL_BOTTOM))
    fraction = reduce(lambda total, k: a + F.lit(float(k)) / total, (4, 3, 2, 1), a + 0.65)
    tail = F.exp(-a * a / 2) * F.when(a < 7.07106781186547, top / bottom).otherwise(1 / (fraction * 2.506628274631))
    return F.when(z > 0, 1 - tail).otherwise(tail)
