"""Exact quantiles without holding a whole column in one task.

Groups up to ``group_limit`` values go through Spark's own ``percentile``. Larger groups are narrowed by
histogram passes: each pass keeps, per wanted rank, only the bucket that contains it, so a shuffle never
carries more than buckets x ranks rows per task, and a value that fills a third of the table is one row. For many ranks a
column is cut at sampled values instead (``large_quantiles``): counts tell which ranges hold a rank, only their values are sorted.
Buckets and ranks (at most 2 x ranks rows per large group) are broadcast, so the values themselves stay where
they were read: a join by key would bring all values of a column to one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import long_form, same_key, struct_rows

GROUP_LIMIT = 1_000_000
RANKED_LIMIT = 100_000  # values of a bucket that are sorted; a column has up to two buckets a rank
BUCKETS = 1024
SPLITS = 2048  # ranges of a column, at least
SAMPLED = 64, 1024  # values of a column by which the ranges are chosen, from a batch and from a task


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """(by, feature, n, q) from mergeable sketches; rank error at most n / accuracy."""
    return (
        long_form(df, columns, by)
        .groupBy(*by, "feature")
        .agg(F.count("*").alias("n"), F.percentile_approx("value", list(probs), accuracy).alias("q"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """(by, feature, n, q): linearly interpolated quantiles, missing values ignored."""
    by, probs = list(by), [float(p) for p in probs]
    keys = [*by, "feature"]
    values = long_form(df, columns, by)
    # Counting rows reads no values; only a table beyond the limit needs its groups sized one by one.
    if df.count() <= group_limit:
        return _in_one_pass(values, keys, probs)
    sizes = _sizes(df, columns, by)
    # At most total / group_limit rows come back.
    big = sizes.where(F.col("n") > group_limit).collect()
    if not big:
        return _in_one_pass(values, keys, probs)
    spark = df.sparkSession
    big_keys = spark.createDataFrame(big, sizes.schema)
    large = _by_narrowing(values, big_keys, keys, probs, min(group_limit, RANKED_LIMIT))
    if len(big) == len(columns) and not by:
        return large
    small = values.join(F.broadcast(big_keys), same_key(values, big_keys, keys), "left_anti")
    return _in_one_pass(small, keys, probs).unionByName(large)


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> dict[str, list[float]]:
    """Fitted quantiles by column name: columns x probs numbers."""
    found = {r["feature"]: list(r["q"]) for r in exact_quantiles(df, columns, probs, **kw).collect()}
    return {c: found[c] for c in columns if c in found}


def large_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], range_rows: int = RANKED_LIMIT // 4) -> dict[str, list[float]]:
    """As ``quantile_table``, in three passes for any number of ranks. The sample chooses ranges of about ``range_rows`` values; the
    result does not depend on it."""
    names = list(columns)
    rows = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    sampled = rows.mapInArrow(_sampled, "c int, n long, v array<double>").collect()
    cuts = []
    for i in range(len(names)):
        mine = [r for r in sampled if r["c"] == i]
        size = sum(r["n"] for r in mine)
        # Values stand for as many others as their task has seen for each.
        v, weight = (np.concatenate([np.zeros(0), *x]) for x in ([r["v"] for r in mine], [np.full(len(r["v"]), r["n"] / len(r["v"])) for r in mine]))
        order = np.argsort(v, kind="stable")
        wanted = np.arange(1, m := max(SPLITS, -(-size // range_rows))) / m * size
        cuts.append(np.unique(v[order][np.minimum(np.searchsorted(np.cumsum(weight[order]), wanted), len(v) - 1)]) if len(v) else v)
    counted = rows.mapInArrow(_counted(cuts), "c int, at int, n long").groupBy("c", "at").agg(F.sum("n").alias("n")).collect()
    found: dict[tuple[int, int], float] = {}  # by column and rank
    wanted_at: dict[int, dict[int, tuple[int, list[int]]]] = {}  # by column and range: the rows before it, and the ranks in it
    totals = {}
    for i, cut in enumerate(cuts):
        size = np.zeros(2 * len(cut) + 1, dtype=np.int64)
        for r in counted:
            if r["c"] == i:
                size[r["at"]] = r["n"]
        ends = np.cumsum(size)
        if not (n := int(ends[-1])):
            continue
        totals[i] = n
        for rank in sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}):
            at = int(np.searchsorted(ends, rank, side="right"))
            if at % 2:
                found[i, rank] = float(cut[at // 2])
            else:
                wanted_at.setdefault(i, {}).setdefault(at, (int(ends[at] - size[at]), []))[1].append(rank)
    if wanted_at:
        ranges = {i: np.array(sorted(x)) for i, x in wanted_at.items()}
        inside = rows.mapInArrow(_inside_ranges(cuts, ranges), "c int, at int, v array<double>")
        ranked = inside.groupBy("c", "at").applyInArrow(_at_ranks(wanted_at), "c int, rank long, v double").collect()
        found |= {(r["c"], r["rank"]): r["v"] for r in ranked}

    def interpolated(i: int, p: float) -> float:
        spot = p * (totals[i] - 1)
        low, high = found[i, math.floor(spot)], found[i, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {c: [interpolated(i, float(p)) for p in probs] for i, c in enumerate(names) if i in totals}


def _values(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).drop_null().to_numpy(zero_copy_only=False)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each column the number of values that a task has and some of them, from all of its batches alike."""
    each, most = SAMPLED
    kept: dict[int, list[np.ndarray]] = {}
    size: dict[int, int] = {}
    every: dict[int, int] = {}  # a batch gives fewer once the task has enough
    for batch in batches:
        for i in range(batch.num_columns):
            v = _values(batch, i)
            size[i] = size.get(i, 0) + len(v)
            kept.setdefault(i, []).append(v[::max(1, -(-len(v) // each)) * every.get(i, 1)].copy())
            if sum(map(len, kept[i])) > 2 * most:
                kept[i], every[i] = [np.concatenate(kept[i])[::2]], every.get(i, 1) * 2
    given = [(i, size[i], np.concatenate(x)) for i, x in kept.items() if size[i]]
    yield pa.RecordBatch.from_arrays([pa.array([i for i, *_ in given], pa.int32()), pa.array([n for _, n, _ in given], pa.int64()), pa.array([v for *_, v in given], pa.list_(pa.float64()))], names=["c", "n", "v"])


def _ranges(cut: np.ndarray, v: np.ndarray) -> np.ndarray:
    """2 i + 1 for the i-th cut itself, 2 i for what lies before it and beyond the one before."""
    at = np.searchsorted(cut, v)
    return 2 * at + (np.append(cut, np.nan)[at] == v)


def _counted(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = [np.zeros(2 * len(cut) + 1, dtype=np.int64) for cut in cuts]
        for batch in batches:
            for i, cut in enumerate(cuts):
                size[i] += np.bincount(_ranges(cut, _values(batch, i)), minlength=len(size[i]))
        for i, x in enumerate(size):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(x[at])], names=["c", "at", "n"])

    return run


def _inside_ranges(cuts: list[np.ndarray], ranges: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, wanted in ranges.items():
                v = _values(batch, i)
                at = _ranges(cuts[i], v)
                told = np.zeros(2 * len(cuts[i]) + 1, dtype=bool)
                told[wanted] = True
                mine = np.flatnonzero(told[at])
                order = np.argsort(at[mine], kind="stable")
                v, at = v[mine][order], at[mine][order]
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(v)), pa.int32()), pa.array(v)) if len(v) else pa.array([], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), i, dtype=np.int32)), pa.array(at[starts].astype(np.int32)), lists], names=["c", "at", "v"])

    return run


def _at_ranks(wanted: dict[int, dict[int, tuple[int, list[int]]]]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        c, at = (k.as_py() for k in key)
        start, ranks = wanted[c][at]
        v = np.sort(table.column("v").combine_chunks().flatten().to_numpy())
        return pa.table({"c": pa.array([c] * len(ranks), pa.int32()), "rank": pa.array(ranks, pa.int64()), "v": pa.array(v[np.array(ranks) - start])})

    return run


def _sizes(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    double = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = [
        F.struct(
            F.lit(c).alias("feature"), F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")
        ).alias(f"s{i}")
        for i, (c, v) in enumerate(double.items())
    ]
    wide = df.groupBy(*by).agg(*aggs)
    return struct_rows(wide, by, [F.col(f"s{i}") for i in range(len(columns))])


def _in_one_pass(values: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    exact = F.percentile("value", F.array(*[F.lit(p) for p in probs]))
    return values.groupBy(*keys).agg(F.count("*").alias("n"), exact.alias("q"))


def _by_narrowing(
    values: DataFrame, sizes: DataFrame, keys: list[str], probs: list[float], limit: int
) -> DataFrame:
    spark = values.sparkSession
    positions = F.array(*[F.lit(p) for p in probs])
    targets = sizes.select(
        *keys,
        "n",
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        positions,
                        lambda p: F.array(F.floor(p * (F.col("n") - 1)), F.ceil(p * (F.col("n") - 1))),
                    )
                )
            )
        ).alias("rank"),
    )
    brackets = sizes.select(*keys, "lo", "hi", F.lit(0).cast("long").alias("base"), F.col("n").alias("size"))
    schema = brackets.schema
    current = brackets.collect()
    while True:
        open_rows = [r for r in current if r["lo"] < r["hi"] and r["size"] > limit]
        if not open_rows:
            break
        done = [r for r in current if not (r["lo"] < r["hi"] and r["size"] > limit)]
        found = _narrow(values, spark.createDataFrame(open_rows, schema), targets, keys).collect()
        current = done + found
    settled = [r for r in current if r["lo"] == r["hi"]]
    rest = [r for r in current if r["lo"] < r["hi"]]
    parts = []
    if settled:
        flat = spark.createDataFrame(settled, schema)
        parts.append(
            flat.select(*keys, "lo", F.col("lo").alias("at"), F.col("base").alias("start"), (F.col("base") + F.col("size")).alias("end"))
        )
    if rest:
        parts.append(_ranked(_inside(values, spark.createDataFrame(rest, schema), keys, ["base"]), keys))
    ranked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    hit = same_key(ranked, targets, keys) & targets["rank"].between(ranked["start"], ranked["end"] - 1)
    picked = ranked.join(F.broadcast(targets), hit).select(*[targets[k] for k in keys], targets["n"], "rank", "at")
    by_rank = picked.groupBy(*keys, "n").agg(
        F.map_from_entries(F.collect_set(F.struct("rank", "at"))).alias("value_at")
    )

    def interpolate(p):
        spot = p * (F.col("n") - 1)
        low = F.element_at("value_at", F.floor(spot))
        high = F.element_at("value_at", F.ceil(spot))
        return F.when(low == high, low).otherwise(low + (high - low) * (spot - F.floor(spot)))

    return by_rank.select(*keys, "n", F.transform(positions, interpolate).alias("q"))


def _inside(values: DataFrame, brackets: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    match = same_key(values, brackets, keys) & values["value"].between(brackets["lo"], brackets["hi"])
    return values.join(F.broadcast(brackets), match).select(*[values[k] for k in keys], "value", "lo", "hi", *extra)


def _narrow(values: DataFrame, brackets: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    inside = _inside(values, brackets, keys, ["base"])
    # Halving first keeps the span finite; infinite ends fall out of the quotient as their own buckets.
    share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    bucket = (
        F.when(F.col("value") == F.col("lo"), 0)
        .when(F.col("value") == F.col("hi"), BUCKETS - 1)
        .otherwise(F.least(F.floor(F.nanvl(share, F.lit(0.5)) * BUCKETS), F.lit(BUCKETS - 1)))
    )
    counted = (
        inside.withColumn("bucket", bucket)
        .groupBy(*keys, "lo", "base", "bucket")
        .agg(F.count("*").alias("size"), F.min("value").alias("bucket_lo"), F.max("value").alias("bucket_hi"))
    )
    w = Window.partitionBy(*keys, "lo").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("end", F.col("base") + F.sum("size").over(w)).withColumn(
        "start", F.col("end") - F.col("size")
    )
    hit = same_key(placed, targets, keys) & targets["rank"].between(placed["start"], placed["end"] - 1)
    return placed.join(F.broadcast(targets), hit, "left_semi").select(
        *keys,
        F.col("bucket_lo").alias("lo"),
        F.col("bucket_hi").alias("hi"),
        F.col("start").alias("base"),
        "size",
    )


def _ranked(inside: DataFrame, keys: list[str]) -> DataFrame:
    counted = inside.groupBy(*keys, "lo", "base", "value").agg(F.count("*").alias("size"))
    w = Window.partitionBy(*keys, "lo").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        *keys,
        "lo",
        F.col("value").alias("at"),
        (F.col("base") + F.sum("size").over(w) - F.col("size")).alias("start"),
        (F.col("base") + F.sum("size").over(w)).alias("end"),
    )
