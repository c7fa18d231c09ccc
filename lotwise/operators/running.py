"""Ordered running totals and exact ranks that do not funnel a table through one sorted partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import key_fraction, same_key, stable_key

ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 4096
SORTED_ROWS = 50_000
DIGITS, MD5_DIGITS = 3, 32  # hexadecimal digits counted at a time, and in all
ROWS_PER_SLOT = 100_000


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add inclusive running sums (output name -> summed column) in ascending order of a numeric column.

    ``df`` should already be grouped on (by, order). It is cut into value ranges of similar size; totals of
    the ranges (a handful of rows) are accumulated first and added to the totals within each range. Null comes first and
    NaN last, whatever the number of ranges.
    """
    by = list(by)
    n, edges = _range_edges(df, order, rows_per_bucket)
    if n <= rows_per_bucket or not edges:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({out: F.sum(src).over(w) for out, src in sums.items()})
    ranged = _in_ranges(df, order, edges)
    keys = [*by, "_range"]
    totals = ranged.groupBy(*keys).agg(*[F.sum(s).alias(f"_t_{o}") for o, s in sums.items()])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({o: F.sum(s).over(inside) for o, s in sums.items()})
    joined = local.join(offsets, same_key(local, offsets, keys))
    kept = [c for c in df.columns if c not in sums]
    return joined.select(
        *[local[c] for c in kept], *[(local[o] + F.col(f"_o_{o}")).alias(o) for o in sums]
    )


def cut_into_ranges(df: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``_range``, the number of a value range of a numeric column that holds about ``rows_per_bucket`` rows."""
    return _in_ranges(df, order, _range_edges(df, order, rows_per_bucket)[1])


def _in_ranges(df: DataFrame, order: str, edges: list[float]) -> DataFrame:
    splits = [-float("inf"), *edges, float("inf")]
    if not edges:
        return df.withColumn("_range", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="keep").transform(
        df.withColumn("_order", F.col(order).cast("double"))
    ).drop("_order")


def _range_edges(df: DataFrame, order: str, rows_per_bucket: int) -> tuple[int, list[float]]:
    n = df.count()
    wanted = min(MAX_BUCKETS, -(-n // rows_per_bucket))
    if wanted <= 1:
        return n, []
    probs = ", ".join(f"{i / wanted}D" for i in range(1, wanted))
    cut = F.expr(f"percentile_approx(cast(`{order}` as double), array({probs}), {4 * wanted})")
    found = df.agg(cut.alias("e")).first()["e"] or []
    return n, sorted({e for e in found if abs(e) != float("inf")})


def hash_ranked(df: DataFrame, key: Column, by: Sequence[str] = (), rank: str = "rank", rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Exact 1-based rank of every row in seeded random order within ``by``.

    The order is an md5 text, so its leading digits already spread each group over equal-sized slots, as many as the
    table needs. The group is spelled as one text that is never null, so ranking and the join with the slots' offsets
    share one exchange of the rows.
    """
    by = list(by)
    slots = max(1, -(-df.count() // rows_per_slot))
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    hashed = df.withColumns({"_key": key, "_group": group}).withColumn("_slot", F.floor(key_fraction(F.col("_key")) * slots))
    inside = Window.partitionBy("_group", "_slot").orderBy("_key")
    local = hashed.withColumn("_local", F.row_number().over(inside))
    sizes = hashed.groupBy("_group", "_slot").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("_group").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_group", "_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    joined = local.join(offsets, ["_group", "_slot"])
    return joined.select(*df.columns, (F.col("_local") + F.col("_before")).alias(rank))


def sample_exact(df: DataFrame, n: int, key_columns: Sequence[str], seed: int = 42, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """Exactly n seeded rows (all rows when fewer), those with the smallest md5 of their key.

    The cut is found digit by digit: rows are counted by the next digits of their md5 within the slot that holds the cut,
    until that slot has ``sorted_rows`` rows or fewer. Only those are sorted, whatever n and the table; rows before the
    slot are taken as they are. Rows with the same key share all digits, so a key that more rows have is sorted whole.
    """
    hashed = df.withColumn("_key", stable_key(key_columns, seed))
    taken, prefix = 0, ""
    while True:
        inside = hashed.where(F.startswith("_key", F.lit(prefix))) if prefix else hashed
        digits = len(prefix) + DIGITS
        counts = sorted((r["_slot"], r["n"]) for r in inside.groupBy(F.substring("_key", 1, digits).alias("_slot")).agg(F.count("*").alias("n")).collect())
        for slot, size in counts:
            if taken + size > n:
                break
            taken += size
        else:
            return df
        prefix = slot
        if size <= sorted_rows or len(prefix) >= MD5_DIGITS:
            break
    before = hashed.where(F.substring("_key", 1, len(prefix)) < prefix)
    cut = hashed.where(F.startswith("_key", F.lit(prefix)))
    place = F.row_number().over(Window.partitionBy(F.substring("_key", 1, len(prefix))).orderBy("_key"))
    cut = cut.withColumn("_pos", place).where(F.col("_pos") <= n - taken).drop("_pos")
    return before.unionByName(cut).drop("_key")
