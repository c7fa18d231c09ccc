"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification, in column expressions.

Texts become sets of hashed runs of `width` lower-cased words (letters and digits); an item with fewer words is one
shorter run, searched with that length. Items are partitioned by size: an item of n shingles keeps its
floor((1 - threshold) * n) + 1 smallest MinHash values, and a partition's largest kept value bounds what a document
has to look up for it. A document that contains the threshold's share of an item misses too few shingles to miss all
of those, so the search has no false negatives whatever the length of the document. Candidates are verified by exact
containment of the shingle sets.

The sketches of all items are sent to the tasks only while they have at most `broadcast_rows` rows; a larger benchmark
is joined by shuffle. Candidates are written to the shared folder before the verifying join.

Defined cases: null and empty documents contain nothing; items without words are never found; repeated ids are one
document or item with the union of their shingles; repeated shingles count once. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def runs(words: str, width: int) -> Column:
    """Hashes of all runs of `width` words of the array column `words`; null if there are fewer."""
    args = ", ".join(f"{words}[i + {j}]" for j in range(width))
    return F.expr(f"if(size({words}) >= {width}, transform(sequence(0, size({words}) - {width}), i -> xxhash64({width}, {args})), null)")


def shingle_rows(df: DataFrame, key: str, text: str, widths: list[int], own_width: int | None = None) -> DataFrame:
    """(key, h): one row a run, for each of the widths; with own_width, runs as long as the text but at most that."""
    words = df.select(F.col(key).alias("key"), word_hashes(F.col(text)).alias("w")).where("size(w) > 0")
    if own_width is None:
        every = F.flatten(F.filter(F.array(*[runs("w", w) for w in widths]), lambda a: a.isNotNull())) if len(widths) > 1 else runs("w", widths[0])
        return words.select("key", F.explode(every).alias("h"))
    own = None
    for width in range(own_width, 0, -1):
        own = runs("w", width) if own is None else F.coalesce(own, runs("w", width))
    return words.select("key", F.least(F.size("w"), F.lit(own_width)).alias("width"), F.explode(own).alias("h"))


def contained(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, width: int = 5, threshold: float = 0.8,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """(doc, item, n_common, n_item) for each document that contains at least `threshold` of an item's shingles."""
    item_rows = shingle_rows(items, item_key, item_text, [], width).distinct()
    per_item = Window.partitionBy("key")
    ranked = stored(item_rows.select(
        F.col("key").alias("item"), "width", "h", F.count("*").over(per_item).cast("int").alias("n_item"),
        F.row_number().over(per_item.orderBy(F.xxhash64("h"), "h")).alias("place")))
    kept = ranked.where(F.col("place") <= F.floor(F.round((1 - F.lit(threshold)) * F.col("n_item"), 9)) + 1)
    sketch = kept.select("item", "h", F.log2("n_item").cast("int").alias("size_class"))
    shape = kept.agg(F.count("*"), F.collect_set("width"), F.max(F.xxhash64("h"))).first()
    widths = sorted(shape[1]) or [width]
    bound = shape[2] if shape[2] is not None else -(1 << 63)
    looked_up = shingle_rows(docs, key, text, widths).where(F.xxhash64("h") <= bound)
    small = shape[0] <= broadcast_rows
    partition_bounds = sketch.groupBy("size_class").agg(F.max(F.xxhash64("h")).alias("class_bound"))
    sketch = sketch.join(partition_bounds, "size_class").select("item", "h", "class_bound")
    found = looked_up.join(F.broadcast(sketch) if small else sketch, "h").where(F.xxhash64("h") <= F.col("class_bound"))
    candidates = stored(found.select("key", "item").distinct())
    chosen = docs.select(F.col(key).alias("doc"), F.col(text).alias("body")).join(
        candidates.select("key").distinct(), F.col("doc") == F.col("key"), "left_semi")
    shingles = shingle_rows(chosen, "doc", "body", widths).join(F.broadcast(ranked.select("item", "h", "n_item")) if small else ranked.select(
        "item", "h", "n_item"), "h").select(F.col("key").alias("doc"), "item", "h", "n_item").distinct()
    common = shingles.groupBy("doc", "item").agg(F.count("*").alias("n_common"), F.max("n_item").cast("long").alias("n_item"))
    common = common.where(F.col("n_common") >= F.lit(threshold) * F.col("n_item") - 1e-9)
    return common.join(candidates.select(F.col("key").alias("doc"), "item"), ["doc", "item"], "left_semi")
