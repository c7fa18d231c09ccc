"""Helpers the operators share: shared-folder tables, batch sizes, hash fractions, connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import shared_folder

BATCH_BYTES = 8 << 20
FRACTION_STEPS = 1 << 30
HEAVY_KEYS = 4096


def stored(df: DataFrame, *sort: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there and lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    if sort:
        df = df.sortWithinPartitions(*sort)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Python call holds: long texts make batches of fixed row counts arbitrarily large."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path() -> str:
    """Place of the public 50k byte-level vocabulary; LLM_TOKENIZER names another file."""
    if "LLM_TOKENIZER" in os.environ:
        return os.environ["LLM_TOKENIZER"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def crc_mod(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo `modulus`; null keys give null."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus)


def hash_share(key: Column, share: Column | float) -> Column:
    """True for about `share` of the keys, the same ones on every run."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(FRACTION_STEPS)) < F.lit(share) * FRACTION_STEPS


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def pieces(texts: list[str], limit: int, overlap: int) -> Iterator[tuple[list[int], list[str]]]:
    """Groups (row, text) up to `limit` characters; longer texts are cut into slices that overlap by `overlap`."""
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text)), limit):
            part = text[start:start + limit + overlap] if len(text) > limit else text
            if parts and size + len(part) > limit:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, parts


def numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """(key, text) with unique keys and null texts empty; where ids repeat or are missing, rows are numbered in order of
    id (null first), then of the text's digest, and (number, key) tells the ids."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = rows.agg(F.count("*"), F.count("key"), F.count_distinct("key")).first()
    if seen[0] == seen[1] == seen[2]:
        return rows, None
    rows = stored(rows.sort(F.col("key").asc_nulls_first(), F.md5("text")).withColumn("number", F.monotonically_increasing_id()))
    return rows.select(F.col("number").alias("key"), "text"), rows.select("number", "key")


def join_skewed(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Joins rows with `keyed`, which has one row a key and in `weight` how many of the rows have it; both are stored
    tables. A key with one in HEAVY_KEYS of all rows or more is sent to the tasks: there are at most HEAVY_KEYS such keys.
    The others go by exchange, where none of them fills a task. how: inner, left, left_semi or left_anti; keys are not null."""
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    heavy, light = (keyed.where(test) for test in (F.col(weight) * HEAVY_KEYS >= total, F.col(weight) * HEAVY_KEYS < total))
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on, how)
    return rest if how == "left_anti" else rows.join(F.broadcast(heavy), on, "inner" if how == "left" else how).unionByName(rest)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest id reachable from each id that has an edge: columns (id, component).

    Alternating large-star and small-star steps on the edges alone. Each step is one pre-aggregated minimum and one
    join, so a hub is never one group; the edge set is written to the shared folder after each round.
    """
    def minimum_star(pairs: DataFrame, larger_only: bool) -> DataFrame:
        around = pairs.select(F.col("u"), F.col("v"))
        both = around if not larger_only else around.unionByName(around.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))
        joined = both.join(least, F.col("u") == F.col("hub"))
        if larger_only:  # neighbours above the hub move to its minimum
            moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # the hub and its neighbours below it move to the minimum
            moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select(F.col("hub").alias("u"), F.col("m").alias("v")))
        return moved.where(F.col("u") != F.col("v")).distinct()

    current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    state = None
    while True:
        current = stored(minimum_star(minimum_star(current, True), False))
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    ids = current.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    return ids.unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()).groupBy("id").agg(
        F.min("component").alias("component"))
