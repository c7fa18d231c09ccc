"""Reading and writing measurement tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.lifecycle import missing_days, pending
from lotwise.session import cut_lineage
from lotwise.spec import PRODUCTION_DDL

SPLITS = ("train", "val", "test", "unseen")


def read_days(
    spark: SparkSession, path: str, first: int, last: int, day: str = "day_number", schema: str | T.StructType | None = None
) -> DataFrame:
    """Day range of a table partitioned by day; only the partitions of the range are listed and read."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path).where(F.col(day).between(first, last))
    if df.isEmpty():
        raise FileNotFoundError(f"no rows for days {first}-{last} in {path}")
    return df


def read_day_files(spark: SparkSession, folder: str, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Files ``day_NN.parquet`` of a range, and the days of the range that have none."""
    names = ",".join(f"day_{d:02d}" for d in range(first, last + 1))
    df = spark.read.parquet(f"{folder}/{{{names}}}.parquet")
    seen = F.regexp_extract(F.col("_metadata.file_path"), r"day_(\d+)", 1).cast("int")
    return df, missing_days(df.select(seen.alias("day_number")), first, last)


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Cast to the declared types and order; absent columns become null. Undoes the widening of a JSON hop."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in declared.fields
        ]
    )


def read_landing(spark: SparkSession, path: str, schema: str | T.StructType = PRODUCTION_DDL) -> DataFrame:
    """All landed micro-batches with their schemas merged and cast to the declared one."""
    merged = spark.read.option("mergeSchema", True).option("recursiveFileLookup", False).parquet(path)
    return conform(merged, schema)


def split_by_column(df: DataFrame, names: Sequence[str] = SPLITS, column: str = "split") -> dict[str, DataFrame]:
    """One table cut by its split column."""
    return {n: df.where(F.col(column) == n) for n in names}


def write_days(df: DataFrame, path: str, day: str = "day_number", compression: str = "snappy", rows_per_file: int = 20_000_000) -> None:
    """Replace exactly the days present in ``df``.

    Rows are rebalanced by day at run time: small days share a task, a day that holds most rows is split.
    """
    (
        df.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(day)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_stats(df: DataFrame, path: str, day: str = "day_number") -> None:
    """A small statistics table: one file per day partition, days already there are replaced."""
    (
        df.repartition(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_preview(df: DataFrame, path: str, order: Sequence[str], rows: int = 1000) -> None:
    """First rows in a stable order as CSV with a header."""
    df.orderBy(*order).limit(rows).write.mode("overwrite").option("header", True).csv(path)


def append_reports(df: DataFrame, path: str, day: str = "day_number", kind: str = "json") -> None:
    """Report rows, one partition per day, replaced when the day is reported again."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day)
    writer.format(kind).save(path)


def write_features(df: DataFrame, path: str, columns: Sequence[str], label: str, split: str = "split") -> None:
    """Feature matrix: one array column in the order of ``columns``; the names travel in its metadata."""
    packed = F.array(*[F.col(c).cast("double") for c in columns]).alias("features", metadata={"names": list(columns)})
    df.select(packed, F.col(label).cast("int").alias("label"), F.col(split).alias("split")).write.mode("overwrite").partitionBy(
        "split"
    ).parquet(path)


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    df = spark.read.parquet(path)
    return df, list(df.schema["features"].metadata.get("names", []))


def pending_days(requested: Sequence[int], done: DataFrame, day: str = "day_number") -> list[int]:
    """Requested days that the output does not have yet: where a run resumes."""
    return pending(requested, done, day)


TIMELINE_DDL = (
    "start_time STRING, simulation_start_date STRING, simulation_end_date STRING, rows_per_day BIGINT, total_days INT, "
    "days ARRAY<STRUCT<day: INT, date: STRING, scenario: STRING, model_version: STRING, events: ARRAY<STRING>, "
    "parquet_mb: DOUBLE, drift: STRUCT<analysis_day: INT, features_critical: INT, features_warning: INT, "
    "feature_psi: MAP<STRING, DOUBLE>, should_retrain: BOOLEAN, drift_reliable: BOOLEAN, low_data_warning: STRING, "
    "ref_rows: BIGINT, analysis_rows: BIGINT>, s3_uploaded: INT, elapsed_sec: DOUBLE>>, "
    "total_elapsed_sec DOUBLE, total_elapsed_min DOUBLE, retrain_events ARRAY<STRUCT<day: INT, new_model: STRING>>"
)


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    """One row per day of a nested run timeline."""
    doc = spark.read.schema(TIMELINE_DDL).option("multiLine", True).json(path)
    return doc.select(F.explode("days").alias("d")).select("d.*")


def read_drift_reports(spark: SparkSession, path: str) -> DataFrame:
    """Daily report files (one JSON document each) as rows keyed by day."""
    ddl = (
        "analysis_day INT, features_critical INT, features_warning INT, feature_psi MAP<STRING, DOUBLE>, "
        "should_retrain BOOLEAN, drift_reliable BOOLEAN, ref_rows BIGINT, analysis_rows BIGINT"
    )
    return spark.read.schema(ddl).option("multiLine", True).json(path)


def read_json_leaves(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value): every leaf of the JSON documents of a folder under its dotted key, whatever keys they have.

    Documents are variants, so no schema is read ahead and none is declared: objects and arrays are opened level by level
    until only leaves are left. Array elements count from 0. Null leaves have a null value; text that is not JSON and
    empty objects and arrays have no leaves.
    """
    text = spark.read.option("wholetext", True).text(path)
    level = text.select(F.col("_metadata.file_path").alias("file"), F.lit("").alias("key"), F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    leaves = []
    while True:
        kind = F.schema_of_variant("v")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        leaves.append(level.where(~nested).select("file", "key", F.try_variant_get("v", "$", "string").alias("value")))
        deeper = cut_lineage(level.where(nested))
        if deeper.isEmpty():
            break
        opened = deeper.withColumnsRenamed({"key": "_above", "v": "_whole"}).lateralJoin(spark.tvf.variant_explode(F.col("_whole").outer()))
        level = opened.select("file", F.concat_ws(".", F.nullif("_above", F.lit("")), F.coalesce("key", F.col("pos").cast("string"))).alias("key"), F.col("value").alias("v"))
    return reduce(DataFrame.unionByName, leaves)


def json_schema(spark: SparkSession, path: str) -> str:
    """The one schema that all documents of a folder fit into."""
    text = spark.read.option("wholetext", True).text(path)
    return text.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]


# --- messages -----------------------------------------------------------------------------------

def as_messages(df: DataFrame, key: str = "tester_id") -> DataFrame:
    """(key, value) with nulls kept in the JSON body; equal keys keep their order within a partition."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key"), body.alias("value"))


def publish(df: DataFrame, servers: str, topic: str, key: str = "tester_id", **options: str) -> None:
    """Write messages to a broker. Needs the Kafka connector on the class path."""
    as_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(
        **options
    ).save()


def message_stats(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Messages and bytes, in total or by group."""
    return messages.groupBy(*by).agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("value")).alias("bytes"), F.countDistinct("key").alias("keys")
    )
