"""Landing JSON messages as Parquet with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotwise.spec import PRODUCTION_DDL

BATCH_MESSAGES = 50_000


def kafka_source(
    spark: SparkSession, servers: str, topic: str, per_batch: int = BATCH_MESSAGES, starting: str = "earliest", **options: str
) -> DataFrame:
    """Message stream with a source-side rate cap. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", per_batch)
        .options(**options)
        .load()
    )


def kafka_range(spark: SparkSession, servers: str, topic: str, ending: str = "latest", **options: str) -> DataFrame:
    """Bounded batch read of a topic."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", ending)
        .options(**options)
        .load()
    )


def file_source(
    spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "json", files_per_batch: int = 100, **options: str
) -> DataFrame:
    """Stream over the files of a folder; at most ``files_per_batch`` new files per micro-batch."""
    return (
        spark.readStream.format(kind)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**options)
        .load(path)
    )


def parse_messages(messages: DataFrame, schema: str = PRODUCTION_DDL, value: str = "value") -> DataFrame:
    """Typed columns plus ``_corrupt``, the body of a message that is not a JSON object of the schema."""
    full = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    body = F.from_json(
        F.col(value).cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    return messages.select(body.alias("m"), F.octet_length(F.col(value).cast("string")).alias("_bytes")).select("m.*", "_bytes")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt").isNull()).drop("_corrupt", "_bytes")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("value"))


def land(
    stream: DataFrame, path: str, checkpoint: str, day: str = "day_number", bounded: bool = True, name: str | None = None
) -> StreamingQuery:
    """Append micro-batches to a table partitioned by day; the checkpoint makes each row land once.

    ``bounded`` drains what is there and stops; otherwise the query keeps running.
    """
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(day).outputMode("append")
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime="10 seconds")).start()


def land_with_quarantine(
    messages: DataFrame, path: str, quarantine: str, checkpoint: str, schema: str = PRODUCTION_DDL, day: str = "day_number",
    bounded: bool = True,
) -> StreamingQuery:
    """Good rows to the day table, malformed messages to a quarantine folder, from one read of each batch.

    Both outputs are keyed by batch, so a batch that runs twice after a failure replaces its own files.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch, schema).withColumn("batch", F.lit(batch_id))
        parsed.persist()
        try:
            for rows, target, keys in (
                (good_rows(parsed), path, ["batch", day]),
                (bad_rows(parsed).withColumn("batch", F.lit(batch_id)), quarantine, ["batch"]),
            ):
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target)
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime="10 seconds")).start()


def batch_labels(landed: DataFrame, batch: str = "batch", day: str = "day_number") -> DataFrame:
    """(batch, label, n_rows): the most frequent day of each micro-batch, smallest on ties, as its display name."""
    counted = landed.groupBy(batch, day).agg(F.count("*").alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("rank"), F.col(day).alias("day"))).alias("top")
    return counted.groupBy(batch).agg(top, F.sum("n").alias("n_rows")).select(
        batch, F.format_string("day_%02d_batch_%04d", F.col("top.day").cast("int"), F.col(batch).cast("int")).alias("label"), "n_rows"
    )


def run_stats(query: StreamingQuery) -> dict:
    """Rows, batches and seconds of a finished query."""
    done = query.recentProgress
    rows = sum(p.numInputRows for p in done)
    millis = sum(p.batchDuration for p in done)
    return {
        "messages": rows,
        "batches": sum(1 for p in done if p.numInputRows),
        "seconds": millis / 1000.0,
        "messages_per_sec": rows / (millis / 1000.0) if millis else 0.0,
    }
