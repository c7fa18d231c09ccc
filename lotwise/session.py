"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Wide projections compile to methods beyond the 8000 bytecodes the JVM is willing to JIT, which makes fused
# code ten times slower than unfused code. This limit makes Spark unfuse exactly those stages.
PLAN_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the plan settings to a session somebody else built, unless it already chose its own."""
    for key, value in PLAN_SETTINGS.items():
        if spark.conf.get(key, None) in (None, "65535"):
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "lotwise", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution on, UTC timestamps, dynamic partition overwrite; no fixed partition counts."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **PLAN_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, given: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. In local mode, where one machine does everything, a private folder
    stands in for it; a cluster without it is an error, because executors would not see each other's files."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="lotwise-checkpoint-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
