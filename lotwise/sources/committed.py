"""Days that count only once they are committed.

A run writes its days to a folder of its own, which nobody reads, and then appends one manifest row a day. The manifest
alone says what a day consists of: the folder of its last committed run. A job that dies before the manifest is written
leaves readers as they were; its days are pending and the next run writes them again. Replacing a day is another run
and another row, so a reader that holds the old manifest still finds the old files.

The manifest has one row for each committed day, so reading it costs days, not rows. Folder names are taken from it:
folders of broken runs are never listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.lifecycle import pending

MANIFEST = "day int, run string, rows bigint, sequence bigint, state string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(day, run, rows, sequence, state): the last commit of every day."""
    commits = _commits(spark, path)
    last = F.max(F.struct("sequence", "run", "rows", "state")).alias("last")
    return commits.groupBy("day").agg(last).select("day", "last.run", "last.rows", "last.sequence", "last.state")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def stage(df: DataFrame, path: str, day: str = "day_number") -> str:
    """Writes the rows where no reader looks; returns the run's name."""
    run = uuid.uuid4().hex
    df.hint("rebalance", F.col(day)).write.partitionBy(day).parquet(f"{path}/data/run={run}")
    return run


def commit(spark: SparkSession, path: str, run: str, schema: T.StructType, days: Sequence[int] | None = None, state: str = "", day: str = "day_number") -> list[int]:
    """Makes the run's days (or those of them in ``days``) the ones that readers see; returns them. One small file is the commit."""
    written = spark.read.schema(schema).parquet(f"{path}/data/run={run}")
    if days is not None:
        written = written.where(F.col(day).isin(*[int(d) for d in days]))
    counted = [(int(r[0]), run, r[1], state) for r in written.groupBy(day).count().collect()]
    sequence = (_commits(spark, path).agg(F.max("sequence")).first()[0] or 0) + 1
    rows = [(d, r, n, sequence, s) for d, r, n, s in counted]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return sorted(r[0] for r in rows)


def write(df: DataFrame, path: str, state: str = "", day: str = "day_number") -> list[int]:
    """Stages and commits the days of ``df``."""
    return commit(df.sparkSession, path, stage(df, path, day), df.schema, None, state, day)


def read(spark: SparkSession, path: str, schema: T.StructType, first: int | None = None, last: int | None = None, day: str = "day_number") -> DataFrame:
    """The committed days of a range; only their folders are listed."""
    found = manifest(spark, path)
    if first is not None:
        found = found.where(F.col("day") >= first)
    if last is not None:
        found = found.where(F.col("day") <= last)
    folders = [f"{path}/data/run={r['run']}/{day}={r['day']}" for r in found.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def pending_days(spark: SparkSession, path: str, requested: Sequence[int]) -> list[int]:
    """Requested days that nobody has committed: where a run resumes."""
    return pending(requested, manifest(spark, path), "day")


def last_state(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The latest committed day and what its run left to resume from."""
    row = manifest(spark, path).orderBy(F.desc("day")).select("day", "state").first()
    return None if row is None else (row["day"], row["state"])


def broken_runs(spark: SparkSession, path: str, schema: T.StructType, day: str = "day_number") -> list[str]:
    """Runs that were staged and never committed; their folders can be removed."""
    whole = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    staged = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(f"{path}/data").select("run").distinct()
    return sorted(r[0] for r in staged.join(_commits(spark, path).select("run").distinct(), "run", "left_anti").collect())
