"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir); all but the last return the columns of documents.

Defined cases: null and empty texts are kept by every filter (an empty text links with nothing, holds no benchmark item
and scores as the bias does); for near-duplicates and benchmark items each row is a document of its own, whether its id is
missing or repeated. Further columns are passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import containment, heavylight, packing, pii, toxicity
from lotwise.llm.common import stored, tokenizer_path

TOXIC_FROM = 0.7
SCORE, NUMBER = "toxicity of the text", "number of the row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of TOXIC_FROM or more, learned from the labels of the documents given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.fit(docs, "text", "doc_id", labels, "doc_id", "toxic", F.lit(True))
    return toxicity.score(docs, "text", machine, docs.columns, SCORE).where(F.col(SCORE) < TOXIC_FROM).drop(SCORE)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own: the id, or their place in order of ids and texts if ids repeat or are missing."""
    seen = docs.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if seen[0] == seen[1] == seen[2]:
        return docs.withColumn(NUMBER, F.col("doc_id").cast("long"))
    return stored(docs.sort(F.col("doc_id").asc_nulls_first(), F.md5("text")).withColumn(NUMBER, F.monotonically_increasing_id()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of linked ones: five-word shingles, Jaccard 0.8 or more."""
    rows = _numbered(docs)
    groups = heavylight.jaccard_components(rows, NUMBER, "text", width=5, percent=80)
    gone = stored(groups.where(F.col("component_id") != F.col(NUMBER)).select(NUMBER))
    return rows.join(gone, NUMBER, "left_anti").drop(NUMBER).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain at least 0.8 of a benchmark item's five-word shingles."""
    rows = _numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stored(containment.contained(rows, NUMBER, "text", items, "item_id", "text").select(F.col("doc").alias(NUMBER)).distinct())
    return rows.join(found, NUMBER, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars becomes the new length."""
    done = pii.redact(docs, "text")
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(docs, "doc_id", "text", tokenizer_path())
