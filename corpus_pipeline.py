"""Corpus preparation: toxicity, near-duplicate, benchmark and privacy stages, then packing into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import stages
from lotwise.llm.common import stored

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("n-gram Jaccard join", stages.drop_near_duplicates),
    ("benchmark decontamination", stages.drop_benchmark_leaks),
    ("personal data", stages.redact_personal_data),
    ("packing", stages.pack_sequences),
]

# Learned scores and tokenizer ids are beyond SQL: tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
