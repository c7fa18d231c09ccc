"""Folders for queries that write before they read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from lotwise.session import shared_folder


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, which every executor can reach."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
